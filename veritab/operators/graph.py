"""Connected components by least labels and shortcuts, with each round written to the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="veritab-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder of the session."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def connected(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component) for the nodes of `edges` (u, v): the least node reachable.

    Every round, a node takes the least label of itself and its neighbours, and
    then the label of that label; both halve the distance left.
    """
    both = edges.select("u", "v").union(edges.select("v", "u")).where("u <> v").distinct()
    both = checkpointed(both)
    labels = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label"))
    labels = checkpointed(labels)
    for _ in range(max_rounds):
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("label").alias("n"))
        step = labels.join(near, labels["node"] == near["u"], "left").select("node", F.least("label", F.coalesce("n", "label")).alias("l"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        out = step.join(jump, step["l"] == jump["_n"], "left").select("node", F.least("l", F.coalesce("_l", "l")).alias("label"), "was")
        out = checkpointed(out)
        labels = out.select("node", "label")
        if out.where("label <> was").isEmpty():
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
