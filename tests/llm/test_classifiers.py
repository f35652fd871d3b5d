from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritab.llm import quality, toxicity
from veritab.llm.labelled import held_out, sample

DATA = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    return docs, labels


def test_held_out_rows_are_never_sampled(spark, labelled):
    ids = spark.createDataFrame([(k,) for k in [*range(40), None]], "doc_id long").select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in ids)
    docs, labels = labelled
    few = sample(docs, labels, "quality", 50)
    assert few.count() == 50
    texts = {r["text"] for r in few.collect()}
    assert texts <= {r["text"] for r in docs.join(labels.where(~held_out(F.col("doc_id"))), "doc_id").select("text").collect()}


def test_quality_on_held_out_rows(spark, labelled):
    docs, labels = labelled
    out = quality.quality(docs, labels).join(labels, "doc_id").where("held_out")
    right, n = out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 1000 and right > 0.98


def test_quality_ignores_ids_and_order(spark, labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels, 500)
    again = quality.fit(docs.repartition(7), labels.repartition(3), 500)
    texts = [r["text"].encode() for r in docs.limit(40).collect()]
    x, sizes = quality.encode_passages(texts)
    assert np.allclose(model.scores(x, sizes), again.scores(x, sizes))
    one = [model.scores(*quality.encode_passages([t]))[0] for t in texts]
    assert np.allclose(one, model.scores(x, sizes))  # a text's score doesn't depend on its neighbours


def test_attention_gradients():
    rng = np.random.default_rng(0)
    x, sizes, y = rng.standard_normal((11, 5)), np.array([3, 1, 7]), np.array([1.0, 0.0, 1.0])
    model = quality.train(x, sizes, y, steps=1)

    def loss() -> float:
        p = model.forward(x, sizes)["y"]
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    for name, g in model.gradients(x, sizes, y).items():
        at = tuple(0 for _ in g.shape)
        keep = model.p[name][at]
        model.p[name][at] = keep + 1e-6
        up = loss()
        model.p[name][at] = keep - 1e-6
        down = loss()
        model.p[name][at] = keep
        assert abs((up - down) / 2e-6 - g[at]) < 1e-6, name


def test_passages():
    text = ("word " * 130 + "|| Tab | LE").encode()
    x, sizes = quality.encode_passages([text, None, b"  \n", b"a b"])
    assert sizes.tolist() == [3, 1, 1, 1] and x.shape == (6, quality.FEATURES)
    assert (x[3] == 0).all() and (x[4] == 0).all() and np.isfinite(x).all()


def test_ordinal_fit_orders_thresholds_and_recovers_weights():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (3000, 4))
    eta = x @ np.array([3.0, -2.0, 0.0, 1.0]) + rng.logistic(size=3000)
    grades = np.digitize(eta, [0.5, 2.0, 3.5])
    rows = [np.flatnonzero(r).tolist() for r in x]
    w, t = toxicity.fit_ordinal(rows, [np.ones(len(r)) for r in rows], grades, 4, 3, steps=800, ridge=0.0)
    assert (np.diff(t) > 0).all()
    assert np.allclose(w, [3, -2, 0, 1], atol=0.3) and np.allclose(t, [0.5, 2.0, 3.5], atol=0.3)


def test_toxicity_on_held_out_rows(spark, labelled):
    docs, labels = labelled
    out = toxicity.toxicity(docs, labels).join(labels.select("doc_id", F.col("toxic").alias("y")), "doc_id").where(held_out(F.col("doc_id")))
    r = out.agg(F.avg(F.when(F.col("y") == 1, F.col("toxic"))).alias("recall"), F.avg(F.when(F.col("y") == 0, F.col("toxic"))).alias("alarms")).first()
    assert r["recall"] > 0.85 and r["alarms"] < 0.01
    grades = {x["severity"] for x in out.select("severity").distinct().collect()}
    assert grades == {0, 1, 2, 3}
    assert out.where("expected_severity < 0 or expected_severity > 3").isEmpty()


def test_without_labels(spark, awkward, nothing, clashing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(awkward, none).where("toxic = 1").isEmpty()
    assert {r["score"] for r in quality.quality(awkward, none).collect()} == {0.5}
    one = spark.createDataFrame([(2, 1, None), (0, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["predicted"] for r in quality.quality(awkward, one).collect()} == {1}
    assert toxicity.toxicity(nothing, one).count() == 0 and quality.quality(nothing, one).count() == 0
    assert toxicity.drop_toxic(clashing, one).columns == clashing.columns
    assert toxicity.drop_toxic(clashing, one).count() == clashing.count()


def test_drop_toxic(spark):
    bad = [(k, f"this is a {w} of a thing {k}", 1) for k, w in enumerate(["moronic", "moron", "morons"] * 20)]
    good = [(100 + k, f"this is a fine sort of thing {k}", 0) for k in range(60)]
    docs = spark.createDataFrame([r[:2] for r in bad + good] + [(500, "what a moronish day"), (501, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in bad + good], "doc_id long, toxic int")
    left = {r["doc_id"] for r in toxicity.drop_toxic(docs, labels).collect()}
    assert left == {r[0] for r in good} | {501}
