"""Document stores: one text for each source, with sections as half-open ranges of code points.

Full-text XML needs a walk in document order, which no built-in reader gives, so
it runs in `mapInPandas`; titles with abstracts are plain expressions.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GAP = "\n\n"
STORE = "source_id string, full_text string, sections array<struct<title:string,start:int,end:int,depth:int>>, chars int, est_tokens int, error string"
_LEFT_OUT = {"ref-list", "table-wrap-foot", "label"}
_BLOCKS = set("fig boxed-text disp-quote disp-formula".split())
_LISTS = {"list", "def-list"}


def bare_names(root: ET.Element) -> ET.Element:
    """Tags without namespaces."""
    for node in root.iter():
        if isinstance(node.tag, str):
            node.tag = node.tag.rpartition("}")[2]
    return root


def inline(node: ET.Element | None) -> str:
    """Text of a block in reading order, white space collapsed."""
    return "" if node is None else " ".join("".join(node.itertext()).split())


class _Text:
    """Blocks one after another, each followed by a gap."""

    def __init__(self) -> None:
        self.blocks: list[str] = []
        self.at = 0
        self.sections: list[dict] = []

    def add(self, block: str) -> tuple[int, int]:
        start = self.at
        if block:
            self.blocks.append(block + GAP)
            self.at += len(block) + len(GAP)
        return start, start + len(block)

    def table(self, node: ET.Element) -> None:
        """Label and caption, then a line for each row with its cells between tabs."""
        self.add(" ".join(t for t in (inline(node.find("label")), inline(node.find("caption"))) if t))
        for row in node.iter("tr"):
            self.add("\t".join(t for t in (inline(c) for c in row if c.tag in ("td", "th")) if t))

    def walk(self, node: ET.Element, depth: int = 0) -> None:
        if not isinstance(node.tag, str) or node.tag in _LEFT_OUT:
            return
        if node.tag == "sec":
            heading, start = node.find("title"), self.at
            self.add(inline(heading))
            for child in node:
                if child is not heading:
                    self.walk(child, depth + 1)
            self.sections.append(dict(title=inline(heading) or "(untitled)", start=start, end=self.at, depth=depth))
        elif node.tag == "table-wrap":
            self.table(node)
        elif node.tag == "p" or node.tag in _BLOCKS:
            self.add(inline(node))
        elif node.tag in _LISTS:
            for item in node:
                self.add(inline(item))
        else:
            for child in node:
                self.walk(child, depth)


def xml_store(source_id: str, xml: str) -> dict:
    """The store of a full-text document: title, abstract, body, back matter; reference lists are left out. An empty one is an error."""
    root = bare_names(ET.fromstring(xml))
    out = _Text()
    meta = root.find("./front/article-meta")
    title = meta.find("./title-group/article-title") if meta is not None else None
    out.add(inline(title))
    for abstract in meta.findall("abstract") if meta is not None else ():
        start = out.at
        for child in abstract:
            out.walk(child, 1)
        if out.at == start:
            out.add(inline(abstract))
        out.sections.append(dict(title="Abstract", start=start, end=out.at, depth=0))
    for part in ("body", "back"):
        if (node := root.find(part)) is not None:
            out.walk(node)
    text = "".join(out.blocks)
    if not text.strip():
        raise ValueError("no text")
    order = sorted(out.sections, key=itemgetter("start", "depth"))
    return dict(source_id=source_id, full_text=text, sections=order, chars=len(text), est_tokens=round(len(text) / 4), error=None)


def _build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for source_id, xml in zip(frame["source_id"], frame["xml"]):
            try:
                rows.append(xml_store(source_id, xml))
            except (ET.ParseError, ValueError, TypeError) as why:
                rows.append({"source_id": source_id, "full_text": None, "sections": None, "chars": None, "est_tokens": None, "error": str(why)[:200]})
        yield pd.DataFrame(rows, columns=["source_id", "full_text", "sections", "chars", "est_tokens", "error"])


def xml_stores(documents: DataFrame) -> DataFrame:
    """Stores of `documents` (source_id, xml). One that can't be read, or has no text, has an error instead of a text."""
    return documents.select(F.col("source_id").cast("string").alias("source_id"), "xml").mapInPandas(_build, STORE)


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, xml) of the files of a folder; the id is the file's name without its ending."""
    files = spark.read.option("recursiveFileLookup", True).option("wholetext", True).text(path).withColumn("_path", F.col("_metadata.file_name"))
    return files.select(F.regexp_replace("_path", r"\.[^.]*$", "").alias("source_id"), F.col("value").alias("xml"))


def abstract_stores(papers: DataFrame) -> DataFrame:
    """Stores of `papers` (source_id, title, abstract): both trimmed, each followed by a gap; neither there is an error."""
    title, abstract = F.trim(F.coalesce("title", F.lit(""))), F.trim(F.coalesce("abstract", F.lit("")))
    block = lambda t: F.when(t != "", F.concat(t, F.lit(GAP))).otherwise("")
    text = F.concat(block(title), block(abstract))
    start = F.length(block(title))
    section = F.struct(F.lit("Abstract").alias("title"), start.alias("start"), (start + F.length(abstract)).alias("end"), F.lit(0).alias("depth"))
    none = F.expr("cast(array() as array<struct<title:string,start:int,end:int,depth:int>>)")
    return papers.select(
        F.col("source_id").cast("string").alias("source_id"), F.when(text != "", text).alias("full_text"), F.when(abstract != "", F.array(section)).otherwise(none).alias("sections"), F.when(text != "", F.length(text)).alias("chars"),
        F.when(text != "", F.bround(F.length(text) / 4, 0).cast("int")).alias("est_tokens"), F.when(text == "", F.lit("no text")).alias("error"),
    )


def write_stores(stores: DataFrame, path: str) -> None:
    """Stores that have a text, as Parquet; one with an error is never written as an empty text."""
    stores.where("error is null").drop("error").write.mode("append").parquet(path)


def find_store(ids: DataFrame, stores: DataFrame) -> DataFrame:
    """Stores of `ids` (source_id); a null text says that a source was never stored."""
    return ids.join(stores, "source_id", "left")


