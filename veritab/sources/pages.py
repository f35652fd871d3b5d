"""Lines of paged documents: layout checks, running heads, references, repeats, and joining into a text.

Input is a table of lines (source_id, page, line_no, text), and for layout one
of boxes (source_id, page, width, line_no, x0, y0, x1, y1). An external program
makes them; it isn't run here.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

ZONE = 3


def geometry(rows: DataFrame) -> DataFrame:
    """Boxes from rows of tab-separated geometry (source_id, tsv): level 1 is the page, level 4 a line."""
    f = F.split("tsv", "\t")
    cols = {n: f[k].try_cast("double") for k, n in enumerate(("level", "page", "left", "top", "width", "height"))}
    got = rows.select("source_id", "ord", *[c.alias(n) for n, c in cols.items()]).where("level is not null and page is not null and left is not null and top is not null and width is not null and height is not null")
    page = got.where("level = 1").groupBy("source_id", F.col("page").cast("int").alias("page")).agg(F.max("width").alias("width"))
    line = got.where("level = 4").select("source_id", F.col("page").cast("int").alias("page"), F.col("ord").alias("line_no"), F.col("left").alias("x0"), F.col("top").alias("y0"), (F.col("left") + F.col("width")).alias("x1"), (F.col("top") + F.col("height")).alias("y1"))
    return line.join(page, ["source_id", "page"], "left").fillna({"width": 0.0})


def _page() -> WindowSpec:
    """Lines of a page in reading order."""
    return Window.partitionBy("source_id", "page").orderBy("line_no")


def column_hops(boxes: DataFrame) -> DataFrame:
    """Per page, how often reading jumps sideways at one height: lines under a fifth of the page don't count."""
    mid, wide = F.col("width") / 2, F.col("x1") - F.col("x0") >= 0.2 * F.col("width")
    side = F.when(F.col("x1") <= mid, "L").when(F.col("x0") >= mid, "R").otherwise("X")
    b = boxes.where("width > 0").withColumn("side", side).withColumn("wide", wide).withColumn("h", F.col("y1") - F.col("y0"))
    for c in ("side", "wide", "y0", "h"):
        b = b.withColumn(f"_{c}", F.lag(c).over(_page()))
    hop = F.col("wide") & F.col("_wide") & F.concat("side", "_side").isin("LR", "RL") & (F.abs(F.col("y0") - F.col("_y0")) < 0.6 * F.greatest("h", "_h"))
    return b.groupBy("source_id", "page").agg(F.count_if(hop).alias("hops"))


def column_returns(boxes: DataFrame) -> DataFrame:
    """Per page, how often reading goes back to the left column after the right one within a band; full-width lines begin bands."""
    mid = F.col("width") / 2
    wide = boxes.where("width > 0 and x1 - x0 >= 0.3 * width")
    kind = F.when((F.col("x0") < mid) & (mid < F.col("x1")), "full").when(F.col("x0") >= mid, "right").otherwise("left")
    b = wide.withColumn("kind", kind).withColumn("band", F.count_if(F.col("kind") == "full").over(_page().rowsBetween(Window.unboundedPreceding, 0))).where("kind <> 'full'")
    before = F.lag("kind").over(Window.partitionBy("source_id", "page", "band").orderBy("line_no"))
    back = b.withColumn("r", (F.col("kind") == "left") & (before == "right"))
    pages = boxes.select("source_id", "page").distinct()
    return pages.join(back.groupBy("source_id", "page").agg(F.count_if("r").alias("returns")), ["source_id", "page"], "left").fillna({"returns": 0})


def overprints(boxes: DataFrame) -> DataFrame:
    """Per page, lines of which over half the area lies under another line."""
    a, b = boxes.alias("a"), boxes.alias("b")
    near = a.join(b, (F.col("a.source_id") == F.col("b.source_id")) & (F.col("a.page") == F.col("b.page")) & (F.col("a.line_no") != F.col("b.line_no")) & (F.col("a.y0") < F.col("b.y1")) & (F.col("b.y0") < F.col("a.y1")))
    shared = F.greatest(F.lit(0.0), F.least("a.x1", "b.x1") - F.greatest("a.x0", "b.x0")) * F.greatest(F.lit(0.0), F.least("a.y1", "b.y1") - F.greatest("a.y0", "b.y0"))
    area = lambda t: (F.col(f"{t}.x1") - F.col(f"{t}.x0")) * (F.col(f"{t}.y1") - F.col(f"{t}.y0"))
    return near.where(shared > 0.5 * F.least(area("a"), area("b"))).groupBy("a.source_id", "a.page").agg(F.countDistinct("a.line_no").alias("overlapping"))


def _most(pages_with: Column, odd_with: Column, n: Column) -> Column:
    """On most pages, or on most of one parity; three at least."""
    odd_pages = F.ceil(n / 2)
    return (pages_with >= 3) & ((pages_with > n / 2) | (odd_with > odd_pages / 2) | (pages_with - odd_with > (n - odd_pages) / 2))


def running_lines(lines: DataFrame) -> DataFrame:
    """Lines to drop (source_id, page, line_no, kind): heads and feet whose shape recurs on most pages, and page numbers with one offset.

    Documents of fewer than three pages have none.
    """
    n = lines.groupBy("source_id").agg(F.max("page").alias("n")).where("n >= 3")
    full = lines.where(F.trim("text") != "").join(n, "source_id").withColumn("t", F.trim("text"))
    up, down = Window.partitionBy("source_id", "page").orderBy("line_no"), Window.partitionBy("source_id", "page").orderBy(F.col("line_no").desc())
    full = full.withColumn("in_zone", (F.row_number().over(up) <= ZONE) | (F.row_number().over(down) <= ZONE)).withColumn("shape", F.regexp_replace("t", r"\d+", "#"))
    odd = F.countDistinct(F.when(F.col("page") % 2 == 1, F.col("page")))
    lettered = F.length(F.regexp_replace("shape", r"(?U)[\W\d_]", "")) >= 3
    shapes = full.where(F.col("in_zone") & lettered).groupBy("source_id", "shape", "n").agg(F.countDistinct("page").alias("p"), odd.alias("o")).where(_most(F.col("p"), F.col("o"), F.col("n"))).select("source_id", "shape")
    texts = full.where("in_zone").join(shapes, ["source_id", "shape"]).select("source_id", "page", "line_no", F.when(F.col("t").rlike(r"^\d{1,5}$"), "page_number").otherwise("running_text").alias("kind"))
    numbers = full.where(F.col("t").rlike(r"^\d{1,5}$")).withColumn("off", F.col("t").cast("int") - F.col("page"))
    offsets = numbers.groupBy("source_id", "off", "n").agg(F.countDistinct("page").alias("p"), odd.alias("o"))
    best = offsets.groupBy("source_id", "n").agg(F.max(F.struct("p", (-F.abs("off")).alias("near"), "off", "o")).alias("b")).where(_most(F.col("b.p"), F.col("b.o"), F.col("n"))).select("source_id", F.col("b.off").alias("off"))
    edge = F.least(F.col("line_no") - F.min("line_no").over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.max("line_no").over(up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - F.col("line_no"))
    hit = numbers.withColumn("edge", edge).join(best, ["source_id", "off"])
    one = hit.withColumn("k", F.row_number().over(Window.partitionBy("source_id", "page").orderBy((~F.col("in_zone")).cast("int"), F.when(F.col("in_zone"), F.col("line_no")).otherwise(F.col("edge")), "line_no"))).where("k = 1")
    return texts.unionByName(one.select("source_id", "page", "line_no", F.lit("page_number").alias("kind"))).dropDuplicates(["source_id", "page", "line_no"])


_REFERENCES = r"(?i)^\s*(?:\d+\.?\s+|[ivx]+\.?\s+)?(?:references|bibliography|literature cited|works cited)\s*:?\s*$"
_APPENDIX = r"(?i)^\s*(?:appendix|appendices|supplementary (?:material|information)|annex)\b"


def cut_references(lines: DataFrame) -> DataFrame:
    """`lines` without the last reference list; an appendix after it stays. Order is page, then line."""
    seq = lines.withColumn("_s", F.struct("page", "line_no"))
    at = seq.where(F.col("text").rlike(_REFERENCES)).groupBy("source_id").agg(F.max("_s").alias("_from"))
    app = seq.where(F.col("text").rlike(_APPENDIX)).join(at, "source_id").where(F.col("_s") > F.col("_from")).groupBy("source_id").agg(F.min("_s").alias("_to"))
    kept = seq.join(at, "source_id", "left").join(app, "source_id", "left")
    gone = (F.col("_s") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("_s") < F.col("_to")))
    return kept.where(~F.coalesce(gone, F.lit(False))).drop("_s", "_from", "_to")


def collapse_repeats(lines: list[str], min_block: int = 3, min_cover: float = 0.5) -> list[str]:
    """A page whose lines are one block printed several times over keeps it once."""
    n = len(lines)
    for size in range(min_block, n // 2 + 1):
        times = 1
        while lines[times * size : (times + 1) * size] == lines[:size]:
            times += 1
        if times > 1 and times * size >= min_cover * n:
            return lines[:size] + lines[times * size :]
    return lines


_ROMAN = re.compile(r"^(?=[IVXL])(X{0,3})(IX|IV|V?I{0,3})\.?\s+\S")
_NUMBERED = re.compile(r"^([0-9]+(?:[.][0-9]+)*)[.]?\s+(\S.*)$")
_NAMED = {"abstract", "introduction", "background", "methods", "materials and methods", "results", "discussion", "results and discussion", "conclusion", "conclusions", "acknowledgements", "acknowledgments", "appendix", "summary"}


def roman(number: str) -> int | None:
    """Value of a Roman numeral up to 89."""
    worth = dict(zip("IVXL", (1, 5, 10, 50)))
    if not number or any(c not in worth for c in number):
        return None
    return sum(-worth[a] if b and worth[a] < worth[b] else worth[a] for a, b in zip(number, [*number[1:], ""]))


def is_successor(new: str, old: str | None) -> bool:
    """Whether a heading number follows another: the next one, its first part, or the next of a level above."""
    now = [int(p) for p in new.split(".")]
    if old is None:
        return now[-1] == 1 and all(p >= 1 for p in now)
    was = [int(p) for p in old.split(".")]
    return now == [*was, 1] or any(now == [*was[:k], was[k] + 1] for k in range(len(was)))


def heading(line: str, last: str | None) -> tuple[str, str | None, int] | None:
    """(title, number, depth) of a line that is a heading, else None."""
    text = line.strip()
    if len(text) > 120 or text.endswith((",", ";")):
        return None
    key = re.sub(r"[^a-z ]", "", text.lower()).strip()
    if m := _NUMBERED.match(text):
        rest = m[2]
        if rest[0].isupper() and not rest.endswith(".") and is_successor(m[1], last):
            return text, m[1], m[1].count(".")
    if key in _NAMED:
        return text, None, 0
    if _ROMAN.match(text) and text.split(None, 1)[1].isupper():
        return text, None, 0
    return None


ASSEMBLED = "source_id string, full_text string, sections array<struct<title:string,start:int,end:int,depth:int>>, pages array<struct<page_no:int,start:int,end:int>>"


def _assemble(lines: pd.DataFrame) -> pd.DataFrame:
    """Paragraphs of one document: hyphens at line ends join words, headings and blank lines end paragraphs, and page ranges are kept.

    An open paragraph is a list of its pieces, so that a long one costs no more
    a line than a short one.
    """
    parts: list[str] = []
    at, last = 0, None
    open_: list[str] = []
    length = 0  # of the open paragraph
    sections: list[dict] = []
    pages: dict[int, list[int]] = {}

    def close() -> None:
        nonlocal at, length
        if length:
            parts.extend((*open_, "\n\n"))
            at += length + 2
        open_.clear()
        length = 0

    source = lines["source_id"].iloc[0]
    lines = lines.dropna(subset=["page"]).sort_values(["page", "line_no"])
    numbers, texts = lines["page"].to_numpy(), lines["text"].fillna("").tolist()
    starts = [k for k in range(len(numbers)) if not k or numbers[k] != numbers[k - 1]]
    for begin, end in zip(starts, [*starts[1:], len(numbers)]):
        start = at + length
        for text in collapse_repeats([t.strip() for t in texts[begin:end]]):
            if not text:
                close()
            elif found := heading(text, last):
                close()
                sections.append({"title": found[0], "start": at, "end": None, "depth": found[2]})
                last = found[1] or last
                open_.append(text)
                length = len(text)
                close()
            else:
                if length:
                    if open_[-1].endswith("-") and text[:1].islower():
                        open_[-1] = open_[-1][:-1]
                        length -= 1
                    else:
                        open_.append(" ")
                        length += 1
                open_.append(text)
                length += len(text)
        pages[int(numbers[begin])] = [start, at + length]
    close()
    nearest: list[dict] = []  # sections after this one, each nearer than those above it and deeper than what it closes
    for s in reversed(sections):
        while nearest and nearest[-1]["depth"] > s["depth"]:
            nearest.pop()
        s["end"] = nearest[-1]["start"] if nearest else at
        nearest.append(s)
    return pd.DataFrame([{"source_id": source, "full_text": "".join(parts), "sections": sections, "pages": [{"page_no": p, "start": a, "end": b} for p, (a, b) in pages.items()]}])


def assemble(lines: DataFrame) -> DataFrame:
    """Stores (source_id, full_text, sections, pages) from cleaned lines; a document is one group, as its headings are read in order."""
    return lines.groupBy("source_id").applyInPandas(_assemble, ASSEMBLED)


def clean_lines(lines: DataFrame) -> DataFrame:
    """Lines without running heads, page numbers and reference lists."""
    gone = running_lines(lines)
    return cut_references(lines.join(gone.select("source_id", "page", "line_no"), ["source_id", "page", "line_no"], "left_anti"))
