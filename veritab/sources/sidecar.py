"""Table sidecars: grids of XML tables with the footnotes that their values wear, and how well those resolve."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.sources.stores import bare_names, inline

_SYMBOLS = "*†‡§¶#"
_TRAILING = re.compile(rf"([{_SYMBOLS}]{{1,3}}|[A-Za-z]|\d{{1,2}})$")
CELLS = "source_id string, table_ix int, row int, col int, rowspan int, colspan int, text string, value_text string, is_header boolean, footnote_ids array<string>, footnote_labels array<string>, marker_source string"
NOTES = "source_id string, table_ix int, fn_ix int, fn_id string, label string, text string, label_source string"


@dataclass
class Note:
    fn_id: str | None
    label: str | None
    text: str
    label_source: str


@dataclass
class Cell:
    row: int
    col: int
    rowspan: int
    colspan: int
    text: str
    value_text: str
    is_header: bool
    footnote_ids: list = field(default_factory=list)
    footnote_labels: list = field(default_factory=list)
    marker_source: str = "none"


def is_symbols(marker: str) -> bool:
    return bool(marker) and all(c in _SYMBOLS for c in marker)


def may_be_marker(text, marker) -> bool:
    """Whether a label at the end of a cell is one: a sign always, else set off by a space, else a letter after a digit or sign; never a bare digit."""
    stem = text[: len(text) - len(marker)]
    if not stem.strip():
        return False
    if is_symbols(marker) or stem != stem.rstrip():
        return True
    return not marker.isdigit() and not stem[-1].isalpha()


def is_ambiguous(text, marker) -> bool:
    """A small whole number with a letter bonded to it may be a value with a marker or a label of its own."""
    return marker.isalpha() and re.fullmatch(r"\d{1,2}", text[: len(text) - len(marker)]) is not None


def opening_marker(text: str) -> str | None:
    """The marker that a note's text seems to open with."""
    m = re.match(rf"[{_SYMBOLS}]{{1,3}}|[A-Za-z]|\d{{1,2}}", text)
    if not m:
        return None
    if is_symbols(m[0]):
        return m[0]
    after = text[m.end() : m.end() + 1]
    return m[0] if after and (after.isspace() or after in ").:;,") else None


def strip_markers(text, labels) -> str:
    for label in sorted(filter(None, labels), key=len, reverse=True):
        text = text.removesuffix(label).strip()
    return text.strip()


def _notes(wrap: ET.Element) -> list[Note]:
    out = []
    for fn in wrap.iter("fn"):
        label = fn.find("label")
        mark = None if label is None else inline(label)
        body = " ".join(inline(c) for c in fn if c.tag != "label").strip()
        body = body or inline(fn).removeprefix(mark or "").strip()
        out.append(Note(fn.get("id"), mark, body, "markup" if mark else "none"))
    return out


def _span(value: str | None) -> int:
    try:
        return max(1, int(value if value is not None else 1))
    except ValueError:
        return 1


def _cells(wrap, labels) -> list[Cell]:
    """The grid, spans expanded; markers come from markup, else from a declared label at a cell's end."""
    out, taken = [], set()
    for r, tr in enumerate(wrap.iter("tr")):
        c = 0
        for node in tr:
            if node.tag not in ("td", "th"):
                continue
            while (r, c) in taken:
                c += 1
            spans = node.get("rowspan"), node.get("colspan")
            rows, cols = map(_span, spans)
            if any(s is not None and not s.lstrip("+-").isdigit() for s in spans):
                rows = cols = 1
            text = inline(node)
            refs = list(node.iter("xref"))
            ids = [i for x in refs for i in (x.get("rid") or "").split()]
            marks = [t for t in map(inline, refs) if t]
            source = "markup" if ids or marks else "none"
            if not marks and (m := _TRAILING.search(text)) and m[1] in labels and may_be_marker(text, m[1]):
                marks, source = [m[1]], "ambiguous" if is_ambiguous(text, m[1]) else "typographic"
            out.append(Cell(r, c, rows, cols, text, text if source == "ambiguous" else strip_markers(text, marks), node.tag == "th", ids, marks, source))
            taken |= {(r + i, c + j) for i in range(rows) for j in range(cols)}
            c += cols
    return out


def _worn(grid) -> set[str]:
    """Markers that values wear beyond doubt."""
    out = set()
    for c in grid:
        if c.marker_source == "markup":
            out.update(filter(None, c.footnote_labels))
        elif (m := _TRAILING.search(c.text)) and may_be_marker(c.text, m[1]) and not is_ambiguous(c.text, m[1]):
            out.add(m[1])
    return out


def _recover(notes: list[Note], worn: set[str]) -> bool:
    """Give notes without a label the marker they open with, where a value wears it and no other note claims it."""
    labels = {n.label for n in notes if n.label}
    claims: dict[str, list[Note]] = {}
    for n in notes:
        mark = None if n.label else opening_marker(n.text)
        if mark and mark in worn and mark not in labels:
            claims.setdefault(mark, []).append(n)
    sole = {mark: own[0] for mark, own in claims.items() if len(own) == 1}
    for mark, n in sole.items():
        n.label, n.label_source = mark, "text"
        n.text = re.sub(r"^[).:;,]", "", n.text[len(mark) :]).strip() or n.text
    return bool(sole)


def _next_markers(mark: str) -> list[str]:
    if mark.isdigit():
        return [str(int(mark) + 1)]
    if is_symbols(mark):
        k = _SYMBOLS.find(mark[0]) + 1
        return [mark[0] * (len(mark) + 1), *_SYMBOLS[k : k + 1]]
    return [chr(ord(mark) + 1)] if len(mark) == 1 and mark.isalpha() and mark not in "zZ" else []


def _opener(mark: str) -> re.Pattern[str]:
    """Where a definition begins inside running text: letters and digits only after the end of a sentence."""
    before = r"(?:^|\s)" if is_symbols(mark) else r"(?:^|(?<=[;.])\s)"
    return re.compile(before + re.escape(mark) + r"\s*(?=[a-zA-Z])")


def _inside(note: Note, worn: set[str], taken: set[str]) -> list[tuple[str, int, int]]:
    """Further definitions in a note's text: along the series of its label, or signs in a note without one."""
    if note.label:
        found, mark, at = [], note.label, 0
        while hits := [(m, h.start(), h.end()) for m in _next_markers(mark) if (h := _opener(m).search(note.text, at))]:
            found.append(min(hits, key=lambda h: h[1]))
            mark, _, at = found[-1]
    else:
        found = [(m, h.start(), h.end()) for s in _SYMBOLS for m in (s, 2 * s, 3 * s) if (h := _opener(m).search(note.text))]
    return sorted((f for f in found if f[0] in worn and f[0] not in taken), key=lambda f: f[1])


def _split(notes: list[Note], worn: set[str]) -> bool:
    """Break a note that defines several markers into one for each that a value wears."""
    taken, new = {n.label for n in notes if n.label}, []
    for n in [*(x for x in notes if not x.label), *(x for x in notes if x.label)]:
        cuts = _inside(n, worn, taken)
        for k, (mark, _, end) in enumerate(cuts):
            body = n.text[end : cuts[k + 1][1] if k + 1 < len(cuts) else len(n.text)].strip()
            if body:
                new.append(Note(None, mark, body, "split"))
                taken.add(mark)
        if cuts:
            rest = n.text[: min(k for _, k, _ in cuts)].strip()
            n.text = rest or n.text
    notes.extend(new)
    return bool(new)


def parse_tables(xml: str) -> list[tuple[list[Cell], list[Note]]]:
    """Cells and notes of each table, read again once labels have been recovered or split off."""
    out = []
    for wrap in bare_names(ET.fromstring(xml)).iter("table-wrap"):
        notes = _notes(wrap)
        cells = _cells(wrap, [n.label for n in notes if n.label])
        worn = _worn(cells)
        changed = bool(worn) and _recover(notes, worn)
        changed = bool(worn) and _split(notes, worn) or changed
        out.append((_cells(wrap, [n.label for n in notes if n.label]) if changed else cells, notes))
    return out


def _explode(kind: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in (CELLS if kind == "cells" else NOTES).split(", ")]
        for frame in frames:
            rows = []
            for source_id, xml in zip(frame["source_id"], frame["xml"]):
                try:
                    tables = parse_tables(xml)
                except (ET.ParseError, TypeError):
                    continue
                for t, (cells, notes) in enumerate(tables):
                    own = [vars(c) for c in cells] if kind == "cells" else [vars(n) | {"fn_ix": k} for k, n in enumerate(notes)]
                    rows.extend({"source_id": source_id, "table_ix": t} | r for r in own)
            yield pd.DataFrame(rows, columns=names)

    return run


def table_cells(documents: DataFrame) -> DataFrame:
    """Cells of the tables of `documents` (source_id, xml)."""
    return documents.select(F.col("source_id").cast("string").alias("source_id"), "xml").mapInPandas(_explode("cells"), CELLS)


def table_notes(documents: DataFrame) -> DataFrame:
    """Footnotes of the tables of `documents` (source_id, xml)."""
    return documents.select(F.col("source_id").cast("string").alias("source_id"), "xml").mapInPandas(_explode("notes"), NOTES)


KEY = ["source_id", "table_ix"]


def bindings(cells: DataFrame, notes: DataFrame) -> DataFrame:
    """(source_id, table_ix, row, col, fn_ix, by): notes that cells reach, by id before label; an ambiguous marker reaches none."""
    sure = cells.where(F.col("marker_source").isin("markup", "typographic"))
    by_id = sure.select(*KEY, "row", "col", F.explode("footnote_ids").alias("fn_id")).join(notes.select(*KEY, "fn_ix", "fn_id"), [*KEY, "fn_id"]).select(*KEY, "row", "col", "fn_ix", F.lit("id").alias("by"))
    by_label = sure.select(*KEY, "row", "col", F.explode("footnote_labels").alias("label")).join(notes.select(*KEY, "fn_ix", "label"), [*KEY, "label"]).select(*KEY, "row", "col", "fn_ix", F.lit("label").alias("by"))
    return by_id.unionByName(by_label).groupBy(*KEY, "row", "col", "fn_ix").agg(F.min("by").alias("by"))


def column_headers(cells: DataFrame) -> DataFrame:
    """(source_id, table_ix, row, col, headers) of cells with text that aren't headers: texts of the header cells that span their column, from the top."""
    head = cells.where("is_header").select(*KEY, F.explode(F.sequence("col", F.col("col") + F.col("colspan") - 1)).alias("_c"), F.struct("row", "text").alias("h"))
    chains = head.where("h.text <> ''").groupBy(*KEY, "_c").agg(F.array_sort(F.collect_list("h")).alias("_h"))
    body = cells.where("not is_header and text <> ''").select(*KEY, "row", "col")
    none = F.expr("cast(array() as array<string>)")
    return body.join(chains.withColumnRenamed("_c", "col"), [*KEY, "col"], "left").select(*KEY, "row", "col", F.coalesce(F.transform("_h", lambda h: h["text"]), none).alias("headers"))


def table_metrics(cells: DataFrame, notes: DataFrame) -> DataFrame:
    """One row a source: rates that are null where there was nothing to rate."""
    ratio = lambda a, n: F.when(n > 0, a / n)
    reached = bindings(cells, notes).select(*KEY, "fn_ix").distinct().withColumn("_r", F.lit(1))
    per_note = notes.join(reached, [*KEY, "fn_ix"], "left").groupBy("source_id").agg(
        ratio(F.count("_r"), F.count("*")).alias("footnote_resolution_rate"),
        ratio(F.count_if(F.col("label_source") == "text"), F.count("label")).alias("recovered_label_share"),
        ratio(F.count_if(F.col("label_source") == "split"), F.count("label")).alias("split_label_share"),
    )
    source = F.col("marker_source")
    per_cell = cells.groupBy("source_id").agg(
        ratio(F.count_if(source == "ambiguous"), F.count_if(source != "none")).alias("ambiguity_rate"),
        ratio(F.count_if(source == "typographic"), F.count_if(source.isin("markup", "typographic"))).alias("typographic_share"),
    )
    covered = column_headers(cells).groupBy("source_id").agg((F.count_if(F.size("headers") > 0) / F.count("*")).alias("header_chain_coverage"))
    return per_cell.join(per_note, "source_id", "left").join(covered, "source_id", "left")


def cell_at(cells: DataFrame, places: DataFrame) -> DataFrame:
    """The cell at each place (source_id, table_ix, row, col): the one declared there, else one that spans it."""
    at, own = places.alias("p"), cells.alias("c")
    same = (F.col("p.source_id") == F.col("c.source_id")) & (F.col("p.table_ix") == F.col("c.table_ix"))
    covers = F.col("p.row").between(F.col("c.row"), F.col("c.row") + F.col("c.rowspan") - 1) & F.col("p.col").between(F.col("c.col"), F.col("c.col") + F.col("c.colspan") - 1)
    declared = (F.col("p.row") == F.col("c.row")) & (F.col("p.col") == F.col("c.col"))
    hit = at.join(own, same & covers, "left").groupBy("p.source_id", "p.table_ix", "p.row", "p.col").agg(F.min(F.struct((~declared).alias("spanned"), F.col("c.row").alias("r"), F.col("c.col").alias("k"), F.col("c.text").alias("text"))).alias("h"))
    return hit.select("source_id", "table_ix", "row", "col", F.col("h.text").alias("text"))
