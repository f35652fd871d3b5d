"""Checks of a value against its declared field: type, range, vocabulary, and shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritab.functions.numbers import strict_number


def number_anywhere(text: Column) -> Column:
    """The first number in a value, wherever it stands."""
    found = F.regexp_extract(F.replace(text, F.lit("−"), F.lit("-")), "[+-]?[0-9][0-9,]*[.]?[0-9]*", 0)
    return F.when(found != "", F.replace(found, F.lit(","), F.lit("")).try_cast("double"))


def validate(value: Column, kind: str, valid_range: tuple[float, float] | None = None, enum: list[str] | None = None) -> Column:
    """(c_grounded, ok, flags): conformance of a value; one outside its range is flagged, not dropped."""
    flags = []
    if kind in ("float", "int"):
        number = number_anywhere(value)
        flags.append(F.when(number.isNull(), F.lit("not_numeric")))
        if valid_range:
            flags.append(F.when(~number.between(*valid_range), F.lit("out_of_range")))
    if enum:
        flags.append(F.when(~F.coalesce(value, F.lit("None")).isin(enum), F.lit("not_in_vocabulary")))
    found = F.filter(F.array(*flags), lambda f: f.isNotNull()) if flags else F.expr("cast(array() as array<string>)")
    return F.struct(F.when(F.size(found) == 0, 1.0).otherwise(0.0).alias("c_grounded"), (F.size(found) == 0).alias("ok"), found.alias("flags"))


def shape_issues(elements: Column, is_list: Column, kind: str, enum: list[str] | None = None) -> Column:
    """Advisory: a lone value in a list field, prose in a field for names, a word outside the vocabulary."""
    listed = kind.startswith("list")

    def of(v: Column) -> Column:
        s = F.trim(v)
        commas = F.length(s) - F.length(F.replace(s, F.lit(","), F.lit("")))
        prose = (F.length(s) > 80) | s.rlike(r"(?i)\b(?:whereas|while|that|which|with|or|and)\b") | s.contains(";") | (commas > 1) | s.rlike(r"\.\s+\w")
        return F.array(F.when(prose & F.lit(listed or kind in ("str", "enum")), F.lit("prose")), F.when(~s.isin(enum), F.lit("not_in_vocabulary")) if enum else F.lit(None).cast("string"))

    lone = F.array(F.when(~is_list & F.lit(listed), F.lit("single_value")))
    told = F.filter(elements, lambda v: v.isNotNull() & (v != ""))
    return F.when(F.size(told) == 0, F.expr("cast(array() as array<string>)")).otherwise(F.filter(F.concat(lone, F.flatten(F.transform(told, of))), lambda x: x.isNotNull()))


def provenance_violations(p: dict[str, Column]) -> Column:
    """Rules that a provenance row breaks, as codes. `p` has its columns; those it lacks are null.

    A fingerprint is 64 hexadecimal digits; ontology id and version come
    together, as do the two figures of how much of a source was read; what was
    read is within the source, and an offset within what was read.
    """
    none = F.lit(None)
    get = lambda name, kind: p.get(name, none).cast(kind)
    print_, onto, version = get("process_fingerprint", "string"), get("ontology_id", "string"), get("ontology_version", "string")
    total, read, offset = get("source_chars_total", "long"), get("source_chars_read", "long"), get("char_offset", "long")
    rules = [
        F.when(print_.isNotNull() & ~F.lower(F.trim(print_)).rlike("^[0-9a-f]{64}$"), F.lit("fingerprint_not_sha256")),
        F.when(onto.isNull() != version.isNull(), F.lit("ontology_half_given")),
        F.when(total.isNull() != read.isNull(), F.lit("retention_half_given")),
        F.when(read > total, F.lit("read_beyond_total")),
        F.when(offset >= read, F.lit("offset_beyond_read")),
        F.when((get("kind", "string") == "literature") & F.coalesce(F.trim(get("verbatim_quote", "string")) == "", F.lit(True)), F.lit("quote_missing")),
        F.when((get("kind", "string") == "structured") & get("db_version", "string").isNull(), F.lit("db_version_missing")),
        F.when(~F.coalesce(get("source_status", "string"), F.lit("active")).isin("active", "retracted", "superseded", "corrected"), F.lit("source_status_unknown")),
    ]
    return F.filter(F.array(*rules), lambda r: r.isNotNull())


def retained_fraction(read: Column, total: Column) -> Column:
    """Share of a source that was read, at most 1; null where either figure is missing, 0 for an empty source."""
    return F.when(read.isNull() | total.isNull(), F.lit(None).cast("double")).when(total == 0, 0.0).otherwise(F.least(F.lit(1.0), read / total))


def typed(value: Column, kind: str) -> Column:
    """A value as its declared type; what doesn't fit is null."""
    if kind == "float":
        return strict_number(value)
    if kind == "int":
        return F.when(F.trim(value).rlike(r"^[+-]?\d+$"), F.trim(value).try_cast("long"))
    if kind == "bool":
        return F.lower(F.trim(value)).try_cast("boolean")
    return F.from_json(value, "array<string>") if kind.startswith("list") else value
