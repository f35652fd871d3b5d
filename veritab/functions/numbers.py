"""Number parsers. They differ on purpose: each caller needs another notion of "is a number"."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritab.functions.text import collapse_spaces, fold_confusables

#: Sentinel of an asserted absence; neither missing nor zero.
NOT_REPORTED = "not reported"
_PLAIN = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def as_number(text: Column) -> Column:
    """Number at the start of a value, for agreement; null where a hyphen is bonded to it (names with a locant, ranges)."""
    body = collapse_spaces(fold_confusables(text))
    number = F.regexp_extract(body, "^[+-]?[0-9][0-9,]*[.]?[0-9]*(?:[Ee][+-]?[0-9]+)?", 0)
    rest = F.substring(body, F.length(number) + 1, F.length(body))
    return F.when((number != "") & ~rest.startswith("-"), F.replace(number, F.lit(","), F.lit("")).try_cast("double"))  # the pattern lets few pass that fail


def strict_number(text: Column) -> Column:
    """A value that is a number from end to end, else null; no inf, nan or type suffix."""
    body = F.trim(text)
    return F.when(body.rlike(_PLAIN), body.try_cast("double"))


def whole_number(text: Column) -> Column:
    """A non-negative whole number, else null."""
    body = F.trim(text)
    return F.when(body.rlike(r"^\+?\d{1,18}(?:\.0+)?$"), F.regexp_extract(body, r"^\+?(\d+)", 1).try_cast("long"))


def count_or_range(text: Column) -> Column:
    """(lo, hi) of a count, or of a range "lo-hi" / "lo to hi" in rising order; null otherwise."""
    body = F.trim(text)
    one = whole_number(body)
    pair = r"^(\d{1,18})\s*(?:-|–|to)\s*(\d{1,18})$"
    # a cast that fails is slow, so only what fits is cast
    lo, hi = (F.when(body.rlike(pair), F.regexp_extract(body, pair, k).cast("long")) for k in (1, 2))
    return F.when(one.isNotNull(), F.struct(one.alias("lo"), one.alias("hi"))).when(lo <= hi, F.struct(lo.alias("lo"), hi.alias("hi")))


def is_not_reported(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)) == NOT_REPORTED, F.lit(False))


def safe_double(text: Column) -> Column:
    """Double of a plain number; NaN, inf and words give null."""
    return strict_number(text.cast("string"))


def usage_tokens(*aliases: Column) -> Column:
    """First alias present as a whole number; negatives, fractions and words count as 0."""
    first = F.coalesce(*[a.cast("string") for a in aliases])
    return F.greatest(F.coalesce(F.when(first.rlike(r"^[+-]?\d+$"), first.try_cast("long")), F.lit(0)), F.lit(0)).cast("long")


def within(a: Column, b: Column, tolerance: float, floor: float) -> Column:
    """|a - b| <= tolerance x the larger magnitude (at least `floor`)."""
    return F.abs(a - b) <= F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b), F.lit(floor))


def half_even(x: Column, places: int) -> Column:
    """Rounding of ties to the even digit."""
    return F.bround(x, places)


def first_present(values: Sequence[Column]) -> Column:
    return F.coalesce(*values)
