"""Text functions: normaliser chains, keys, slugs and other scalar rules over strings.

All are Column expressions that stay in the JVM, but for three that Spark lacks:
NFKC, a sequence-matcher ratio and sentence bounds, which are pandas UDFs.
"""

from __future__ import annotations

import difflib
import functools
import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Look-alikes folded to one sign; deletions are in _DROPPED.
_FOLD_FROM = "µμ‐‑‒–—−‘’“”′ "
_FOLD_TO = "uu------''\"\"' "
_DROPPED = "­"
DEFAULT_CHAIN = ("nfkc", "lookalikes", "spaces", "lower")


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode compatibility composition; null stays null."""
    told = text.notna()
    out = pd.Series([None] * len(text), dtype=object)
    if told.any():
        out[told.to_numpy()] = text[told].map(lambda s: unicodedata.normalize("NFKC", s)).to_numpy()
    return out


def is_plain(text: Column) -> Column:
    """Whether a text has only signs that NFKC doesn't change."""
    return text.rlike(r"^[\x00-\x7F]*$")


def compatible(text: Column) -> Column:
    """NFKC; only texts with signs beyond ASCII, which it could change, are sent to Python."""
    plain = is_plain(text)
    return F.coalesce(F.when(plain, text), nfkc(F.when(~plain, text)))


def fold_confusables(text: Column) -> Column:
    """The letter u for micro and mu, one sign each for dashes, quotes, primes and no-break space; soft hyphens go."""
    return F.translate(F.replace(text, F.lit(_DROPPED), F.lit("")), _FOLD_FROM, _FOLD_TO)


def collapse_spaces(text: Column) -> Column:
    """Runs of Unicode white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def drop_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)[:;,._\s-]+", "")


_STEPS = {"nfkc": compatible, "lookalikes": fold_confusables, "spaces": collapse_spaces, "lower": F.lower, "no_punctuation": drop_punctuation}


def normalize(text: Column, chain: Sequence[str] = DEFAULT_CHAIN) -> Column:
    """Apply named steps in order. Unknown names are an error when the plan is built."""
    for name in chain:
        if name not in _STEPS:
            raise ValueError(f"unknown normaliser: {name}")
        text = _STEPS[name](text)
    return text


def normalize_doi(doi: Column) -> Column:
    """Lower-cased DOI without resolver or scheme."""
    return F.lower(F.regexp_replace(F.trim(doi), r"(?i)^(?:doi:\s*|https?:/{2}(?:dx[.])?doi[.]org/)", ""))


def title_key(title: Column) -> Column:
    """Words of letters and digits of a title without entities and markup, lower-cased."""
    plain = F.coalesce(title, F.lit(""))
    for entity, sign in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")):
        plain = F.replace(plain, F.lit(entity), F.lit(sign))
    return F.array_join(F.regexp_extract_all(F.lower(F.regexp_replace(plain, r"<[^>]*>", " ")), F.lit("[a-z0-9]+"), F.lit(0)), " ")


_NOTICES = "correction corrigendum erratum addendum retraction"
_CORRECTION = r"(?i)^\s*(?:(?:author|publisher)\s)?(?:" + _NOTICES.replace(" ", "|") + r")\b\s*(?:for\b|to\b)?\s*:*\s*"


def is_correction_title(title: Column) -> Column:
    return F.coalesce(title, F.lit("")).rlike(_CORRECTION)


def strip_correction(title: Column) -> Column:
    return F.regexp_replace(title, _CORRECTION, "")


@F.pandas_udf(T.DoubleType())
def sequence_ratio(new: pd.Series, known: pd.Series) -> pd.Series:
    """Similarity of two normalised titles in [0, 1]; the order of the arguments matters. Empty or null: 0."""
    matcher = difflib.SequenceMatcher
    return pd.Series([matcher(None, a, b).ratio() if a and b else 0.0 for a, b in zip(new, known)], dtype="float64")


def _reaches(a: str, b: str, least: float, places: dict[str, int]) -> bool:
    """Whether the longest common subsequence leaves a ratio of `least` possible: matched blocks never cross, so it is no shorter than what they hold.

    `places` has a bit for each place of a character in `a`; 0 bits of `row` count the length so far.
    """
    whole, n = (1 << len(a)) - 1, len(b)
    need, row = least * (len(a) + n) / 2 - 1e-6, whole
    for k, c in enumerate(b):
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & whole
        if k % 32 == 31 and len(a) - row.bit_count() + n - 1 - k < need:
            return False
    return len(a) - row.bit_count() >= need


@functools.lru_cache(256)
def _places(text: str) -> dict[str, int]:
    """A bit for each place of each character."""
    at: dict[str, int] = {}
    for k, c in enumerate(text):
        at[c] = at.get(c, 0) | 1 << k
    return at


def ratio_from(least: float):
    """`sequence_ratio` of pairs that reach `least`; null for those that the longest common subsequence rules out."""

    @F.pandas_udf(T.DoubleType())
    def ratio(new: pd.Series, known: pd.Series) -> pd.Series:
        matcher = difflib.SequenceMatcher
        return pd.Series([matcher(None, a, b).ratio() if a and b and _reaches(a, b, least, _places(a)) else None for a, b in zip(new, known)], dtype="float64")

    return ratio


def first_author(authors: Column) -> Column:
    """Family name of the first of an array of authors, as letters: what comes before a comma, or the last word."""
    first = F.trim(F.element_at(authors, 1))
    family = F.when(first.contains(","), F.substring_index(first, ",", 1)).otherwise(F.element_at(F.split(first, r"\s+"), -1))
    return F.when(F.size(authors) > 0, F.regexp_replace(F.lower(family), "[^a-z]", ""))


def dirname(source_id: Column) -> Column:
    """A source id as a directory name."""
    return F.regexp_replace(source_id, "[^-._0-9A-Za-z]", "_")


def slug(text: Column, prefix: str = "p") -> Column:
    """Lower-case identifier of letters, digits and underscores; one that doesn't begin with a letter gets a prefix."""
    made = F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(made.rlike("^[a-z]"), made).otherwise(F.concat(F.lit(prefix + "_"), made))


def next_version(version: Column) -> Column:
    """The version after one such as v3: its last number plus one; without a number, v2."""
    number = F.regexp_extract(version, r"(\d+)(?!.*\d)", 1)
    return F.when(number == "", F.lit("v2")).otherwise(F.concat(F.lit("v"), (number.cast("int") + 1).cast("string")))


def tag_surface(adjudicator: Column, surface: str) -> Column:
    """An adjudicator's name with the surface where the ruling was made, once."""
    end = f" [{surface}]"
    return F.when(adjudicator.endswith(end), adjudicator).otherwise(F.concat(F.coalesce(adjudicator, F.lit("")), F.lit(end)))


def surface_of(adjudicator: Column, surfaces: Sequence[str] = ("browser", "chat")) -> Column:
    out = F.lit("unknown")
    for s in surfaces:
        out = F.when(F.coalesce(adjudicator, F.lit("")).endswith(f" [{s}]"), F.lit(s)).otherwise(out)
    return out


def smiles_kind(smiles: Column) -> Column:
    """Whether a SMILES string carries stereochemistry."""
    return F.when(smiles.rlike(r"[@/\\]"), F.lit("isomeric")).otherwise(F.when(smiles.isNotNull(), F.lit("flat")))


def quote_at(text: Column, start: Column, end: Column) -> Column:
    """Code points [start, end) of a text, from 0."""
    return F.substring(text, start + 1, end - start)


def tool_name(name: Column) -> Column:
    return F.substring_index(name, "__", -1)


def is_write_tool(name: Column, tools: Sequence[str] = ("gate_upsert", "db_upsert")) -> Column:
    return tool_name(name).isin(list(tools))


_SENTENCE_END = re.compile(r"(?<=[?!.])\s+")


@F.pandas_udf(T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())))
def sentence_bounds(text: pd.Series) -> pd.Series:
    """Half-open bounds of sentences, split at white space after a full stop, exclamation or question mark."""

    def bounds(s: str | None) -> list[dict[str, int]]:
        out, at = [], 0
        for gap in _SENTENCE_END.finditer(s or ""):
            out.append(dict(start=at, end=gap.start()))
            at = gap.end()
        return [*out, dict(start=at, end=len(s))] if s else []

    return text.map(bounds)


def log_seconds(clock: Column) -> Column:
    """Seconds of a time of day HH:MM:SS."""
    p = F.split(clock, ":")
    return F.when(clock.rlike(r"^\d{1,2}:\d{2}:\d{2}$"), p[0].cast("int") * 3600 + p[1].cast("int") * 60 + p[2].cast("int"))


_STRAIN_RUNGS = (
    ("qualifier", r"(?i)\b(?:cf|aff|nr)\.?\s+"),
    ("rank", r"(?i)\s+\b(?:subsp|ssp|var|f|sp|spp)\.?\s*\S*"),
    ("strain", r"(?i)\s+(?:strain|str\.?|isolate|culture)\s+\S+.*$"),
    ("collection", r"\s+(?:ATCC|DSM|CBS|NRRL|JCM|NBRC|NCTC|LMG|MTCC)\s*[-#]?\s*\S+.*$"),
    ("bracket", r"\s*[\(\[][^)\]]*[\)\]]"),
)


def fold_strain(name: Column) -> Column:
    """(folded, rungs): an organism's name with strain-like parts taken off, and which rules took something."""
    now, rungs = F.trim(name), []
    for rung, pattern in _STRAIN_RUNGS:
        then = F.trim(F.regexp_replace(now, pattern, " " if rung == "qualifier" else ""))
        rungs.append(F.when(then != now, F.lit(rung)))
        now = then
    return F.struct(collapse_spaces(now).alias("folded"), F.filter(F.array(*rungs), lambda r: r.isNotNull()).alias("rungs"))


def species_epithet(name: Column) -> Column:
    """Second word of a folded name if it is all lower-case letters and no placeholder."""
    word = F.regexp_extract(fold_strain(name)["folded"], r"^\S+\s+([a-z][a-z-]+)\b", 1)
    return F.when((word != "") & ~word.isin("sp", "spp", "cf", "aff"), word)


def taxon_candidates(name: Column) -> Column:
    """Names to look up, from the full one to the genus alone, without repeats."""
    folded = fold_strain(name)["folded"]
    binomial = F.array_join(F.slice(F.split(folded, " "), 1, 2), " ")
    genus = F.substring_index(folded, " ", 1)
    return F.filter(F.array_distinct(F.array(collapse_spaces(name), folded, binomial, genus)), lambda c: c.isNotNull() & (c != ""))
