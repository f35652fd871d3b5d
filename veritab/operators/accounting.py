"""Accounts of token use: streams by unit and stage, work and re-reads, projections, and ceilings."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.numbers import half_even, usage_tokens
from veritab.operators.order import running

STREAMS = tuple("input output cache_read cache_write".split())
_OTHER_NAMES = {"input": "input_tokens prompt_tokens", "output": "output_tokens completion_tokens", "cache_read": "cache_read_input_tokens", "cache_write": "cache_creation_input_tokens"}
ALIASES = {s: (s, *_OTHER_NAMES[s].split()) for s in STREAMS}


def usage_rows(observed: DataFrame, usage: str = "usage") -> DataFrame:
    """`observed` with the four streams read from a JSON column under any of their names; what isn't an object counts nothing."""
    take = lambda names: usage_tokens(*[F.get_json_object(usage, f"$.{n}") for n in names])
    return observed.withColumns({s: take(ALIASES[s]) for s in STREAMS}).drop(usage)


def work(prefix: str = "") -> Column:
    """Tokens of first-time content: input, cache written, output."""
    return F.col(f"{prefix}input") + F.col(f"{prefix}cache_write") + F.col(f"{prefix}output")


def account(usage: DataFrame) -> DataFrame:
    """Totals by unit, by stage, and over all, in one pass of grouping sets; null stands for "all" with grouping_level telling which."""
    sums = [F.sum(s).alias(s) for s in STREAMS]
    out = usage.groupingSets([["unit"], ["stage"], []], "unit", "stage").agg(*sums, F.grouping_id().alias("grouping_level"))
    return out.withColumn("work_tokens", work()).withColumn("reread_tokens", F.col("cache_read"))


def projection(usage: DataFrame, units: int, prices: dict[str, float] | None = None) -> DataFrame:
    """One row: mean work tokens an attributed unit, that times `units`, and its price a million tokens."""
    prices = prices or {}
    totals = usage.agg(*[F.sum(s).alias(s) for s in STREAMS], F.countDistinct("unit").alias("n_units"), F.sum(F.when(F.col("unit").isNotNull(), work())).alias("attributed"))
    mean = F.when(F.col("n_units") > 0, F.col("attributed") / F.col("n_units"))
    cost = sum((F.col(s) * F.lit(float(prices.get(s, 0.0))) for s in STREAMS), F.lit(0.0)) / 1e6
    return totals.select("n_units", work().alias("work_tokens"), half_even(mean, 1).alias("mean_per_unit"), half_even(mean * units, 0).cast("long").alias("projected"), half_even(cost, 4).alias("price"))


def fuse(usage: DataFrame, order: list[str], max_calls: int, max_tokens: int, scope: str | None = None) -> DataFrame:
    """Running calls and work tokens in order within each scope, and the ceiling that a row is the first to pass."""
    keys = [scope] if scope else []
    run = running(usage, [*[F.col(k).asc_nulls_first() for k in keys], *[F.col(c) for c in order]], {"calls": F.lit(1), "tokens": work()})
    if scope:
        # sums over all scopes, less what stood before each: a scope of any size is spread over ranges
        first = run.groupBy(scope).agg(F.min("calls").alias("_c"), F.min_by(F.col("tokens") - work(), "calls").alias("_t")).withColumnRenamed(scope, "_scope")
        run = run.join(first, run[scope].eqNullSafe(first["_scope"])).withColumn("calls", F.col("calls") - F.col("_c") + 1).withColumn("tokens", F.col("tokens") - F.col("_t")).drop("_scope", "_c", "_t")
    over = F.when(F.col("calls") > max_calls, "calls").when(F.col("tokens") > max_tokens, "tokens")
    first = (F.col("calls") == max_calls + 1) | ((F.col("tokens") > max_tokens) & (F.col("tokens") - work() <= max_tokens))
    return run.withColumn("tripped", over).withColumn("first_trip", over.isNotNull() & first)


def call_timeout(size: Column, base: float = 420, per_kb: float = 12, most: int = 1800) -> Column:
    """Seconds that one call on a source of `size` bytes may take; an unknown size counts as 40 kB."""
    kb = F.coalesce(size / F.lit(1024.0), F.lit(40.0))
    return F.least(F.floor(F.lit(float(base)) + kb * F.lit(float(per_kb))).cast("int"), F.lit(most))


def iso_utc(at: Column) -> Column:
    """ISO 8601 text of a timestamp in UTC (the session's time zone must be it); whole seconds have no fraction."""
    whole = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(at, "SSSSSS")
    return F.concat(whole, F.when(fraction != "000000", F.concat(F.lit("."), fraction)).otherwise(""), F.lit("+00:00"))


@dataclass
class Fuse:
    """Ceilings of a running job, counted on the driver; passing one raises, and it may only be raised on purpose."""

    max_calls: int
    max_tokens: int
    calls: int = 0
    tokens: int = 0

    @classmethod
    def from_environment(cls, env: Mapping[str, str] | None = None, calls: int = 400, tokens: int = 20_000_000) -> Fuse:
        """Ceilings from VERITAB_MAX_CALLS and VERITAB_MAX_TOKENS; what isn't a positive whole number leaves the default."""
        env = os.environ if env is None else env
        said = {k: env.get(f"VERITAB_MAX_{k.upper()}", "") for k in ("calls", "tokens")}
        read = {k: int(v) if v.strip().isdigit() and int(v) > 0 else None for k, v in said.items()}
        return cls(read["calls"] or calls, read["tokens"] or tokens)

    def record(self, tokens: int) -> None:
        self.calls += 1
        self.tokens += max(0, int(tokens))
        self.check()

    def check(self) -> None:
        for what, now, most in (("calls", self.calls, self.max_calls), ("tokens", self.tokens, self.max_tokens)):
            if now > most:
                raise FuseExceeded(what, now, most)

    def raise_ceiling(self, what: str, to: int) -> None:
        if to <= getattr(self, f"max_{what}"):
            raise ValueError("a ceiling can only be raised")
        setattr(self, f"max_{what}", to)

    def snapshot(self) -> dict[str, int]:
        return {"calls": self.calls, "tokens": self.tokens, "max_calls": self.max_calls, "max_tokens": self.max_tokens}


class FuseExceeded(RuntimeError):
    def __init__(self, what: str, now: int, most: int):
        super().__init__(f"{what}: {now} of at most {most}")
        self.what, self.now, self.most = what, now, most
