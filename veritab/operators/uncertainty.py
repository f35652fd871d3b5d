"""Uncertainty groups: a measured field with seven companions that say what its spread is."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.numbers import count_or_range, is_not_reported, strict_number
from veritab.functions.once import apart, once

ROLES = tuple("spread_type spread spread_lower spread_upper spread_level n_group n_total".split())
VALUE_ROLES = ROLES[1:5]
#: Values that each type of spread has.
USES = {"sd": ("spread",), "se": ("spread",), "ci": ("spread_lower", "spread_upper", "spread_level"), "iqr": ("spread_lower", "spread_upper"), "range": ("spread_lower", "spread_upper"), "not reported": ()}
#: Values that an unlabelled spread may have.
UNLABELLED = ("spread", "spread_lower", "spread_upper")


def companion(measured: str, role: str) -> str:
    return f"{measured}_{role}"


def companion_fields(measured: str, unit: str | None = None) -> list[dict]:
    """Declarations of the seven companions of a measured field."""
    kinds = {"spread_type": "enum", "n_group": "int", "n_total": "int"}
    return [{"name": companion(measured, r), "type": kinds.get(r, "float"), "unit": unit if r in VALUE_ROLES[:3] else None, "uncertainty_of": measured, "uncertainty_role": r, "enum": list(USES) if r == "spread_type" else None} for r in ROLES]


def groups_of(fields: list[dict]) -> dict[str, dict[str, str]]:
    """Measured field -> role -> companion, as a specification's fields declare them."""
    out: dict[str, dict[str, str]] = {}
    for f in fields:
        if f.get("uncertainty_of"):
            out.setdefault(f["uncertainty_of"], {})[f["uncertainty_role"]] = f["name"]
    return out


def companion_names(groups: Mapping[str, Mapping[str, str]]) -> list[str]:
    return sorted({name for roles in groups.values() for name in roles.values()})


def _none() -> Column:
    return F.expr("cast(array() as array<struct<code:string,about:string>>)")


@dataclass(frozen=True)
class _Rule:
    """A reason and when it holds."""

    cond: Column
    code: str
    about: str

    def holds(self) -> Column:
        return F.coalesce(self.cond, F.lit(False))

    def reason(self) -> Column:
        """An array of the reason, or of none: arrays are put one after another without a lambda."""
        return F.when(self.holds(), F.array(F.struct(F.lit(self.code).alias("code"), F.lit(self.about).alias("about")))).otherwise(_none())


def uncertainty_reasons(value_of: Mapping[str, Column], groups: Mapping[str, Mapping[str, str]]) -> Column:
    """Reasons why declared groups don't hold, for columns of field values (string; null: the field is absent).

    A group counts only where its measured field is there. Absent, "not
    reported" and 0 are three different answers.
    """
    found = [_group_reasons(measured, groups[measured], value_of) for measured in sorted(groups)]
    return F.concat(*found) if found else _none()


def with_uncertainty(rows: DataFrame, value_of: Mapping[str, Column], groups: Mapping[str, Mapping[str, str]], into: str = "uncertainty") -> DataFrame:
    """`rows` with the array of `uncertainty_reasons`, and in `<into>_codes` their sorted codes between commas, null without any.

    Parsed values are columns of a step of their own.
    """
    kept, rules, parsed = rows.columns, [], {}
    for k, measured in enumerate(sorted(groups)):
        if _gaps(groups[measured]):
            rules.append(_partial(measured, groups[measured], value_of))
        else:
            own = _parsed(measured, groups[measured], value_of)
            parsed |= {f"_u{k}_{name}": apart(c, value_of[measured]) if name == "kind" else c for name, c in own.items()}
            rules += _rules(measured, groups[measured], _Columns(f"_u{k}_"))
    if not rules:
        return rows.withColumns({into: _none(), f"{into}_codes": F.lit(None).cast("string")})
    by = value_of[sorted(groups)[0]]
    codes = F.concat_ws(",", F.sort_array(F.array(*[F.when(r.holds(), F.lit(r.code)) for r in rules])))
    return rows.withColumns(parsed).select(*kept, apart(F.concat(*[r.reason() for r in rules]), by).alias(into), apart(F.nullif(codes, F.lit("")), by).alias(f"{into}_codes"))


class _Columns:
    """Parsed values that are columns with a common prefix."""

    def __init__(self, prefix: str):
        self.prefix = prefix

    def __getitem__(self, name: str) -> Column:
        return F.col(f"{self.prefix}{name}")


def _gaps(roles: Mapping[str, str]) -> list[str]:
    return [r for r in ROLES if r not in roles]


def _partial(measured: str, roles: Mapping[str, str], value_of: Mapping[str, Column]) -> _Rule:
    return _Rule(value_of[measured].isNotNull(), "uncertainty_group_partial", f"{measured}:{','.join(_gaps(roles))}")


def _parsed(measured: str, roles: Mapping[str, str], value_of: Mapping[str, Column]) -> dict[str, Column]:
    v = {r: value_of.get(roles[r], F.lit(None).cast("string")) for r in ROLES}
    out = {"here": value_of[measured].isNotNull(), "kind": F.lower(F.trim(v["spread_type"]))}
    for r in ROLES:
        out |= {f"{r}_there": v[r].isNotNull(), f"{r}_told": v[r].isNotNull() & ~is_not_reported(v[r])}
    out |= {f"{r}_count": F.when(v[r].isNotNull(), count_or_range(v[r])) for r in ("n_group", "n_total")}
    return out | {f"{r}_number": F.coalesce(strict_number(v[r]), F.lit(None).cast("double")) for r in VALUE_ROLES}


def _group_reasons(measured: str, roles: Mapping[str, str], value_of: Mapping[str, Column]) -> Column:
    """Reasons of one group. Every value is parsed once; the rules then read the parsed struct."""
    if _gaps(roles):
        return _partial(measured, roles, value_of).reason()
    parsed = F.struct(*[c.alias(name) for name, c in _parsed(measured, roles, value_of).items()])
    return once(parsed, lambda p: F.concat(*[r.reason() for r in _rules(measured, roles, p)]))


def _rules(measured: str, roles: Mapping[str, str], p: Column | _Columns) -> list[_Rule]:
    here, kind = p["here"], p["kind"]
    known = F.coalesce(kind.isin(list(USES)), F.lit(False))
    there = {r: p[f"{r}_there"] for r in ROLES}
    told = {r: p[f"{r}_told"] for r in ROLES}
    rules = [_Rule(here & ~there["spread_type"], "uncertainty_absent", roles["spread_type"]), _Rule(here & there["spread_type"] & ~known, "uncertainty_type_unknown", roles["spread_type"])]
    counts = {}
    for r in ("n_group", "n_total"):
        lo, hi = p[f"{r}_count"]["lo"], p[f"{r}_count"]["hi"]
        zero, fits = F.coalesce((lo == 0) & (hi == 0), F.lit(False)), F.coalesce(lo >= 1, F.lit(False))
        rules.append(_Rule(here & ~there[r], "uncertainty_absent", roles[r]))
        rules.append(_Rule(here & told[r] & zero, "uncertainty_zero_count", roles[r]))
        rules.append(_Rule(here & told[r] & ~zero & ~fits, "uncertainty_count_unreadable", roles[r]))
        counts[r] = F.when(told[r] & fits & (lo == hi), lo)
    rules.append(_Rule(here & (counts["n_group"] > counts["n_total"]), "uncertainty_group_above_total", measured))
    number = {}
    for r in VALUE_ROLES:
        wanted = kind.isin([t for t, uses in USES.items() if r in uses])
        loose = (kind == "not reported") & F.lit(r in UNLABELLED)
        read = known & (wanted | loose) & told[r]
        rules.append(_Rule(here & known & wanted & ~there[r], "uncertainty_absent", roles[r]))
        rules.append(_Rule(here & known & ~wanted & ~loose & there[r], "uncertainty_value_without_use", roles[r]))
        rules.append(_Rule(here & read & p[f"{r}_number"].isNull(), "uncertainty_unreadable", roles[r]))
        number[r] = F.when(read, p[f"{r}_number"])
    rules.append(_Rule(here & (number["spread"] < 0), "uncertainty_negative", roles["spread"]))
    rules.append(_Rule(here & (number["spread_lower"] > number["spread_upper"]), "uncertainty_limits_crossed", measured))
    rules.append(_Rule(here & (kind == "not reported") & (there["spread_lower"] != there["spread_upper"]), "uncertainty_half_interval", measured))
    rules.append(_Rule(here & ((number["spread_level"] <= 0) | (number["spread_level"] >= 100)), "uncertainty_level", roles["spread_level"]))
    return rules
