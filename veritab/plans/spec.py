"""Specification and ratification: what a project has agreed on, checked on the driver, and the run that follows from it."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.operators.mapping import typed
from veritab.operators.uncertainty import ROLES, companion_names, groups_of

ACCEPTED = ("accepted", "accepted_with_edit")
STATUSES = (*ACCEPTED, "proposed", "rejected")
TASKS = ("regression", "classification", "ranking", "retrieval", "generation")
#: Keys of a run that don't change what it computes.
VOLATILE = ("run_id", "run_timestamp", "out_dir", "db", "contact")


class SpecError(ValueError):
    """A specification that can't be frozen; `problems` lists all that is wrong."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


@dataclass(frozen=True)
class Spec:
    question: str
    task: str | None
    unit: str
    fields: tuple[dict, ...]
    ledger: tuple[dict, ...]
    scope: dict = field(default_factory=dict)
    gold_set: dict | None = None
    negative_policy: str | None = None

    @classmethod
    def load(cls, given: str | Path | dict) -> Spec:
        """From a JSON file or a mapping; raises SpecError with every problem found."""
        d = given if isinstance(given, dict) else json.loads(Path(given).read_text())
        ledger = d.get("ledger", {})
        spec = cls(d.get("research_question", ""), d.get("ml_task"), d.get("unit_of_analysis", ""), tuple(d.get("fields", ())), tuple(ledger.get("items", ()) if isinstance(ledger, dict) else ledger), d.get("source_scope", {}), d.get("gold_set"), d.get("negative_data_policy"))
        if problems := spec.problems():
            raise SpecError(problems)
        return spec

    @property
    def ratified(self) -> set[str]:
        return {i["item_id"] for i in self.ledger if i.get("status") in ACCEPTED}

    @property
    def open_items(self) -> list[dict]:
        return [i for i in self.ledger if i.get("status") == "proposed"]

    def problems(self) -> list[str]:
        out = [f"ledger item {i.get('item_id')}: unknown status" for i in self.ledger if i.get("status") not in STATUSES]
        out += [f"ledger item {i['item_id']}: an edit needs a note" for i in self.ledger if i.get("status") == "accepted_with_edit" and not (i.get("edit_note") or "").strip()]
        out += [f"field {f['name']} isn't ratified" for f in self.fields if f"field:{f['name']}" not in self.ratified and f["name"] not in self.ratified]
        if self.task is not None and self.task not in TASKS:
            out.append(f"unknown task {self.task}")
        if "literature" in self.scope.get("adapters", ()) and not any(q.get("executable") and q.get("item_id") in self.ratified for q in self.scope.get("queries", ())):
            out.append("a literature corpus needs a ratified query that can be run")
        if self.gold_set and self.gold_set.get("item_id") not in self.ratified:
            out.append("the gold set isn't ratified")
        if self.gold_set and self.gold_set.get("calibrates") and not self.gold_set.get("independent_of_benchmark"):
            out.append("a bar can't be calibrated on the benchmark it is judged by")
        kinds = {f["name"]: f.get("type") for f in self.fields}
        for f in self.fields:
            if bool(f.get("uncertainty_of")) != bool(f.get("uncertainty_role")):
                out.append(f"field {f['name']}: a companion names its field and its role")
        for measured, roles in self.uncertainty_groups.items():
            if kinds.get(measured) not in ("float", "int"):
                out.append(f"uncertainty of {measured}: no numeric field of that name")
            if gaps := [r for r in ROLES if r not in roles]:
                out.append(f"uncertainty of {measured}: no {', '.join(gaps)}")
        return out

    @property
    def uncertainty_groups(self) -> dict[str, dict[str, str]]:
        return groups_of(list(self.fields))

    @property
    def companions(self) -> list[str]:
        return companion_names(self.uncertainty_groups)

    def schema(self) -> T.StructType:
        """One typed column for each ratified field."""
        kinds = {"float": T.DoubleType(), "int": T.LongType(), "bool": T.BooleanType()}
        return T.StructType([T.StructField(f["name"], T.ArrayType(T.StringType()) if f.get("type", "").startswith("list") else kinds.get(f.get("type"), T.StringType())) for f in self.fields])

    def typed_view(self, wide: DataFrame, keys: list[str]) -> DataFrame:
        """Wide field values as their declared types; `mapping_invalid` names those that don't fit, which become null and not a failed job."""
        def bad(f: dict) -> Column:
            return F.when(F.col(f["name"]).isNotNull() & typed(F.col(f["name"]), f.get("type", "str")).isNull(), F.lit(f["name"]))

        wrong = F.filter(F.array(*[bad(f) for f in self.fields]), lambda n: n.isNotNull())
        return wide.select(*keys, *[typed(F.col(f["name"]), f.get("type", "str")).alias(f["name"]) for f in self.fields], wrong.alias("mapping_invalid"))

    def context(self) -> str:
        """The specification as text for an extractor: one line a field, companions under their field."""
        lines = [self.question, f"Unit: {self.unit}"]
        for f in self.fields:
            if not f.get("uncertainty_of"):
                more = [x for x in (f.get("unit") and f"in {f['unit']}", f.get("enum") and "one of " + ", ".join(f["enum"]), f.get("valid_range") and "within {} to {}".format(*f["valid_range"])) if x]
                lines.append(f"- {f['name']} ({f.get('type', 'str')})" + "".join(f"; {m}" for m in more))
                lines += [f"  - {name}: {role}" for role, name in self.uncertainty_groups.get(f["name"], {}).items()]
        return "\n".join(lines)

    def bar_provenance(self) -> str:
        """Where the accept bar comes from."""
        g = self.gold_set or {}
        return f"calibrated on {g.get('n', 0)} ruled records" if g.get("calibrates") else "not calibrated: the default bar"


def config_hash(config: dict) -> str:
    """Sixteen hexadecimal digits of a configuration without its volatile keys."""
    return hashlib.sha256(json.dumps({k: v for k, v in config.items() if k not in VOLATILE}, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:16]


def fingerprint(parts: Column) -> Column:
    """SHA-256 of a process description."""
    return F.sha2(parts, 256)


def parse_proposal(draft: dict) -> list[dict]:
    """Ledger items, all proposed, from a drafted specification: fields, rules, queries and policy, each with an id of its own."""
    items: list[dict] = []
    for kind, rows in (("field", draft.get("fields", [])), ("inclusion_rule", draft.get("inclusion_rules", [])), ("corpus_query", draft.get("queries", [])), ("gold_set", [draft["gold_set"]] if draft.get("gold_set") else [])):
        for k, row in enumerate(rows):
            row = row if isinstance(row, dict) else {"text": row}
            name = "_".join(re.findall("[0-9a-z]+", str(row.get("name") or row.get("text") or row.get("query") or k).lower())) or str(k)
            items.append({"item_id": f"{kind}:{name}", "kind": kind, "summary": str(row.get("summary") or row.get("text") or row.get("query") or name), "status": "proposed", "payload": row})
    seen: dict[str, int] = {}
    for i in items:
        n = seen[i["item_id"]] = seen.get(i["item_id"], 0) + 1
        if n > 1:
            i["item_id"] = f"{i['item_id']}_{n}"
    return items


def default_rulings(items: list[dict]) -> dict[str, dict]:
    """A ruling to start from for each item; nothing is accepted by default."""
    return {i["item_id"]: {"status": "proposed", "edit_note": None, "payload": i["payload"]} for i in items}


def build_spec(items: list[dict], rulings: dict[str, dict], **about) -> Spec:
    """Freeze what was accepted. An edited item must say why; an item whose payload changed was edited, whatever its ruling says."""
    ledger, fields, queries, gold = [], [], [], None
    for i in items:
        r = rulings.get(i["item_id"], {"status": "proposed"})
        changed = r.get("payload", i["payload"]) != i["payload"]
        status = "accepted_with_edit" if changed and r["status"] == "accepted" else r["status"]
        ledger.append({**i, "status": status, "edit_note": r.get("edit_note"), "payload": r.get("payload", i["payload"])})
        if status in ACCEPTED:
            p = r.get("payload", i["payload"])
            if i["kind"] == "field":
                fields.append(p)
                ledger[-1]["item_id"] = f"field:{p['name']}"
            elif i["kind"] == "corpus_query":
                queries.append({**p, "item_id": i["item_id"], "executable": bool(p.get("query"))})
            elif i["kind"] == "gold_set":
                gold = {**p, "item_id": i["item_id"]}
    return Spec.load({"research_question": about.get("question", ""), "ml_task": about.get("task"), "unit_of_analysis": about.get("unit", ""), "fields": fields, "ledger": ledger, "source_scope": {"adapters": ["literature"] if queries else [], "queries": queries}, "gold_set": gold})


def the_query(spec: Spec) -> str:
    """The one ratified literature query; none or several are an error."""
    own = [q["query"] for q in spec.scope.get("queries", ()) if q.get("item_id") in spec.ratified and q.get("query")]
    if len(own) != 1:
        raise SpecError([f"{len(own)} ratified queries where one is needed"])
    return own[0]


def plan(spec: Spec, passes: int = 3, bar: float = 0.95, identity: dict | None = None, lane: list[str] | None = None, audit: float = 0.1, **more) -> dict:
    """The configuration of a run, with its hash."""
    names = [f["name"] for f in spec.fields]
    config = {
        "ensemble_k": passes, "auto_accept_threshold": bar, "identity": identity or {}, "fields": names, "uncertainty": spec.uncertainty_groups, "companions": spec.companions,
        "review_lane": sorted(lane or [f["name"] for f in spec.fields if f.get("auto_acceptable") is False]), "locked_fields": sorted(f["name"] for f in spec.fields if f.get("locked")), "judge_audit_fraction": audit, "require_contradiction_search": True, **more,
    }
    return {**config, "config_hash": config_hash(config)}


def preflight(config: dict, spec: Spec | None = None) -> list[str]:
    """Everything that would make a run fail or mean something else: empty when it may start."""
    out = []
    k = config.get("ensemble_k")
    if not isinstance(k, int) or k < 1:
        out.append("ensemble_k must be a whole number of at least 1")
    if not 0 <= config.get("auto_accept_threshold", 0.95) <= 1:
        out.append("auto_accept_threshold must lie in [0, 1]")
    if not 0 <= config.get("judge_audit_fraction", 0) <= 1:
        out.append("judge_audit_fraction must lie in [0, 1]")
    if config.get("weights_key") not in (None, "numeric", "default"):
        out.append(f"unknown weights_key {config['weights_key']}")
    names = set(config.get("fields", ()))
    out += [f"{key}: {n} isn't a field" for key in ("review_lane", "locked_fields") for n in config.get(key, ()) if n not in names]
    if both := set(config.get("review_lane", ())) & set(config.get("locked_fields", ())):
        out.append(f"locked and in the review lane: {', '.join(sorted(both))}")
    for kind, declared in (config.get("identity") or {}).items():
        chain = declared.get("chain", declared) if isinstance(declared, dict) else declared
        levels = [chain] if isinstance(chain, str) else chain
        out += [f"identity of {kind}: {n} isn't a field" for level in levels for n in ([level] if isinstance(level, str) else level) if names and n not in names and n != "anchor_sentence"]
    if k == 1 and not config.get("min_populated"):
        out.append("a single pass needs a completeness minimum")
    if spec is not None:
        out += [f"{i['item_id']} is still open" for i in spec.open_items]
    return out


def missing_stores(papers: DataFrame, stores: DataFrame) -> DataFrame:
    """Papers of a run that have no store."""
    return papers.join(stores.select("source_id").distinct(), "source_id", "left_anti")


def parse_themes(reply: dict, known: set[str]) -> list[dict]:
    """Themes of a reply that cite claims which exist; others are left out."""
    out = []
    for t in reply.get("themes", ()):
        cited = [c for c in t.get("claims", ()) if c in known]
        if t.get("name") and cited:
            out.append({"theme": t["name"], "definition": t.get("definition", ""), "claims": cited})
    return out


def freeze_themes(spec: dict, themes: list[dict], version: str) -> dict:
    """A specification with its ratified themes as the vocabulary of a theme field, under the next version."""
    number = re.search(r"(\d+)(?!.*\d)", version)
    new = {"name": "theme", "type": "enum", "enum": sorted({t["theme"] for t in themes})}
    item = {"item_id": "field:theme", "kind": "field", "summary": "theme", "status": "accepted", "payload": new}
    rest = [f for f in spec.get("fields", ()) if f["name"] != "theme"]
    ledger = [i for i in (spec.get("ledger") or dict(items=()))["items"] if i["item_id"] != "field:theme"]
    return {**spec, "version": f"v{int(number[1]) + 1 if number else 2}", "fields": [*rest, new], "ledger": {"items": [*ledger, item]}}
