"""Queries of scalar rules, the gate's settings, page and table repair. Where a rule has no counterpart in SQL, rows are held against a fixed table of what they must be."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from veritab.functions import grounding, numbers
from veritab.functions import text as tx
from veritab.operators import agreement as ag
from veritab.operators import gate, graph, mapping, review, uncertainty
from veritab.plans.inputs import table
from veritab.plans.registry import query
from veritab.sources import pages, sidecar

_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "long": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}


def expected(shape: str, rows: list[tuple]) -> str:
    """SQL of a fixed table with the columns of `shape` ("name type, ...")."""
    names, kinds = zip(*(c.split() for c in shape.split(", ")))

    def literal(v) -> str:
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(f"CAST({literal(v)} AS {_TYPES[k]})" for v, k in zip(r, kinds)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(chr(34) + n + chr(34) for n in names)})"


def given(spark: SparkSession, shape: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, shape)


_MARKS = {0: "μM ", 1: "uM ", 2: "uM ", 3: "ｕM ", 4: "u­M ", 5: "mM "}


@query("agree_confusables", "SELECT p_partkey, p_partkey % 6 <> 5 AS agree, 'um ' || lower(p_name) AS key, regexp_replace(lower(p_name || p_brand), '[-:;,._\\s]+', '', 'g') AS bare FROM part")
def agree_confusables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro sign, Greek mu and the letter u are one sign, as are full-width letters and no-break spaces; opt-in, punctuation goes too."""
    other = F.lit("")
    for k, mark in _MARKS.items():
        other = F.when(F.col("p_partkey") % 6 == k, F.lit(mark)).otherwise(other)
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("µM "), "p_name").alias("a"), F.concat(other, "p_name").alias("b"), F.concat("p_name", F.lit(" - "), "p_brand", F.lit(".")).alias("c"))
    both = p.select("p_partkey", ag.comparable(F.col("a")).alias("a"), ag.comparable(F.col("b")).alias("b"), tx.normalize(F.col("c"), (*tx.DEFAULT_CHAIN, "no_punctuation")).alias("bare"))
    return both.select("p_partkey", ag.same(F.col("a"), F.col("b")).alias("agree"), F.col("a.key").alias("key"), "bare")


_NUMBERS = [
    ("12", 12.0, 12.0, 12, 12, 12), ("1,234.5 kg", 1234.5, None, None, None, None), ("−3.5", -3.5, None, None, None, None), ("4-methylphenol", None, None, None, None, None), ("3-5", None, None, None, 3, 5),
    ("5 to 3", 5.0, None, None, None, None), ("3 to 5", 3.0, None, None, 3, 5), ("1e3", 1000.0, 1000.0, None, None, None), ("nan", None, None, None, None, None), ("inf", None, None, None, None, None), (" 7.0 ", 7.0, 7.0, 7, 7, 7),
    (".5", None, 0.5, None, None, None), ("", None, None, None, None, None), ("+8", 8.0, 8.0, 8, 8, 8), ("12d", 12.0, None, None, None, None), ("IC50 12", None, None, None, None, None), ("0", 0.0, 0.0, 0, 0, 0), (None, None, None, None, None, None),
]
_NUMBER_SHAPE = "text string, number double, strict double, whole long, lo long, hi long"


@query("number_rules", expected(_NUMBER_SHAPE, _NUMBERS))
def number_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What counts as a number to each of the callers that ask."""
    t = F.col("text")
    rows = given(spark, "text string", [(r[0],) for r in _NUMBERS])
    return rows.select("text", numbers.as_number(t).alias("number"), numbers.safe_double(t).alias("strict"), numbers.whole_number(t).alias("whole"), numbers.count_or_range(t)["lo"].alias("lo"), numbers.count_or_range(t)["hi"].alias("hi"))


@query("expand_binomials", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Genus ' || lower(p_type) ELSE 'G. ' || lower(p_type) END AS expanded, p_partkey % 3 = 0 AS written_out FROM part")
def expand_binomials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An abbreviated genus is written out where another value of its group has the genus and the same rest."""
    kind = F.lower("p_type")
    other = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Genus "), kind)).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("Other "), kind)).otherwise(F.concat(F.lit("Genus un"), kind))
    names = ag.expand_binomials(F.array(F.concat(F.lit("G. "), kind), other))
    out = table(spark, sf_dir, "part").select("p_partkey", F.get(names, F.lit(0)).alias("expanded"))
    return out.withColumn("written_out", ~F.col("expanded").rlike(r"^[A-Z]\."))


_ANSWERS = [(1, "yyy", "supported", 1.0), (2, "nnn", "unsupported", 0.0), (3, "yny", "unstable", 0.0), (4, "y", "not_run", None), (5, "y-y", "supported", 1.0), (6, "y--", "not_run", None), (7, "", "not_run", None), (8, None, "not_run", None)]


@query("repeated_answers", expected("case long, answers string, state string, score double", _ANSWERS))
def repeated_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts asked several times: all alike, a mixture, or too few to say."""
    rows = given(spark, "case long, answers string", [r[:2] for r in _ANSWERS])
    told = F.transform(F.filter(F.split("answers", ""), lambda a: a != ""), lambda a: F.when(a != "-", a == "y"))
    return rows.withColumn("r", grounding.repeat_and_agree(told)).select("case", "answers", "r.state", "r.score")


_TITLES = [
    (1, "<i>E. coli</i> &amp; phages", "e coli phages", False, "<i>E. coli</i> &amp; phages"), (2, "Correction to: The Thing", "correction to the thing", True, "The Thing"), (3, "Erratum: A second look", "erratum a second look", True, "A second look"),
    (4, "  Growth, of 3 things. ", "growth of 3 things", False, "  Growth, of 3 things. "), (5, "", "", False, ""), (6, "Corrections of vision", "corrections of vision", False, "Corrections of vision"), (7, "RETRACTION NOTICE: Bad data", "retraction notice bad data", True, "NOTICE: Bad data"), (8, "Author Correction: A thing", "author correction a thing", True, "A thing"),
]


@query("title_rules", expected("case long, title string, key string, correction boolean, stripped string", _TITLES))
def title_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of titles, and what is a notice about another work."""
    t = F.col("title")
    rows = given(spark, "case long, title string", [r[:2] for r in _TITLES])
    return rows.select("case", "title", tx.title_key(t).alias("key"), tx.is_correction_title(t).alias("correction"), tx.strip_correction(t).alias("stripped"))


@query("title_ratios", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 1.0 WHEN p_partkey % 4 = 1 THEN 0.0 ELSE 2.0 * 10 / (10 + 20) END AS ratio, lower(p_brand) AS author FROM part")
def title_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sequence ratio by hand: equal texts, an empty one, and ten of ten signs found in twenty; and the first author's family name."""
    a = F.lit("abcdefghij")
    b = F.when(F.col("p_partkey") % 4 == 0, a).when(F.col("p_partkey") % 4 == 1, F.lit("")).otherwise(F.lit("abcdefghij0123456789"))
    people = F.array(F.when(F.col("p_partkey") % 2 == 0, F.concat("p_brand", F.lit(", A. B."))).otherwise(F.concat(F.lit("A. B. "), "p_brand")), F.lit("Other, C."))
    out = table(spark, sf_dir, "part").select("p_partkey", tx.sequence_ratio(a, b).alias("ratio"), tx.first_author(people).alias("author"), "p_brand")
    return out.select("p_partkey", "ratio", F.when(F.col("author") == F.regexp_replace(F.lower("p_brand"), "[^a-z]", ""), F.lower("p_brand")).alias("author"))


_NAMES = [
    (1, "PMC/12:3 é", "PMC_12_3__", "pmc_12_3"), (2, "  Boiling Point (°C) ", "__Boiling_Point___C__", "boiling_point_c"), (3, "3 rings", "3_rings", "p_3_rings"), (4, "a.b-c_d", "a.b-c_d", "a_b_c_d"),
]


@query("name_rules", expected("case long, name string, folder string, slug string", _NAMES))
def name_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source ids as folders, and labels as identifiers."""
    rows = given(spark, "case long, name string", [r[:2] for r in _NAMES])
    return rows.select("case", "name", tx.dirname(F.col("name")).alias("folder"), tx.slug(F.col("name")).alias("slug"))


_WORDS = [
    (1, "version", "v3", "v4"), (2, "version", "draft", "v2"), (3, "version", "v1.9", "v10"), (4, "clock", "01:02:03", "3723"), (5, "clock", "noon", None), (6, "smiles", "C[C@H](N)O", "isomeric"), (7, "smiles", "CCO", "flat"), (8, "smiles", None, None), (9, "smiles", "F/C=C/F", "isomeric"),
    (10, "tool", "mcp__store__gate_upsert", "gate_upsert:true"), (11, "tool", "db_query", "db_query:false"), (12, "tool", "db_upsert", "db_upsert:true"), (13, "surface", "ann [chat]", "chat"), (14, "surface", "ann", "unknown"), (15, "tag", "ann", "ann [chat]"), (16, "tag", "ann [chat]", "ann [chat]"), (17, "tag", None, " [chat]"),
]


@query("word_rules", expected("case long, rule string, given string, made string", _WORDS))
def word_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions, times of day in logs, stereochemistry, names of tools, and where a ruling came from."""
    g = F.col("given")
    made = (
        F.when(F.col("rule") == "version", tx.next_version(g)).when(F.col("rule") == "clock", tx.log_seconds(g).cast("string")).when(F.col("rule") == "smiles", tx.smiles_kind(g))
        .when(F.col("rule") == "tool", F.concat(tx.tool_name(g), F.lit(":"), tx.is_write_tool(g).cast("string"))).when(F.col("rule") == "surface", tx.surface_of(g)).otherwise(tx.tag_surface(g, "chat"))
    )
    return given(spark, "case long, rule string, given string", [r[:3] for r in _WORDS]).withColumn("made", made)


_STRAINS = [
    (1, "Bacillus subtilis ATCC 6633", "Bacillus subtilis", "collection", "subtilis", "Bacillus subtilis ATCC 6633|Bacillus subtilis|Bacillus"), (2, "Bacillus subtilis strain 168", "Bacillus subtilis", "strain", "subtilis", "Bacillus subtilis strain 168|Bacillus subtilis|Bacillus"),
    (3, "Bacillus cf. subtilis", "Bacillus subtilis", "qualifier", "subtilis", "Bacillus cf. subtilis|Bacillus subtilis|Bacillus"), (4, "Escherichia coli (K-12)", "Escherichia coli", "bracket", "coli", "Escherichia coli (K-12)|Escherichia coli|Escherichia"), (5, "Homo sapiens", "Homo sapiens", "", "sapiens", "Homo sapiens|Homo"),
]


@query("strain_rules", expected("case long, name string, folded string, rungs string, epithet string, candidates string", _STRAINS))
def strain_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organisms' names without strain-like parts, and the names to look up, from the full one to the genus."""
    n = F.col("name")
    fold = tx.fold_strain(n)
    rows = given(spark, "case long, name string", [r[:2] for r in _STRAINS])
    return rows.select("case", "name", fold["folded"].alias("folded"), F.array_join(fold["rungs"], "|").alias("rungs"), tx.species_epithet(n).alias("epithet"), F.array_join(tx.taxon_candidates(n), "|").alias("candidates"))


@query(
    "sentences",
    r"""WITH s AS (SELECT item_id, unnest(string_split_regex(text, '(?:[?!.])\s+')) AS s FROM benchmark) SELECT item_id, count(*) AS n_sentences FROM s GROUP BY item_id""",
)
def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of benchmark items: split at white space after a full stop, exclamation or question mark."""
    b = table(spark, sf_dir, "benchmark").select("item_id", tx.sentence_bounds(F.col("text")).alias("b"))
    return b.select("item_id", F.size("b").cast("long").alias("n_sentences"))


@query("composite_precedence", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 3 = 0 THEN l_discount WHEN l_partkey % 3 = 1 AND l_suppkey % 2 = 0 THEN l_tax WHEN l_linenumber % 2 = 0 THEN least(l_discount, l_tax) END AS composite FROM lineitem")
def composite_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given composite before a stamped one, that before the weakest field, and that only where all fields have a score."""
    given_ = F.when(F.col("l_partkey") % 3 == 0, F.col("l_discount"))
    stamped = F.when(F.col("l_partkey") % 3 == 1, F.when(F.col("l_suppkey") % 2 == 0, F.col("l_tax").cast("string")).otherwise("nan"))
    weakest = F.array(F.col("l_discount"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_tax")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", gate.resolve_composite(given_, stamped, weakest).alias("composite"))


_SETTINGS = [
    ("bar given", "0.8", "0.8"), ("bar by environment", "0.7", "0.7"), ("bar by a word", "high", "0.95"), ("bar negative", "-1", "0.95"), ("least given", "2", "2"), ("least declared", "4", "4"), ("least unknown", "", "0"),
    ("one pass, all well", "1", ""), ("one pass, ensemble signal", "1", "ensemble_signal_present"), ("one pass, nothing", "1", "no_completeness_minimum,grounding_not_checked"), ("three passes", "3", ""),
]


@query("gate_settings", expected("setting string, given string, resolved string", _SETTINGS))
def gate_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the bar and the completeness minimum come from, and what keeps a single pass from being trusted."""
    import os

    name = "VERITAB_BAR_OF_A_QUERY"

    def by_environment(said: str) -> str:
        os.environ[name] = said
        try:
            return str(gate.resolve_threshold(None, name))
        finally:
            del os.environ[name]

    guard = gate.single_pass_problems
    made = [
        str(gate.resolve_threshold(0.8)), by_environment("0.7"), by_environment("high"), by_environment("-1"), str(gate.resolve_min_populated(2, 4)), str(gate.resolve_min_populated(None, 4)), str(gate.resolve_min_populated(-1)),
        ",".join(guard(1, False, 2, True)), ",".join(guard(1, True, 2, True)), ",".join(guard(1, False, 0, False)), ",".join(guard(3, True, 0, False)),
    ]
    return given(spark, "setting string, given string, resolved string", [(s, g, m) for (s, g, _), m in zip(_SETTINGS, made)])


@query(
    "ruling_permission",
    """WITH e AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'moved' WHEN 2 THEN 'no_store' WHEN 3 THEN 'absent' ELSE 'past_end' END AS state, CASE o_custkey % 4 WHEN 0 THEN 'right' WHEN 1 THEN 'wrong' WHEN 2 THEN 'cant_tell' ELSE 'maybe' END AS verdict,
  CASE o_orderstatus WHEN 'F' THEN 'publishedVersion' WHEN 'O' THEN 'acceptedVersion' ELSE NULL END AS version FROM orders)
SELECT o_orderkey, verdict <> 'maybe' AND (verdict <> 'right' OR state IN ('exact', 'moved')) AS may_record, coalesce(version = 'publishedVersion', false) AS may_accept FROM e""",
)
def ruling_permission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rulings may be filed on what evidence, and which versions may be accepted by themselves."""
    o = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CASE o_orderkey % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'moved' WHEN 2 THEN 'no_store' WHEN 3 THEN 'absent' ELSE 'past_end' END AS state", "CASE o_custkey % 4 WHEN 0 THEN 'right' WHEN 1 THEN 'wrong' WHEN 2 THEN 'cant_tell' ELSE 'maybe' END AS verdict",
        "CASE o_orderstatus WHEN 'F' THEN 'publishedVersion' WHEN 'O' THEN 'acceptedVersion' ELSE NULL END AS version",
    )
    return o.select("o_orderkey", gate.may_record(F.col("verdict"), F.col("state")).alias("may_record"), gate.version_may_accept(F.col("version")).alias("may_accept"))


@query("focus_filter", "SELECT o_orderkey AS record_id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F'")
def focus_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that the judge supports and the gate still holds back."""
    c = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), F.when(F.col("o_orderpriority") == "1-URGENT", "supported").otherwise("partial").alias("judge_verdict"), F.when(F.col("o_orderstatus") == "F", "allowed").otherwise("denied").alias("decision"))
    return review.focus(c).select("record_id")


@query(
    "record_lines",
    """SELECT p_partkey, 'name = ' || p_name || CASE WHEN p_partkey % 2 = 0 THEN '; size: not reported' ELSE '' END AS claim,
  CASE WHEN p_partkey % 3 = 0 THEN 'doi=https://doi.org/10.1/' || CAST(p_partkey AS VARCHAR) ELSE '' END || CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN '|' ELSE '' END || CASE WHEN p_partkey % 2 = 0 THEN 'pmid=https://pubmed.ncbi.nlm.nih.gov/' || CAST(p_partkey AS VARCHAR) ELSE '' END AS links,
  CASE WHEN p_partkey % 5 = 0 THEN 'judge|unsure|see note' ELSE 'judge|see note' END AS why FROM part""",
)
def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record in one line, the links of its source, and why it stopped short."""
    k = F.col("p_partkey")
    fields = F.array(F.struct(F.lit("name").alias("field_name"), F.col("p_name").alias("value")), F.struct(F.lit("size").alias("field_name"), F.when(k % 2 == 0, "Not reported").alias("value")))
    links = review.source_links(F.when(k % 3 == 0, F.concat(F.lit("10.1/"), k.cast("string"))), F.lit(" "), F.when(k % 2 == 0, k.cast("string")))
    reasons = F.array(F.struct(F.lit("judge").alias("code"), F.lit(None).cast("string").alias("about")), F.struct(F.lit("judge").alias("code"), F.lit("x").alias("about")))
    why = review.why_short(reasons, F.when(k % 5 == 0, F.array(F.lit("unsure"))), F.lit("see note"))
    return table(spark, sf_dir, "part").select("p_partkey", review.claim_text(fields).alias("claim"), F.array_join(F.transform(links, lambda x: F.concat(x["kind"], F.lit("="), x["url"])), "|").alias("links"), F.array_join(why, "|").alias("why"))


_SHAPES = [
    (1, "red", False, "list[str]", "single_value"), (2, "red", True, "list[str]", ""), (3, "red that was seen with blue", True, "list[str]", "prose"), (4, "", True, "list[str]", ""), (5, "a; b", False, "str", "prose"), (6, "5", False, "float", ""), (7, "green", True, "list[enum]", "not_in_vocabulary"), (8, "one, two, three", False, "str", "prose"),
]


@query("shape_advisory", expected("case long, value string, is_list boolean, kind string, issues string", _SHAPES))
def shape_advisory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advice on values that don't look like their field: never a denial."""
    out = None
    for kind in sorted({r[3] for r in _SHAPES}):
        rows = given(spark, "case long, value string, is_list boolean, kind string", [r[:4] for r in _SHAPES if r[3] == kind])
        made = rows.withColumn("issues", F.array_join(mapping.shape_issues(F.array("value"), F.col("is_list"), kind, ["red", "blue"] if kind == "list[enum]" else None), ","))
        out = made if out is None else out.unionByName(made)
    return out


_PROVENANCE = [
    (1, "literature", "ab" * 32, None, None, 100, 80, 10, "q", None, "active", "", 0.8), (2, "literature", "xyz", "o:1", None, 100, None, None, "", None, "gone", "fingerprint_not_sha256,ontology_half_given,quote_missing,retention_half_given,source_status_unknown", None),
    (3, "structured", None, None, None, 10, 20, 25, None, None, None, "db_version_missing,offset_beyond_read,read_beyond_total", 1.0), (4, "structured", "AB" * 32, "o:1", "2", 0, 0, None, None, "v1", "retracted", "", 0.0),
]
_PROVENANCE_SHAPE = "case long, kind string, process_fingerprint string, ontology_id string, ontology_version string, source_chars_total long, source_chars_read long, char_offset long, verbatim_quote string, db_version string, source_status string, violations string, retained double"


@query("provenance_rules", expected(_PROVENANCE_SHAPE, _PROVENANCE))
def provenance_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that provenance rows break, and the share of a source that was read."""
    shape = ", ".join(_PROVENANCE_SHAPE.split(", ")[:-2])
    rows = given(spark, shape, [r[:-2] for r in _PROVENANCE])
    told = mapping.provenance_violations({c: F.col(c) for c in rows.columns})
    return rows.select("*", F.array_join(F.array_sort(told), ",").alias("violations"), mapping.retained_fraction(F.col("source_chars_read"), F.col("source_chars_total")).alias("retained"))


@query(
    "companion_fields",
    "SELECT 'price_' || r AS name, CASE r WHEN 'spread_type' THEN 'enum' WHEN 'n_group' THEN 'int' WHEN 'n_total' THEN 'int' ELSE 'float' END AS kind, CASE WHEN r IN ('spread', 'spread_lower', 'spread_upper') THEN 'EUR' END AS unit, r AS role FROM (SELECT unnest(['spread_type', 'spread', 'spread_lower', 'spread_upper', 'spread_level', 'n_group', 'n_total']) AS r)",
)
def companion_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven companions that a measured field declares, as its groups list them."""
    made = uncertainty.companion_fields("price", "EUR")
    roles = uncertainty.groups_of(made)["price"]
    assert uncertainty.companion_names({"price": roles}) == sorted(f["name"] for f in made)
    return given(spark, "name string, kind string, unit string, role string", [(roles[f["uncertainty_role"]], f["type"], f["unit"], f["uncertainty_role"]) for f in made])


_PARTIAL = [(1, "a", "uncertainty_group_partial:x:n_group,n_total"), (2, None, "")]


@query("partial_group", expected("case long, x string, reasons string", _PARTIAL))
def partial_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group that lacks roles is one reason, and only where its measured field is there."""
    roles = {r: f"x_{r}" for r in uncertainty.ROLES if not r.startswith("n_")}
    why = uncertainty.uncertainty_reasons({"x": F.col("x")}, {"x": roles})
    return given(spark, "case long, x string", [r[:2] for r in _PARTIAL]).withColumn("reasons", F.array_join(F.transform(why, lambda r: F.concat_ws(":", r["code"], r["about"])), ","))


_SAID = "'customer ' || translate(CAST(c_custkey AS VARCHAR(20)), '0123456789', 'abcdefghij') || ' is one of the respondents of ' || translate(CAST(c_custkey AS VARCHAR(20)), '0123456789', 'abcdefghij')"


@query(
    "page_assembly",
    f"""WITH c AS (SELECT c_nationkey, c_custkey, {_SAID} AS said, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer)
SELECT CAST(c_nationkey AS VARCHAR) AS source_id, ((any_value(n) - 1) // 2 + 2)::BIGINT AS n_pages, '1 Results of the survey' || chr(10) || chr(10) || string_agg(said, ' ' ORDER BY c_custkey) || chr(10) || chr(10) AS full_text,
  '1 Results of the survey' AS first_title, (25 + sum(length(said) + 1) + 1)::BIGINT AS section_end FROM c WHERE n > 4 GROUP BY c_nationkey""",
)
def page_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of pages joined into paragraphs: words wrapped with hyphens are whole again, running heads and page numbers are gone, the reference list is cut, headings are sections."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", (F.row_number().over(_by_nation()) - 1).alias("i"), F.count("*").over(_by_nation().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n")).where("n > 4")
    name = F.translate(F.col("c_custkey").cast("string"), "0123456789", "abcdefghij")
    halves = F.array(F.struct((F.col("i") % 2 * 2 + 10).alias("k"), F.concat(F.lit("customer "), name, F.lit(" is one of the respon-")).alias("t")), F.struct((F.col("i") % 2 * 2 + 11).alias("k"), F.concat(F.lit("dents of "), name).alias("t")))
    lines = c.select(F.col("c_nationkey").cast("string").alias("source_id"), (F.expr("i div 2") + 1).cast("int").alias("page"), F.explode(halves).alias("l")).select("source_id", "page", F.col("l.k").cast("int").alias("line_no"), F.col("l.t").alias("text"))
    last = lines.groupBy("source_id").agg(F.max("page").alias("last"))
    title = last.select("source_id", F.lit(1).alias("page"), F.lit(5).alias("line_no"), F.lit("1 Results of the survey").alias("text"))
    refs = last.select("source_id", (F.col("last") + 1).alias("page"), F.explode(F.array(F.struct(F.lit(10).alias("k"), F.lit("References").alias("t")), F.struct(F.lit(11).alias("k"), F.lit("A. Author, a title that is left out").alias("t")))).alias("l"))
    refs = refs.select("source_id", "page", F.col("l.k").alias("line_no"), F.col("l.t").alias("text"))
    every = last.select("source_id", F.explode(F.sequence(F.lit(1), F.col("last") + 1)).alias("page"))
    heads = every.select("source_id", "page", F.lit(1).alias("line_no"), F.lit("Journal of surveys").alias("text"))
    feet = every.select("source_id", "page", F.lit(99).alias("line_no"), (F.col("page") + 40).cast("string").alias("text"))
    whole = graph.checkpointed(lines.unionByName(title).unionByName(refs).unionByName(heads).unionByName(feet))  # read many times below
    made = pages.assemble(pages.clean_lines(whole)).join(last, "source_id")
    return made.select("source_id", (F.col("last") + 1).cast("long").alias("n_pages"), "full_text", F.get("sections", F.lit(0))["title"].alias("first_title"), F.get("sections", F.lit(0))["end"].cast("long").alias("section_end"))


def _by_nation() -> WindowSpec:
    return Window.partitionBy("c_nationkey").orderBy("c_custkey")


@query(
    "page_layout",
    """WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, o_orderkey % 2 AS side FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS source_id, count(*) FILTER (side <> before AND before IS NOT NULL) AS hops, count(*) FILTER (side = 0 AND before = 1) AS returns_, 2 * count(*) FILTER (o_orderkey % 7 = 0) AS overlapping
FROM (SELECT *, lag(side) OVER (PARTITION BY o_custkey ORDER BY k) AS before FROM o) GROUP BY o_custkey""",
)
def page_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of lines from tab-separated geometry: sideways hops, returns to the left column, and lines printed over another."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("k"))
    left = F.when(F.col("o_orderkey") % 2 == 0, 50).otherwise(550)
    row = lambda at, x, y: F.concat_ws("\t", F.lit("4"), F.lit("1"), x.cast("string"), y.cast("string"), F.lit("400"), F.lit("10"))
    wide = o.select(F.col("o_custkey").cast("string").alias("source_id"), F.col("k").alias("ord"), row("k", left, F.lit(100)).alias("tsv"))
    sheet = o.select(F.col("o_custkey").cast("string").alias("source_id")).distinct().select("source_id", F.lit(0).alias("ord"), F.lit("1\t1\t0\t0\t1000\t2000").alias("tsv"))
    words = sheet.select("source_id", F.lit(-1).alias("ord"), F.lit("level\tpage\tleft\ttop\twidth\theight").alias("tsv"))
    boxes = pages.geometry(wide.unionByName(sheet).unionByName(words))
    twice = o.where("o_orderkey % 7 = 0")
    spots = twice.select(F.col("o_custkey").cast("string").alias("source_id"), F.explode(F.array(F.col("k") * 2, F.col("k") * 2 + 1)).alias("ord"), F.col("k"))
    printed = spots.select("source_id", "ord", row("k", F.lit(50) + (F.col("ord") % 2) * 20, F.col("k") * 100).alias("tsv"))
    over = pages.overprints(pages.geometry(printed.unionByName(sheet)))
    hops, back = pages.column_hops(boxes), pages.column_returns(boxes)
    out = hops.join(back, ["source_id", "page"], "left").join(over, ["source_id", "page"], "left")
    return out.select("source_id", "hops", F.coalesce("returns", F.lit(0)).cast("long").alias("returns_"), F.coalesce("overlapping", F.lit(0)).cast("long").alias("overlapping"))


_HEADINGS = [
    (1, "1 Introduction", None, "1 Introduction", "1", 0), (2, "2.1 Strains used", "2", "2.1 Strains used", "2.1", 1), (3, "3.1 Strains used", "2", None, None, None), (4, "Materials and Methods", "1", "Materials and Methods", None, 0), (5, "IV. RESULTS OF ALL", None, "IV. RESULTS OF ALL", None, 0),
    (6, "12 samples were taken,", "11", None, None, None), (7, "2 Methods", "1.3", "2 Methods", "2", 0), (8, "a plain line", None, None, None, None),
]
_HEADING_SHAPE = "case long, line string, last string, title string, number string, depth int"


@query("heading_rules", expected(_HEADING_SHAPE, _HEADINGS))
def heading_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are headings after a given number: the next one, its first part, or the next of a level above."""
    made = [(c, line, last, *(pages.heading(line, last) or (None, None, None))) for c, line, last, *_ in _HEADINGS]
    return given(spark, _HEADING_SHAPE, made)


_REPEATS = [(1, "a|b|c|a|b|c", "a|b|c"), (2, "a|b|c|d", "a|b|c|d"), (3, "a|b|c|a|b|c|z", "a|b|c|z"), (4, "a|a|a|a", "a|a|a|a"), (5, "", "")]


@query("repeated_pages", expected("case long, lines string, kept string", _REPEATS))
def repeated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page whose lines are one block several times over keeps it once."""
    return given(spark, "case long, lines string, kept string", [(c, x, "|".join(pages.collapse_repeats(x.split("|")))) for c, x, _ in _REPEATS])


def _notes_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each nation whose values wear markers that footnotes define in their text, or several in one."""
    k = F.col("n_nationkey")
    body = "<tr><th>Name</th><th>Value</th></tr><tr><td>one</td><td>12.5a</td></tr><tr><td>two</td><td>13.5b</td></tr><tr><td rowspan='2'>three</td><td>14.5*</td></tr><tr><td>15.5</td></tr>"
    told = F.when(k % 3 == 0, "<fn><p>a Measured twice.</p></fn><fn><p>b Estimated.</p></fn>").when(k % 3 == 1, "<fn><label>a</label><p>Measured twice; b Estimated.</p></fn>").otherwise("<fn><p>Nothing to do with a value.</p></fn>")
    xml = F.concat(F.lit(f"<article><table-wrap><table>{body}</table><table-wrap-foot>"), told, F.lit("</table-wrap-foot></table-wrap></article>"))
    return table(spark, sf_dir, "nation").select(k.cast("string").alias("source_id"), xml.alias("xml"))


@query(
    "footnote_repair",
    """WITH n AS (SELECT n_nationkey AS k FROM nation)
SELECT CAST(k AS VARCHAR) AS source_id, label, text, label_source FROM n, (VALUES (0, 'a', 'Measured twice.', 'text'), (0, 'b', 'Estimated.', 'text'), (1, 'a', 'Measured twice;', 'markup'), (1, 'b', 'Estimated.', 'split'), (2, NULL, 'Nothing to do with a value.', 'none')) v(m, label, text, label_source) WHERE k % 3 = m""",
)
def footnote_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels read from the text of notes that lack one, and notes split along the series of their markers."""
    return sidecar.table_notes(_notes_xml(spark, sf_dir)).select("source_id", "label", "text", "label_source")


@query("cell_lookup", "SELECT CAST(n_nationkey AS VARCHAR) AS source_id, r::INT AS \"row\", c::INT AS col, t AS text FROM nation, (VALUES (1, 0, 'one'), (3, 0, 'three'), (4, 0, 'three'), (4, 1, '15.5'), (9, 9, NULL)) v(r, c, t)")
def cell_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell at a place of the grid: the one declared there, else one that spans it, else none."""
    xml = _notes_xml(spark, sf_dir)
    places = xml.select("source_id", F.lit(0).alias("table_ix"), F.explode(F.array(*[F.struct(F.lit(r).alias("row"), F.lit(c).alias("col")) for r, c in ((1, 0), (3, 0), (4, 0), (4, 1), (9, 9))])).alias("p")).select("source_id", "table_ix", "p.row", "p.col")
    return sidecar.cell_at(sidecar.table_cells(xml), places).drop("table_ix")
