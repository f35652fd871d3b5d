"""The registered queries of this folder, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm import embeddings, licences, linededup, minhash, mixing, packing, quality, sharding, spotsigs, toxicity
from veritab.llm.common import table

_SKEWED = "CASE WHEN doc_id % 10 < 6 THEN 'hot' WHEN doc_id % 10 < 8 THEN 'two' WHEN doc_id % 10 = 8 THEN 'one' ELSE NULL END"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_spotsigs_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edit_likeness(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_documents(table(spark, sf_dir, "documents"))


def op3_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_digests(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def mixing_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`op8` where one source holds six tenths of all rows, so that the exponent falls and epochs are partial."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.expr(_SKEWED).alias("source"))
    return mixing.mixture(docs)


def spotsigs_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of fingerprint classes of documents that are alike by 0.8: partitions of set length and pruned Jaccard."""
    return spotsigs.similar(table(spark, sf_dir, "documents"))[0].select("a", "b", F.round("likeness", 9).alias("likeness"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spotsigs_fingerprints": op1_spotsigs_fingerprints,
    "op2_license_scan": op2_license_scan,
    "op3_quality_attention": op3_quality_attention,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_sharding": op6_sharding,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_mixing": op8_mixing,
    "op9_line_dedup": op9_line_dedup,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "mixing_skewed": mixing_skewed,
    "spotsigs_links": spotsigs_links,
}

def _mixing_sql(docs: str) -> str:
    """SQL of `mixing.mixture` over a table or subquery of documents."""
    return f"""
WITH RECURSIVE light AS (
  SELECT doc_id AS id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS own FROM {docs}),
sums AS (SELECT source, sum(own)::BIGINT AS tokens, count(*) AS n FROM light GROUP BY source),
live AS (SELECT tokens / (SELECT sum(tokens) FROM sums) AS p, (SELECT max(tokens) / min(tokens) FROM sums WHERE tokens > 0) AS ratio, count(*) OVER () AS k FROM sums WHERE tokens > 0),
bisect(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN lo ELSE (lo + hi) / 2 END, CASE WHEN ok THEN (lo + hi) / 2 ELSE hi END
  FROM (SELECT step, lo, hi, (SELECT ln(sum(p ** ((lo + hi) / 2))) - (lo + hi) / 2 * sum(p ** ((lo + hi) / 2) * ln(p)) / sum(p ** ((lo + hi) / 2)) <= {mixing.ENTROPY} * ln(any_value(k)) AND any_value(ratio) ** (1 - (lo + hi) / 2) <= {mixing.MAX_EPOCHS} FROM live) AS ok FROM bisect WHERE step < 45)),
x AS (SELECT round(hi, 9) AS x FROM bisect WHERE step = 45),
top AS (SELECT max(tokens)::DOUBLE AS top, sum(tokens::DOUBLE ** x) AS z FROM sums, x WHERE tokens > 0),
quota AS (
  SELECT source, tokens, ceil(n / {mixing.BLOCK}.0)::BIGINT AS blocks, CASE WHEN tokens > 0 THEN round(tokens::DOUBLE ** x / z, 6) ELSE 0 END AS weight,
    CASE WHEN tokens > 0 THEN floor((tokens / top) ** (x - 1) * tokens)::BIGINT ELSE 0 END AS quota FROM sums, x, top),
whole AS (SELECT *, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS whole, CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS part FROM quota),
own AS (
  SELECT l.id, l.source, l.own, w.blocks, w.weight, w.whole, w.part, (('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', 'block', l.id)), 1, 12))::BIGINT % w.blocks)::INT AS block
  FROM light l JOIN whole w ON l.source IS NOT DISTINCT FROM w.source),
keyed AS (
  SELECT *, md5(concat_ws(':', '{mixing.SEED}', 'order', source, whole, block)) AS bk, md5(concat_ws(':', '{mixing.SEED}', 'doc', whole, id)) AS dk FROM own),
upto AS (SELECT *, sum(own) OVER (PARTITION BY source ORDER BY bk, block, dk, id) AS upto FROM keyed),
times AS (SELECT *, whole + CASE WHEN part > 0 AND upto <= part THEN 1 ELSE 0 END AS times FROM upto)
SELECT id AS doc_id, source, own AS tokens, unnest(range(0, times))::INT AS epoch, block, weight FROM times"""


def _sharding_sql() -> str:
    """SQL of `sharding.shards`: crc32 byte by byte with a table of its 256 steps, and the Feistel rounds walked one at a time."""
    steps = []
    for k in range(256):
        for _ in range(8):
            k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
        steps.append(k)
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + 16)::BIGINT AS size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: xor(({steps}::BIGINT[])[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) AS text_crc32 FROM documents),
n AS (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS a, ceil(count(*) / ceil(sqrt(count(*))))::BIGINT AS b FROM d),
rows_ AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS i FROM d),
walk(i, k, l, r) AS (
  SELECT i, 0, i % a, i // a FROM rows_, n
  UNION ALL
  SELECT i, CASE WHEN k = {sharding.ROUNDS} THEN 0 ELSE k + 1 END, CASE WHEN k = {sharding.ROUNDS} THEN (r * a + l) % a ELSE r END,
    CASE WHEN k = {sharding.ROUNDS} THEN (r * a + l) // a ELSE (l + ('0x' || substr(md5(concat_ws(':', '{sharding.SEED}', k, r)), 1, 12))::BIGINT) % (CASE WHEN k % 2 = 0 THEN a ELSE b END) END
  FROM walk, n WHERE NOT (k = {sharding.ROUNDS} AND r * a + l < n)),
place AS (SELECT i, r * a + l AS p FROM walk, n WHERE k = {sharding.ROUNDS} AND r * a + l < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % {sharding.SHARDS})::INT AS shard, p // {sharding.SHARDS} AS slot, NULL::INT AS grown_shard FROM rows_ JOIN place USING (i)"""


ORACLES: dict[str, str] = {
    "op4_embedding_near_dedup": """
WITH RECURSIVE vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM vec),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) >= 0.95),
reach(vec_id, seen) AS (
  SELECT a, a FROM link
  UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.seen),
root AS (SELECT vec_id, min(seen) AS component_id FROM reach GROUP BY vec_id),
links AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, coalesce(r.component_id, v.vec_id) AS component_id, coalesce(r.component_id, v.vec_id) = v.vec_id AS kept
FROM embeddings v LEFT JOIN links l ON l.a = v.vec_id LEFT JOIN root r ON r.vec_id = v.vec_id""",
    "op6_sharding": _sharding_sql(),
    "op8_mixing": _mixing_sql("documents"),
    "mixing_skewed": _mixing_sql(f"(SELECT doc_id, text, {_SKEWED} AS source FROM documents)"),
    "op9_line_dedup": rf"""
WITH line AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM line),
held AS (SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT doc_id, key FROM keyed WHERE length(key) >= 20) GROUP BY key HAVING count(*) >= 3),
marked AS (SELECT k.doc_id, k.i, k.line, h.last IS NULL OR h.last = k.doc_id AS stays FROM keyed k LEFT JOIN held h ON h.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op10_minhash_near_dedup": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, seen) AS (
  SELECT a, a FROM edge
  UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.seen),
root AS (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, coalesce(r.component_id, d.doc_id) AS component_id, coalesce(r.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN size z ON z.doc_id = d.doc_id LEFT JOIN root r ON r.doc_id = d.doc_id""",
}
