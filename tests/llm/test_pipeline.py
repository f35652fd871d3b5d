"""The pipeline over a small corpus, against its operators done by hand."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_linededup import key_of

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's result, written and read again as the driver does."""
    at = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
        out.append((name, docs))
    return out


def test_columns(spark, stages):
    want = spark.read.parquet(f"{DATA}/documents.parquet").columns
    assert [n for n, _ in stages] == ["toxicity", "line_dedup", "minhash_near_dedup", "mixing", "best_fit_packing"]
    assert all(d.columns == want for _, d in stages[:-1])


def test_each_stage_works_on_what_was_kept(spark, stages):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    kept = [{r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()} for _, d in stages[:4]]
    assert set(kept[0]) < set(docs) and all(docs[i] == t for i, t in kept[0].items())
    holders = Counter(k for t in kept[0].values() for k in {key_of(x) for x in t.split("\n")} if len(k) >= 20)
    last = {k: max(i for i, t in kept[0].items() if k in {key_of(x) for x in t.split("\n")}) for k, n in holders.items() if n >= 3}
    stays = {i: "\n".join(x for x in t.split("\n") if last.get(key_of(x), i) == i) for i, t in kept[0].items()}
    emptied = {i for i, t in stays.items() if t != kept[0][i] and not t.strip()}
    assert emptied and kept[1] == {i: t for i, t in stays.items() if i not in emptied}  # all that an emptied one said stands in others
    again = Counter(k for t in kept[1].values() for k in {key_of(x) for x in t.split("\n")} if holders[k] >= 3)
    assert again and set(again.values()) == {1}
    assert set(kept[2]) < set(kept[1]) and all(kept[1][i] == t for i, t in kept[2].items())
    assert set(kept[3]) == set(kept[2])
    pieces = stages[-1][1].select("doc_id", "piece").collect()
    rows = stages[3][1].count()
    assert sum(r["piece"] == 0 for r in pieces) == rows


def test_labelled_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    left = {r["doc_id"] for r in stages[0][1].select("doc_id").collect()}
    toxic, clean = [i for i, t in labels.items() if t], [i for i, t in labels.items() if not t]
    assert sum(i in left for i in clean) >= 0.99 * len(clean)
    assert sum(i not in left for i in toxic) >= 0.6 * len(toxic)  # a third of a few hundred labels isn't fitted on


def test_awkward_tables_go_through(spark, nothing, clashing, tmp_path):
    """No rows; and nulls, repeats, rows without an id, and columns with names that operators use inside."""
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (nothing, clashing):
        now, want = docs, docs.columns
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
            if name != "best_fit_packing":
                assert now.columns == want
        rows = now.collect()
        assert len(rows) > 0 if docs is clashing else not rows
        assert not rows or None in {r["doc_id"] for r in rows}
