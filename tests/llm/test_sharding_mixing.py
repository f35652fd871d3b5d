from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from veritab.llm import mixing, sharding


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000])
def test_permutation_is_a_bijection(spark, n):
    got = [r["p"] for r in spark.range(n).select(sharding.permuted("id", n).alias("p")).collect()]
    assert sorted(got) == list(range(n))
    assert n < 64 or got != list(range(n))


def test_shards(awkward, clashing, nothing):
    rows = [tuple(r) for r in awkward.collect()]
    out = sharding.shards(awkward).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    slots = defaultdict(list)
    for r in out:
        assert 0 <= r["shard"] < 40 and r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(k, [])) for k in range(40)]
    assert max(counts) - min(counts) <= 1
    again = sharding.shards(clashing.orderBy(F.rand(1)).repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))
    assert sharding.shards(nothing).count() == 0


def brute_exponent(tokens: list[int], entropy: float, most: float) -> float:
    live = [t for t in tokens if t]
    total, lo, hi = sum(live), 0.0, 1.0

    def settled(x: float) -> bool:
        w = [(t / total) ** x for t in live]
        h = -sum(v / sum(w) * math.log(v / sum(w)) for v in w)
        return h <= entropy * math.log(len(live)) and (max(live) / min(live)) ** (1 - x) <= most

    for _ in range(45):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if settled(mid) else (mid, hi)
    return round(hi, 9)


def test_exponent(spark):
    for tokens in ([1000, 100, 10], [5, 5, 5], [7], [10_000, 9, 9, 9, 9, 0]):
        df = spark.createDataFrame([(t,) for t in tokens], "tokens long")
        for entropy, most in ((0.9, 2.0), (0.5, 50.0), (0.99, 1000.0)):
            if entropy * math.log(max(1, sum(t > 0 for t in tokens))) == 0 or len(set(tokens)) == 1:
                assert mixing.bisect_exponent(df, entropy, most) in (0.0, 1.0)
            else:
                assert mixing.bisect_exponent(df, entropy, most) == pytest.approx(brute_exponent(tokens, entropy, most), abs=2e-9)


@pytest.fixture(scope="module")
def uneven(spark):
    rows = [(k, " ".join(["w"] * (1 + k % 7)), "big" if k < 300 else f"s{k % 3}") for k in range(400)] + [(900, "", "blank"), (901, None, None), (902, "x y", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixture_meets_its_quotas(uneven):
    """Each source's tokens are its whole epochs and a prefix of the next, short of the quota by less than a document."""
    out = mixing.mixture(uneven, block=16).collect()
    tokens = Counter()
    for r in uneven.collect():
        tokens[r["source"]] += len((r["text"] or "").split())
    live = {s: t for s, t in tokens.items() if t}
    x = brute_exponent(list(live.values()), 0.9, 2.0)
    read, times = Counter(), defaultdict(Counter)
    for r in out:
        read[r["source"]] += r["tokens"]
        times[r["source"]][r["doc_id"]] += 1
    for s, t in live.items():
        quota = math.floor((t / max(live.values())) ** (x - 1) * t)
        assert 0 <= quota - read[s] < 7, s
        assert max(times[s].values()) - min(times[s].values()) <= 1
        assert min(times[s].values()) >= 1 and max(times[s].values()) <= 3
    assert times["blank"] == {900: 1} and set(times[None]) == {901, 902}
    mixed = mixing.mix_sources(uneven, block=16)
    assert mixed.columns == uneven.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(r["doc_id"] for r in out)


def test_budget(uneven):
    small = mixing.mixture(uneven, budget=300, block=16).collect()
    assert 260 <= sum(r["tokens"] for r in small) <= 300


def test_awkward(clashing, nothing):
    assert mixing.mix_sources(clashing).columns == clashing.columns
    assert mixing.mixture(nothing).count() == 0 and mixing.mix_sources(nothing).count() == 0
