"""Severity of toxicity by cumulative-link ordinal regression on sparse text features.

Features are hashed words and word beginnings of three to eight letters, so that
a stem is known in inflections that weren't seen. Labels mark documents only as
toxic or not; grades 1 to 3 of toxic ones come from their evidence: how often
features occur that are far more frequent in toxic documents, cut at terciles.

P(grade >= k) = sigmoid(w . x - t_k) with one w for all k and t_1 < t_2 < t_3;
the expected severity is the sum of the three, and a document is toxic where
P(grade >= 1) is at least one half.

Feature counts are summed in the tasks; at most 2^18 sums, and the few features
that are kept of at most FIT_ROWS documents, reach the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import cut, doc_texts, prepare, sliced, texts_of, without_ids
from veritab.llm.labelled import sample

#: Labelled rows that are fitted on at most.
FIT_ROWS = 12_000
SPACE, KEPT, LEAST_DOCS, GRADES = 1 << 18, 1500, 3, 3
#: Likelihood-ratio statistic under which a feature isn't kept, and log-odds from which it counts as evidence.
LEAST_G2, STRONG = 12.0, 3.0
STEPS, RIDGE = 400, 5e-5
_WORD = re.compile(r"\w+")
_CACHE: dict[str, tuple[int, ...]] = {}


def _word_features(word: str) -> tuple[int, ...]:
    found = _CACHE.get(word)
    if found is None:
        if len(_CACHE) > 200_000:
            _CACHE.clear()
        own = ["w" + word] + ["p" + word[:n] for n in range(3, 9) if len(word) >= n]
        found = _CACHE[word] = tuple(xxhash.xxh32_intdigest(x) % SPACE for x in own)
    return found


def features(text: str | None) -> Counter:
    """Feature number -> occurrences in the whole text."""
    out: Counter = Counter()
    for word, n in Counter(_WORD.findall((text or "").lower())).items():
        for f in set(_word_features(word)):
            out[f] += n
    return out


class KeptWords:
    """Counts of some features only. Most words have none of them: sets of words tell them apart, so only the others are looped over."""

    def __init__(self, kept: Iterable[int], most: int = 300_000):
        self.kept, self.most = frozenset(kept), most
        self.known: set[str] = set()
        self.live: dict[str, tuple[int, ...]] = {}

    def counts(self, text: str | None) -> dict[int, int]:
        """Feature number -> occurrences in the whole text, for the kept features."""
        words = Counter(_WORD.findall((text or "").lower()))
        new = words.keys() - self.known
        if new:
            if len(self.known) > self.most:
                self.known, self.live, new = set(), {}, set(words)
            self.known |= new
            for word in new:
                if hits := self.kept.intersection(_word_features(word)):
                    self.live[word] = tuple(hits)
        out: dict[int, int] = {}
        for word in words.keys() & self.live.keys():
            n = words[word]
            for f in self.live[word]:
                out[f] = out.get(f, 0) + n
        return out


@dataclass(frozen=True)
class Severity:
    """A fitted model: sorted feature numbers, their weights, and the thresholds."""

    numbers: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. as columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -40, 40)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        known = dict(zip(self.numbers.tolist(), self.weights.tolist()))
        words = KeptWords(known)
        return np.array([sum(known[f] * (1 + np.log(n)) for f, n in sorted(words.counts(text).items())) for text in texts], dtype=np.float64)


NOTHING = Severity(np.empty(0, np.int64), np.empty(0), np.full(GRADES, 40.0))


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = np.zeros((2, SPACE), dtype=np.int64)
    for batch in sliced(batches):
        for label, text in zip(batch.column(0).to_pylist(), texts_of(batch, 1)):
            own = set().union(*map(_word_features, set(_WORD.findall((text or "").lower()))))
            docs[int(label > 0), np.fromiter(own, np.int64, len(own))] += 1
    at = np.flatnonzero(docs.any(axis=0))
    for k in range(0, len(at), 65536):
        part = at[k : k + 65536]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(docs[0, part]), pa.array(docs[1, part])], ["feature", "clean", "toxic"])


def _kept_counts(numbers: np.ndarray):
    keep = numbers.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = KeptWords(keep)
        for batch in sliced(batches):
            rows = [sorted(words.counts(t).items()) for t in texts_of(batch, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[f for f, _ in r] for r in rows], pa.list_(pa.int64())), pa.array([[n for _, n in r] for r in rows], pa.list_(pa.int64()))], ["label", "features", "counts"]
            )

    return run


def _g2(a: np.ndarray, n: int, b: np.ndarray, m: int) -> np.ndarray:
    """Likelihood-ratio statistic of a in n against b in m."""
    p = (a + b) / (n + m)

    def part(x, e):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-12) / np.maximum(e, 1e-12)), 0)

    return 2 * (part(a, n * p) + part(n - a, n * (1 - p)) + part(b, m * p) + part(m - b, m * (1 - p)))


def fit_ordinal(rows: list[list[int]], values: list[np.ndarray], grades: np.ndarray, width: int, top: int, steps: int = STEPS, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """(weights, increasing thresholds) of a cumulative-link model by full-batch Adam; deterministic."""
    sizes = np.array([len(r) for r in rows])
    col = np.concatenate([np.asarray(r, np.int64) for r in rows]) if sizes.sum() else np.empty(0, np.int64)
    val = np.concatenate(values) if sizes.sum() else np.empty(0)
    row = np.repeat(np.arange(len(rows)), sizes)
    share = [(grades >= k).mean() for k in range(1, top + 1)]
    theta = np.array([np.log((1 - s + 1e-3) / (s + 1e-3)) for s in share])
    params = np.concatenate([np.zeros(width), theta[:1], np.log(np.maximum(np.diff(theta), 0.05))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, first, gaps = params[:width], params[width], np.exp(params[width + 1 :])
        t = first + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(row, weights=val * w[col], minlength=len(rows))
        above = 1 / (1 + np.exp(np.clip(t[None, :] - eta[:, None], -40, 40)))
        full = np.hstack([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))])
        at = np.arange(len(rows))
        p = np.maximum(full[at, grades] - full[at, grades + 1], 1e-12)
        slope = full * (1 - full)
        up, down = slope[at, grades] / p, slope[at, grades + 1] / p  # d log p / d eta is up - down
        grad_eta = -(up - down)
        grad_t = np.zeros(top)
        for k in range(1, top + 1):
            grad_t[k - 1] = (up * (grades == k) - down * (grades + 1 == k)).sum()
        g = np.empty_like(params)
        g[:width] = np.bincount(col, weights=val * grad_eta[row], minlength=width) / len(rows) + ridge * w
        tail = np.cumsum(grad_t[::-1])[::-1] / len(rows)
        g[width], g[width + 1 :] = tail[0], tail[1:] * gaps
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - 0.1 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return params[:width], params[width] + np.concatenate([[0.0], np.cumsum(np.exp(params[width + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Severity:
    """Fit on at most `rows` labelled documents outside the held-out fold. Without both classes nothing is toxic."""
    prepare(docs.sparkSession)
    own = sample(docs, labels, "toxic", rows)
    size = {int(r[0]): r[1] for r in own.groupBy((F.col("label") > 0).cast("int")).count().collect()}
    clean, toxic = size.get(0, 0), size.get(1, 0)
    if not clean or not toxic:
        return NOTHING
    found = own.mapInArrow(_document_counts, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= LEAST_DOCS).toPandas().sort_values("feature")
    a, b = found["toxic"].to_numpy(np.float64), found["clean"].to_numpy(np.float64)
    g2, odds = _g2(a, toxic, b, clean), np.log((a + 0.5) / (toxic - a + 0.5)) - np.log((b + 0.5) / (clean - b + 0.5))
    order = np.lexsort((found["feature"].to_numpy(), -g2))
    order = order[g2[order] >= LEAST_G2][:KEPT]
    numbers = np.sort(found["feature"].to_numpy(np.int64)[order])
    if not len(numbers):
        return NOTHING
    strong = set(found["feature"].to_numpy(np.int64)[(odds >= STRONG) & (g2 >= LEAST_G2)].tolist())
    table = own.mapInArrow(_kept_counts(numbers), "label int, features array<long>, counts array<long>").toPandas()  # at most `rows` rows of at most KEPT features
    table = table.assign(key=[(x, tuple(f), tuple(c)) for x, f, c in zip(table["label"], table["features"], table["counts"])]).sort_values("key")
    y = table["label"].to_numpy(np.int64) > 0
    evidence = np.array([sum(n for f, n in zip(fs, cs) if f in strong) for fs, cs in zip(table["features"], table["counts"])])
    cuts = np.quantile(evidence[y], [1 / 3, 2 / 3])
    grades = np.where(y, 1 + (evidence[:, None] > cuts[None, :]).sum(axis=1), 0)
    top = int(grades.max())
    cols = [np.searchsorted(numbers, np.asarray(fs, np.int64)) for fs in table["features"]]
    vals = [1 + np.log(np.asarray(cs, np.float64)) for cs in table["counts"]]
    w, t = fit_ordinal(cols, vals, grades, len(numbers), top)
    return Severity(numbers, w, np.concatenate([t, np.full(GRADES - top, 40.0)]))


def severities(docs: DataFrame, model: Severity) -> DataFrame:
    """(doc_id, expected_severity, severity, p_toxic, toxic) of every row's whole text.

    expected_severity lies in [0, 3], severity is it rounded to a grade, toxic
    is 1 where P(grade >= 1) >= 0.5. A null or empty text has the score of no
    features. Repeated rows are scored each; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in sliced(batches, 8192):
            p = own.at_least(own.score(texts_of(batch, 1)))
            e = p.sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(e), pa.array(np.rint(e).astype(np.int32)), pa.array(p[:, 0]), pa.array((p[:, 0] >= 0.5).astype(np.int32))], ["doc_id", "expected_severity", "severity", "p_toxic", "toxic"]
            )

    return doc_texts(docs).mapInArrow(run, "doc_id long, expected_severity double, severity int, p_toxic double, toxic int")


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """Fit on `labels` (doc_id, toxic) and score every row of `docs`; see `fit` and `severities`."""
    return severities(docs, fit(docs, labels, rows))


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """`docs` without the documents scored toxic. Rows without a doc_id stay.

    Rows that share a doc_id go together if one of them is toxic.
    """
    scored = toxicity(docs, labels, rows)
    gone = cut(scored.where("toxic = 1 and doc_id is not null").select("doc_id").distinct())
    return without_ids(docs, gone)
