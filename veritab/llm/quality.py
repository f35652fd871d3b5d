"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of WORDS words. Each passage is encoded from
its own bytes and words (shape, repetition, case, signs, function words), a
gated attention network learned from document labels alone weighs the passages,
and the score is that of the weighted sum of their representations:

    h_k = tanh(E x_k + e);  a = softmax_k(c . (tanh(V h_k) * sigmoid(U h_k)))
    score = sigmoid(z . sum_k a_k h_k + b)

Every passage of every text takes part in scoring. Fitting uses at most
FIT_ROWS labelled documents; of one with more than FIT_PASSAGES passages so
many are taken at even distances, from its first to its last. The driver thus
holds at most FIT_ROWS x FIT_PASSAGES passages of FEATURES numbers (37 MB, and
about six times that while it fits).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import doc_texts, prepare, raw_texts, sliced
from veritab.llm.hashing import mix, word_hashes
from veritab.llm.labelled import held_out, sample
from veritab.llm.words import COMMON_WORDS

WORDS = 64
FIT_ROWS, FIT_PASSAGES = 5_000, 80
HIDDEN, GATE, STEPS, SEED = 12, 8, 250, 11
#: Bytes of text encoded at once.
CHUNK = 2_000_000

#: Byte classes; everything else in ASCII is "other sign".
_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,;:", "!?", "|", "$%&#*@", "<>{}[]()/\\", "'\"-"]
_CLASS = np.full(256, len(_CLASSES) + 1, dtype=np.int64)
for _k, _c in enumerate(_CLASSES):
    _CLASS[np.frombuffer(_c.encode(), np.uint8)] = _k
_CLASS[128:] = len(_CLASSES)
_KINDS = len(_CLASSES) + 2
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_COMMON = np.sort(word_hashes([w.encode() for w in sorted(COMMON_WORDS)]))
FEATURES = _KINDS + 10


def encode_passages(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(passages x FEATURES, passages per text) of UTF-8 texts; a text without words is one passage of zeros."""
    raw = b"\n".join(t or b"" for t in texts) + b"\n"
    b = np.frombuffer(raw, np.uint8)
    sizes = np.array([len(t or b"") + 1 for t in texts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    blank = _BLANK[b]
    begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    owner = np.searchsorted(starts, begins, side="right") - 1
    per_text = np.bincount(owner, minlength=len(texts))
    passages = np.maximum(1, -(-per_text // WORDS))
    base = np.concatenate([[0], np.cumsum(passages)[:-1]])
    total = int(passages.sum())
    out = np.zeros((total, FEATURES))
    if not len(begins):
        return out, passages
    first = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    of_word = base[owner] + (np.arange(len(begins)) - first[owner]) // WORDS
    ends = np.concatenate([begins[1:], [len(b)]])
    of_byte = np.repeat(of_word, ends - begins)  # blanks go with the word before them
    kind = _CLASS[b[begins[0] :]]
    counts = np.bincount(of_byte * _KINDS + kind, minlength=total * _KINDS).reshape(total, _KINDS).astype(np.float64)
    n_bytes, n_words = np.maximum(counts.sum(axis=1), 1), np.bincount(of_word, minlength=total).astype(np.float64)
    words = np.maximum(n_words, 1)
    out[:, :_KINDS] = counts / n_bytes[:, None]
    length = np.flatnonzero(blank & np.concatenate([[False], ~blank[:-1]])) - begins  # each word ends before a blank: the last text has one added
    mean = np.bincount(of_word, weights=length, minlength=total) / words
    spread = np.sqrt(np.maximum(np.bincount(of_word, weights=length.astype(np.float64) ** 2, minlength=total) / words - mean**2, 0))
    lower = raw.lower()
    h = word_hashes(lower.split())
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (of_word[1:] == of_word[:-1])])
    distinct = np.unique(mix(h) ^ mix(of_word.astype(np.uint64), 5), return_index=True)[1]
    common = _COMMON[np.minimum(np.searchsorted(_COMMON, h), len(_COMMON) - 1)] == h
    upper = np.add.reduceat((_CLASS[b] == 1).astype(np.int64), begins)
    signs = np.add.reduceat(((_CLASS[b] >= 6) & (_CLASS[b] <= 9)).astype(np.int64), begins)

    def share(flag) -> np.ndarray:
        return np.bincount(of_word, weights=flag.astype(np.float64), minlength=total) / words

    extra = [
        np.log1p(n_words), np.log1p(mean), np.log1p(spread), share(same), np.bincount(of_word[distinct], minlength=total) / words,
        share(common), share((upper == length) & (length > 1)), share(signs > 0), share(signs >= 2), share(length == 1),
    ]
    out[:, _KINDS:] = np.stack(extra, axis=1)
    return out, passages


@dataclass
class GatedAttention:
    """Weights of the network, and the mean and spread by which features are standardised."""

    mean: np.ndarray
    spread: np.ndarray
    p: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        p, first = self.p, np.concatenate([[0], np.cumsum(sizes)[:-1]])
        h = np.tanh(x @ p["E"] + p["e"])
        tv, su = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (tv * su) @ p["c"]
        w = np.exp(s - np.repeat(np.maximum.reduceat(s, first), sizes))
        a = w / np.repeat(np.add.reduceat(w, first), sizes)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"h": h, "tv": tv, "su": su, "a": a, "z": z, "first": first, "y": 1 / (1 + np.exp(-np.clip(z @ p["z"] + p["b"], -40, 40)))}

    def standardised(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.spread, -8, 8)

    def scores(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return self.forward(self.standardised(features), sizes)["y"]

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy by backpropagation through the attention."""
        p, f = self.p, self.forward(x, sizes)
        dz_out = (f["y"] - y) / len(y)
        dz = dz_out[:, None] * p["z"][None, :]
        up = np.repeat(dz, sizes, axis=0)
        da = (up * f["h"]).sum(axis=1)
        ds = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, f["first"]), sizes))
        g = ds[:, None] * p["c"][None, :]
        dv, du = g * f["su"] * (1 - f["tv"] ** 2), g * f["tv"] * f["su"] * (1 - f["su"])
        dh = (f["a"][:, None] * up + dv @ p["V"].T + du @ p["U"].T) * (1 - f["h"] ** 2)
        return {"z": f["z"].T @ dz_out, "b": dz_out.sum(keepdims=True), "c": (f["tv"] * f["su"]).T @ ds, "V": f["h"].T @ dv, "U": f["h"].T @ du, "E": x.T @ dh, "e": dh.sum(axis=0)}


def train(features: np.ndarray, sizes: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = SEED, ridge: float = 1e-3) -> GatedAttention:
    """Full-batch Adam from a fixed start; the same rows give the same model. Without both labels, a constant."""
    rng = np.random.Generator(np.random.PCG64(seed))
    d = features.shape[1]
    shapes = {"E": (d, HIDDEN), "e": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "c": (GATE,), "z": (HIDDEN,), "b": (1,)}
    p = {k: rng.standard_normal(s) / np.sqrt(s[0]) if k not in ("e", "b") else np.zeros(s) for k, s in shapes.items()}
    if not len(y) or y.min() == y.max():
        p = {k: np.zeros(s) for k, s in shapes.items()}
        p["b"] = np.full(1, 0.0 if not len(y) else 4.0 * (2 * float(y[0]) - 1))
        return GatedAttention(np.zeros(d), np.ones(d), p)
    model = GatedAttention(features.mean(axis=0), np.maximum(features.std(axis=0), 1e-3), p)
    x = model.standardised(features)
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        for k, g in model.gradients(x, sizes, y).items():
            g = g + ridge * p[k] * (k not in ("e", "b"))
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            p[k] -= 0.03 * (1 - 0.9 * step / steps) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 64):
        x, sizes = encode_passages(raw_texts(batch, 1))
        packed = []
        for end, n in zip(np.cumsum(sizes).tolist(), sizes.tolist()):
            own = x[end - n : end]
            if n > FIT_PASSAGES:
                own = own[np.linspace(0, n - 1, FIT_PASSAGES).round().astype(np.int64)]
            packed.append(own.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> GatedAttention:
    """Fit on at most `rows` labelled documents outside the held-out fold; passages are encoded where the texts are."""
    prepare(docs.sparkSession)
    found = sample(docs, labels, "quality", rows).mapInArrow(_encode_rows, "label int, x binary").collect()  # at most rows x FIT_PASSAGES x FEATURES x 4 bytes
    bags = sorted((int(r["label"] > 0), bytes(r["x"])) for r in found)
    x = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for _, b in bags]
    sizes = np.array([len(b) for b in x], dtype=np.int64)
    flat = np.concatenate(x).astype(np.float64) if x else np.zeros((0, FEATURES))
    return train(flat, sizes, np.array([y for y, _ in bags], dtype=np.float64))


def quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row's whole text; fitted on `labels` (doc_id, quality).

    score lies in [0, 1], higher where label 1 is likelier; predicted is 1 from
    0.5. A null or empty text is one passage without words. A row without a
    doc_id isn't held out. Without labels of both kinds all scores are alike.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))

    def scored(ids: list, texts: list) -> pa.RecordBatch:
        y = model.value.scores(*encode_passages(texts))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(y), pa.array((y >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids, texts, held = [], [], 0
            for doc_id, raw in zip(batch.column(0).to_pylist(), raw_texts(batch, 1)):
                ids.append(doc_id)
                texts.append(raw)
                held += len(raw or b"")
                if held >= CHUNK:
                    yield scored(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield scored(ids, texts)

    out = doc_texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
