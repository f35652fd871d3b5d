"""Vectorised 64-bit hashing of words and word shingles (numpy, no Spark)."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
#: Odd multipliers, one for each place in a shingle.
_PLACE = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
    dtype=_U,
)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective finaliser of 64-bit words; `seed` selects one of a family."""
    offset = _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    z = x + offset
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


def ascii_words(text: str | bytes | None) -> list[bytes]:
    """Words as maximal runs outside [\\x20\\x09-\\x0D], A-Z lower-cased; null gives none."""
    if not text:
        return []
    raw = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    return raw.lower().split()  # bytes.lower and bytes.split know ASCII only


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=_U, count=len(words))


def shingle_set(words: list[bytes], width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all `width`-word shingles; a shorter sequence is one shingle; no words, no shingle."""
    n = len(words)
    if not n:
        return np.empty(0, dtype=_U)
    h = word_hashes(words)
    if n < width:
        return mix(np.atleast_1d((h * _PLACE[:n]).sum(dtype=_U)), 1000 + n)
    acc = h[: n - width + 1] * _PLACE[0]
    for k in range(1, width):
        acc = acc + h[k : n - width + 1 + k] * _PLACE[k]
    return np.unique(mix(acc, 7))


def set_identity(elements: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums for each non-empty slice of `elements`; equal for equal sets."""
    return np.add.reduceat(mix(elements, 11), starts), np.add.reduceat(mix(elements, 12), starts)


def fast_sketch(elements: np.ndarray, sizes: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketches of consecutive non-empty sets, one row of `t` coordinates each.

    Round i < t sends each element to a hashed bin with a value in [i, i+1);
    rounds t to 2t-1 send every element to bin i-t, which guarantees that all
    coordinates fill. A set leaves after the first round that fills its last
    bin. A bin keeps its least value, so the share of equal coordinates of two
    sets has their Jaccard index as its mean, concentrated around it.
    """
    m = len(sizes)
    empty = _U(0xFFFFFFFFFFFFFFFF)
    out = np.full(m * t, empty, dtype=_U)
    owner = np.repeat(np.arange(m, dtype=np.int64) * t, sizes)
    x = elements
    for i in range(2 * t):
        h = mix(x, 100 + i)
        if i < t:
            bins = ((h >> _U(40)) * _U(t) >> _U(24)).astype(np.int64)
        else:
            bins = np.int64(i - t)
        np.minimum.at(out, owner + bins, _U(i << 40) | (h & _U((1 << 40) - 1)))
        open_sets = (out.reshape(m, t) == empty).any(axis=1)
        if not open_sets.any():
            break
        keep = open_sets[owner // t]  # closed sets take no part in later rounds
        x, owner = x[keep], owner[keep]
    return out.reshape(m, t)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key a band, salted by the band's number."""
    out = np.empty((len(sketch), bands), dtype=np.int64)
    for b in range(bands):
        acc = np.full(len(sketch), b + 1, dtype=_U)
        for r in range(rows):
            acc = mix(acc ^ sketch[:, b * rows + r], 3)
        out[:, b] = acc.view(np.int64)
    return out
