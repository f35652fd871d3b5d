"""Token ids of a word-level BPE vocabulary, with a bounded cache of words.

`tokenizers` splits a text into words before any merge, and merges never cross
a word, so ids can be kept by word. A text with characters outside the range
whose splitting is restated here (Latin letters, digits, ASCII signs and
general punctuation) goes to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff\u0100-\u024f"
_DIGIT = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
#: A word of lower-cased text, in the order in which the vocabulary's own pattern tries them.
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+")
_SIGNS = "\u2010-\u2027\u2030-\u205e\u20ac"
#: Characters beyond which normalisation isn't plain lower-casing within the range: combining marks, other scripts, and capitals whose small letters lie outside it.
_OTHER = re.compile("[^" + "".join(re.escape(c) for c in map(chr, range(0x250)) if max(c.lower()) <= "\u024f") + _SIGNS + "]")
#: The pattern that the class above restates; another vocabulary is left to the library.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordTokens:
    """ids(text) as little-endian unsigned 32-bit bytes; a text with the string of an added token goes to the library whole.

    At most about `cached` words are kept; beyond, those of the current texts stay.
    """

    def __init__(self, path: str, cached: int = 300_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core; more threads only wait
        self.library = Tokenizer.from_file(path)
        self.added = tuple({t.content.lower() for t in self.library.get_added_tokens_decoder().values()})
        self.cached = cached
        self.known: dict[str, bytes] = {}
        spec = self.library.to_str().replace(" ", "")
        self.by_word = all(x in spec for x in (WORD_PATTERN.replace("\\", "\\\\"), '"type":"Lowercase"', '"dropout":null', '"end_of_word_suffix":"</w>"'))
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.last[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str], at_once: int = 200) -> None:
        """Ids of new words, encoded in lines of many: the last token of each word says where it ends."""
        groups = [words[k : k + at_once] for k in range(0, len(words), at_once)]
        for own, ids in zip(groups, self._encode([" ".join(g) for g in groups])):
            ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
            if len(ends) != len(own):
                self.known.update(zip(own, (x.tobytes() for x in self._encode(own))))
                continue
            raw, begins = ids.tobytes(), [0, *ends[:-1].tolist()]
            self.known.update((w, raw[p:q]) for w, p, q in zip(own, begins, ends.tolist()))

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        lowered = [text.lower() for text in texts]
        whole = [i for i, text in enumerate(texts) if not self.by_word or _OTHER.search(text) or any(t in lowered[i] for t in self.added)]
        aside = set(whole)
        split = [(i, _WORD.findall(low)) for i, low in enumerate(lowered) if i not in aside]
        if len(self.known) > self.cached:
            self.known = {w: self.known[w] for w in set().union(*(words for _, words in split)) if w in self.known}
        found = [list(map(self.known.get, words)) for _, words in split]
        gaps = [[k for k, ids in enumerate(own) if ids is None] for own in found]
        self._learn(list({words[k] for (_, words), own in zip(split, gaps) for k in own}))
        for (i, words), own, missing in zip(split, found, gaps):
            for k in missing:
                own[k] = self.known[words[k]]
            out[i] = b"".join(own)
        for i, ids in zip(whole, self._encode([texts[i] for i in whole])):
            out[i] = ids.tobytes()
        return out
