"""Five-word shingle sets of texts, as hashes."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

from riskframe.llm.common import splitmix

WORDS = 5
CACHE_WORDS = 300_000


class WordHashes(dict):
    """64-bit hash of each word (bytes); a bounded cache."""

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_HASHES = WordHashes()


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text. Words are parted by ASCII white space,
    A-Z is lower-cased (``bytes`` methods do just that); a text of fewer words than a
    shingle is one shingle, one without words has none."""
    rows = [t.lower().split() for t in texts]
    count = np.array([len(r) for r in rows], dtype=np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, chain.from_iterable(rows)), dtype=np.uint64, count=int(count.sum()))
    gram = h.copy()
    for k in range(1, min(WORDS, len(h))):
        gram[:len(h) - k] = gram[:len(h) - k] * np.uint64(0x9E3779B97F4A7C15) + h[k:]
    gram = splitmix(gram)
    out, at = [], 0
    for n in count.tolist():
        if n >= WORDS:
            out.append(np.unique(gram[at:at + n - WORDS + 1]))
        elif n:
            x = np.uint64(n)
            for w in h[at:at + n]:
                x = splitmix(np.array([x ^ w]))[0]
            out.append(np.array([x], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        at += n
    return out


def set_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit key per set, equal for equal sets."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    cum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(splitmix(np.concatenate([*sets, np.zeros(0, np.uint64)]) ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    ends = np.cumsum(size)
    return splitmix(cum[ends] - cum[ends - size] + size.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
