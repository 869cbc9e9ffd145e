"""Brute-force versions that the operators are held against."""

import hashlib
import re
from collections import Counter


def components(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def ngram_join(rows):
    """rows: (doc_id, text), sorted by id."""
    sets = [shingles(t) for _, t in rows]
    edges = [(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if a and b and 100 * len(a & b) >= 80 * len(a | b)]
    root = components(len(rows), edges)
    return sorted((d, len(s), rows[root[i]][0]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def covered(texts, match):
    """Per text the flags of its bytes that a repeated string covers."""
    count = Counter(t[i:i + match] for t in texts for i in range(len(t) - match + 1))
    out = []
    for t in texts:
        flags = bytearray(len(t))
        for i in range(len(t) - match + 1):
            if count[t[i:i + match]] > 1:
                flags[i:i + match] = b"\1" * match
        out.append(flags)
    return out


def suffix_dedup(rows, match=200):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (d, _), t, flags in zip(rows, texts, covered(texts, match)):
        kept = bytes(b for b, f in zip(t, flags) if not f)
        spans = len(re.findall(b"\1+", bytes(flags)))
        out.append((d, len(t), sum(flags), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]
