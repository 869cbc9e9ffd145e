"""Suffix arrays by induced sorting, in numpy.

Suffixes are classified as smaller (S) or larger (L) than the next one. Leftmost-S
substrings are sorted by one induction, named, and sorted as suffixes by recursion on
the string of names; a second induction then gives the array. Both inductions are the
usual linear scans, done a stretch at a time: all entries up to the first slot that is
still empty are final, so their predecessors can be dealt to their buckets at once, in
order. Longest common prefixes come in text order (permuted): only positions whose
predecessor differs from the neighbour's predecessor are compared, all others have one
less than the position before."""

from __future__ import annotations

import numpy as np


def _first_empty(slots: np.ndarray, at: int) -> int:
    step = 512
    while at < len(slots):
        part = slots[at:at + step] < 0
        k = int(part.argmax())
        if part[k]:
            return at + k
        at += step
        step = min(step * 2, 1 << 16)
    return len(slots)


#: Stretches up to this length are dealt one entry at a time, which is then quicker.
SHORT = 24


def _scan(slots: np.ndarray, free: np.ndarray, text: np.ndarray, takes: np.ndarray) -> None:
    """One induction: every entry, in order, puts its predecessor, where ``takes`` holds, into
    the next free slot of the predecessor's bucket. Slots hold -1 until they are filled."""
    at, n = 0, len(slots)
    while at < n:
        end = _first_empty(slots, at)
        if end - at <= SHORT:
            for p in slots[at:end].tolist():
                if p > 0 and takes[p - 1]:
                    b = text[p - 1]
                    slots[free[b]] = p - 1
                    free[b] += 1
        else:
            prev = slots[at:end] - 1
            prev = prev[(prev >= 0) & takes[prev]]
            if len(prev):
                bucket = text[prev]
                order = np.argsort(bucket, kind="stable")
                b = bucket[order]
                start = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
                count = np.diff(np.append(start, len(b)))
                b = b[start]
                slots[np.repeat(free[b] - start, count) + np.arange(len(prev))] = prev[order]
                free[b] += count
        at = end


def _induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sizes: tuple) -> np.ndarray:
    """All suffixes sorted, given the leftmost-S positions in order within their buckets."""
    n = len(text)
    n_l, n_s, n_lms = sizes
    # L suffixes, from the left: slots of a bucket are its L suffixes, then its leftmost-S ones
    head = np.cumsum(n_l + n_lms) - (n_l + n_lms)
    slots = np.full(int((n_l + n_lms).sum()), -1, dtype=np.int32)
    lms = lms[np.argsort(text[lms], kind="stable")]
    first = np.cumsum(n_lms) - n_lms
    slots[np.repeat(head + n_l - first, n_lms) + np.arange(len(lms))] = lms
    _scan(slots, head, text, ~smaller)
    # S suffixes, from the right: slots of a bucket are its L suffixes, then all its S ones
    total = n_l + n_s
    tail = np.cumsum(total)
    out = np.full(n, -1, dtype=np.int32)
    large = slots[~smaller[slots]]
    out[np.repeat(tail - total - (np.cumsum(n_l) - n_l), n_l) + np.arange(len(large))] = large
    out[0] = n - 1
    _scan(out[::-1], n - tail, text, smaller)
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted suffix positions of an integer string whose last symbol is a unique 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int32)
    # S if the first differing neighbour to the right is greater; the last is S
    differ = np.where(text[:-1] != text[1:], np.arange(n - 1, dtype=np.int32), np.int32(n))
    differ = np.minimum.accumulate(differ[::-1])[::-1]
    smaller = np.ones(n, dtype=bool)  # positions that end in the unique 0 always differ
    smaller[:-1] = text[differ] < text[differ + 1]
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(np.int32) + 1
    k = int(text.max()) + 1
    sizes = (np.bincount(text[~smaller], minlength=k), np.bincount(text[smaller], minlength=k), np.bincount(text[lms], minlength=k))
    if len(lms) > 1:
        leftmost = np.zeros(n, dtype=bool)
        leftmost[lms] = True
        first = _induce(text, smaller, lms, sizes)
        first = first[leftmost[first]]
        names = _names(text, lms, first)
        string = np.empty(len(lms), dtype=np.int32)
        string[np.searchsorted(lms, first)] = names
        inner = np.argsort(string, kind="stable") if names[-1] == len(lms) - 1 else suffix_array(string)
        lms = lms[inner]
    return _induce(text, smaller, lms, sizes)


def _names(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Numbers for sorted leftmost-S substrings; equal substrings get the same."""
    length = np.zeros(len(text), dtype=np.int32)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    off = 0
    while len(live):
        equal = text[a[live] + off] == text[b[live] + off]
        same[live[~equal]] = False
        live = live[equal]
        off += 1
        live = live[length[a[live]] > off]
    return np.concatenate([[0], np.cumsum(~same)]).astype(np.int32)


def permuted_lcp(text: np.ndarray, order: np.ndarray, most: int, fresh: np.ndarray) -> np.ndarray:
    """Common prefix of each position with its left neighbour in the array, in text order,
    counted up to ``most`` where it is compared; positions in ``fresh`` always are."""
    n = len(text)
    left = np.empty(n, dtype=np.int32)
    left[order[1:]] = order[:-1]
    left[order[0]] = -1
    compare = np.ones(n, dtype=bool)
    compare[1:] = (left[1:] <= 0) | (text[:-1] != text[left[1:] - 1])
    compare[fresh] = True
    compare &= left >= 0
    at = np.flatnonzero(compare)
    wide = np.append(text, np.zeros(8, dtype=text.dtype)).astype(np.uint64)
    for k in (1, 2, 4):  # eight symbols (each below 256) side by side
        wide = wide[:-k] | wide[k:] << np.uint64(8 * k)
    found = np.zeros(len(at), dtype=np.int32)
    live, pos, other = np.arange(len(at)), at.copy(), left[at].astype(np.int64)
    while len(live):
        x = wide[pos] ^ wide[other]
        whole = x == 0
        found[live] += np.where(whole, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.int32)
        go = whole & (found[live] < most) & (pos + 8 < n) & (other + 8 < n)
        live, pos, other = live[go], pos[go] + 8, other[go] + 8
    # a position that was not compared has one less than the one before
    top = np.full(n, -1, dtype=np.int64)
    top[at] = found + at
    top[left < 0] = np.flatnonzero(left < 0)
    base = np.maximum.accumulate(np.where(top >= 0, np.arange(n), 0))
    return np.maximum(top[base] - np.arange(n), 0)
