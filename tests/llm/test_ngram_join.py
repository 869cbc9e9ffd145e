import random

import numpy as np
import pytest
from brute import components, ngram_join

from riskframe.llm import linking
from riskframe.llm import ngram_join as N
from riskframe.llm.shingles import shingle_sets

COLS = ["doc_id", "n_shingles", "component_id"]


def corpus(seed=1):
    """Families of near copies around the threshold, a passage shared by many, copies, short texts."""
    rng = random.Random(seed)
    passage = " ".join(f"common{i}" for i in range(40))
    texts = [None, "", "  ", "one", "ONE", "a b c d", "A b C d", "a b c d e", "é É"]
    for _ in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([8, 25, 60, 150]))]
        for _ in range(rng.randrange(1, 6)):
            t = list(base)
            for _ in range(rng.randrange(0, max(1, len(t) // 18))):
                t[rng.randrange(len(t))] = f"x{rng.randrange(9999)}"
            texts.append(" ".join(t))
        texts.append(" ".join(base[:20]) + " " + passage)
    texts += [texts[12], texts[12].upper()]
    return list(enumerate(texts))


def result(docs):
    return sorted(map(tuple, N.ngram_join(docs).select(*COLS).collect()))


def test_matches_brute_force(make_docs):
    rows = corpus()
    docs = make_docs(rows).selectExpr("*", "1 AS node", "2 AS component", "3 AS comp")
    assert result(docs) == ngram_join(rows)


def test_groups_dealt_to_chunks(make_docs, monkeypatch):
    """With tiny chunks every phase of the verification runs."""
    monkeypatch.setattr(linking, "CHUNK", 3)
    rows = corpus(2)
    assert result(make_docs(rows)) == ngram_join(rows)


def test_repeats_null_ids_and_empty(make_docs):
    docs = make_docs([(5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f"), (None, "a b c d e f")])
    assert result(docs) == [(5, 2, 5), (5, 2, 5), (9, 2, 5)]
    assert result(docs.where("false")) == []


def test_filters_lose_no_pair():
    """The prefix bounds against every pair of sizes and overlaps at the threshold."""
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        m = int(rng.integers(-(-4 * n // 5), 5 * n // 4 + 1))
        o = -(-4 * (n + m) // 9)
        if o > min(n, m):
            continue
        tokens = rng.choice(10**9, n + m - o, replace=False).astype(np.uint64)
        x, y = np.sort(tokens[:n]), np.sort(tokens[n - o:])
        assert N.linked(x, y)
        dx, dy = x[:int(N.depth(np.int64(n)))], y[:int(N.depth(np.int64(m)))]
        common = np.intersect1d(dx, dy)
        assert len(common) >= min(N.share(np.int64(n)), N.share(np.int64(m)))
        rank = {t: r for r, t in enumerate(rng.permutation(tokens).tolist())}
        first = [set(sorted(d.tolist(), key=rank.get)[:int(N.rare_prefix(np.int64(k)))]) for d, k in ((dx, n), (dy, m))]
        assert first[0] & first[1]


@pytest.mark.parametrize("seed", range(6))
def test_linker_finds_every_link(seed):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        t = list(base)
        for _ in range(rng.randrange(0, 5)):
            t[rng.randrange(60)] = f"x{rng.randrange(999)}"
        texts.append(" ".join(t).encode())
    sets, n = shingle_sets(texts), len(texts)
    want = components(n, [(i, j) for j in range(n) for i in range(j) if N.linked(sets[i], sets[j])])
    assert components(n, N.link_sets(texts, np.arange(n), None)) == want


@pytest.mark.parametrize("words", range(1, 6))
def test_tables_of_one_short_text(make_docs, words):
    """A slice may hold fewer words than a shingle in all."""
    text = " ".join("abcde"[:words])
    assert len(shingle_sets([text.encode()])[0]) == 1
    assert result(make_docs([(7, text)])) == [(7, 1, 7)]
    assert result(make_docs([(7, text), (8, text.upper())])) == [(7, 1, 7), (8, 1, 7)]
