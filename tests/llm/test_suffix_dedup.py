import random

import numpy as np
import pyarrow as pa
import pytest
from brute import covered, suffix_dedup

from riskframe.llm import suffix_dedup as D
from riskframe.llm.suffix_array import permuted_lcp, suffix_array

COLS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.mark.parametrize("seed", range(8))
def test_suffix_array_and_common_prefixes(seed):
    rng = random.Random(seed)
    for _ in range(40):
        n, k = rng.choice([1, 2, 3, 7, 40, 200]), rng.choice([1, 2, 3, 30])
        s = [rng.randrange(1, k + 1) for _ in range(n)]
        if rng.random() < 0.4:
            s = (s[:rng.randrange(1, 5)] * n)[:n]
        text = np.array([*s, 0], dtype=np.int32)
        order = suffix_array(text)
        whole = [*s, 0]
        assert order.tolist() == sorted(range(n + 1), key=lambda i: whole[i:])
        raw = bytes(s)
        got = permuted_lcp(np.frombuffer(raw, np.uint8), order[1:], 10**6, np.zeros(0, dtype=int))
        for a, b in zip(order[1:-1], order[2:]):
            want = 0
            while want < min(n - a, n - b) and raw[a + want] == raw[b + want]:
                want += 1
            assert got[b] == want


def corpus(seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(70), prose(60)
    texts = [None, "", "short", prose(200), passage, prose(30) + passage + prose(30), prose(5) + passage[:260] + prose(90),
             other + prose(20) + other, "Und " * 300, "Und " * 120, "x" * 199, "x" * 200, "y" * 201, "日本" * 90, "本日" * 90 + "本"]
    base = prose(150)
    for _ in range(6):
        t = list(base)
        for _ in range(3):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    texts += [base, base, prose(80) + base[100:500]]
    return list(enumerate(texts))


def result(docs):
    return sorted(map(tuple, D.suffix_dedup(docs).select(*COLS).collect()))


def test_matches_brute_force(make_docs):
    rows = corpus()
    docs = make_docs(rows).selectExpr("*", "1 AS text_id", "2 AS gram", "3 AS runs")
    assert result(docs) == suffix_dedup(rows)


def test_crowded_anchors_and_small_pieces(make_docs, monkeypatch):
    monkeypatch.setattr(D, "CROWD", 1)
    monkeypatch.setattr(D, "SHARD_BYTES", 2000)
    rows = corpus(1)
    assert result(make_docs(rows)) == suffix_dedup(rows)


def test_anchors_own_every_start_once(monkeypatch):
    text = bytes(random.Random(4).randrange(97, 100) for _ in range(5000))
    for piece in (10**6, 700):
        monkeypatch.setattr(D, "PIECE", piece)
        _, start, n = D.anchors(text)
        assert [s + k for s, c in zip(start.tolist(), n.tolist()) for k in range(c)] == list(range(len(text) - D.MATCH + 1))


def test_equal_strings_have_equal_anchors():
    rng = random.Random(6)
    block = bytes(rng.randrange(256) for _ in range(260))
    a = bytes(rng.randrange(256) for _ in range(333)) + block
    b = block + bytes(rng.randrange(256) for _ in range(50))
    own = []
    for t, at in ((a, 333), (b, 0)):
        g, start, n = D.anchors(t)
        place = {s + k: x for x, s, c in zip(g.tolist(), start.tolist(), n.tolist()) for k in range(c)}
        own.append([place[at + i] for i in range(61)])
    assert own[0] == own[1]


def test_shard_against_brute_force(monkeypatch):
    monkeypatch.setattr(D, "MATCH", 6)
    rng = random.Random(7)
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(6, 14))) for _ in range(30)]
    table = pa.table({"segment": pa.array(range(30)), "skip": pa.array([0] * 30, pa.int32()), "many": [i % 9 == 0 for i in range(30)], "bytes": pieces})
    got = {(r["segment"], s) for r in D.match_shard(table).to_pylist() for s in range(r["start"], r["stop"])}
    count = {}
    for i, p in enumerate(pieces):
        for s in range(len(p) - 5):
            count[p[s:s + 6]] = count.get(p[s:s + 6], 0) + (2 if i % 9 == 0 else 1)
    assert got == {(i, s) for i, p in enumerate(pieces) for s in range(len(p) - 5) if count[p[s:s + 6]] > 1}


def test_repeats_empty_and_texts_that_stay(make_docs, spark):
    text = "z" * 150 + "q" * 150
    docs = make_docs([(1, text), (1, text), (2, "clean"), (None, text), (3, None)])
    got = result(docs)
    assert [g[:4] for g in got] == [(1, 300, 300, 1), (1, 300, 300, 1), (2, 5, 0, 0), (3, 0, 0, 0)]
    assert result(docs.where("false")) == []
    out = {r.doc_id: r for r in D.drop_repeats(docs.where("doc_id > 1 OR doc_id IS NULL")).collect()}
    assert out[2].text == "clean" and out[3].text is None and out[2].n_chars == 5


def test_cut_texts(make_docs):
    rows = corpus()
    texts = [(t or "").encode() for _, t in rows]
    flags = covered(texts, 200)
    got = {r.doc_id: r.text for r in D.drop_repeats(make_docs(rows)).collect()}
    for (d, t), raw, f in zip(rows, texts, flags):
        want = None if t is None else bytes(b for b, x in zip(raw, f) if not x).decode(errors="ignore")
        assert got[d] == want


def test_columns_of_any_name_are_kept(make_docs):
    docs = make_docs([(1, "a" * 450), (2, "b")]).selectExpr("*", "7 AS runs", "8 AS runs_of", "9 AS text_id")
    out = {r.doc_id: r for r in D.drop_repeats(docs).collect()}
    assert out[1].text == "" and out[2].text == "b" and all((r.runs, r.runs_of, r.text_id) == (7, 8, 9) for r in out.values())
