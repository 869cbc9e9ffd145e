import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskframe.llm import alignment as A
from riskframe.llm.bpe import byte_letters

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """The contract, token by token, with the libraries themselves."""
    ta, tb = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    ta.encode_special_tokens = True
    byte = {c: b for b, c in enumerate(byte_letters())}
    docs, count = [], Counter()
    for d, t in rows:
        t = t or ""
        a = ta.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tb.encode(t) if t else []
        bytes_a = [bytes(byte[c] for c in ta.id_to_token(x)) for x in a]
        bytes_b = [bytes([int(tb.id_to_piece(x)[3:5], 16)]) if tb.is_byte(x) else tb.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not t or b"".join(bytes_a) != (" " + t).encode() or b"".join(bytes_b) != (" " + t).encode():
            a, b, bytes_a, bytes_b = [], [], [], []
        ends = lambda parts: np.cumsum([len(p) for p in parts]).tolist()
        end_a, end_b = ends(bytes_a), ends(bytes_b)
        links = [(x, y) for x, e in zip(a, end_a) for y, f in zip(b, end_b) if e == f]
        common = sorted(set(end_a) & set(end_b))
        groups = [([x for x, e in zip(a, end_a) if lo < e <= hi], [y for y, e in zip(b, end_b) if lo < e <= hi]) for lo, hi in zip([0, *common], common)]
        docs.append((d, a, b, groups, links))
        count.update(links)
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for d, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((d, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else "", sum(len(x) * len(y) for x, y in groups)))
    return sorted(out)


def corpus():
    rng = random.Random(0)
    words = ["the", "quality", "naïve", "déjà", "Größe", "1234567", "foo_bar", "don't", "日本語", "🤖👍🏽", "  ", "\n\n", "\t", "<s>", "<|endoftext|>", "</s>", "<0x41>", "zxqwv", "...", "é́"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(40)]
    return list(enumerate([None, "", " ", "a", "▁ piece space", "nul\0byte", "x" * 300, " lead", *texts, texts[0], texts[0], " ".join(texts) * 3]))


@pytest.mark.parametrize("bounds", [(A.SLICE_BYTES, A.CHUNK_BYTES, A.PRODUCTS), (200, 500, 50)])
def test_matches_brute_force(make_docs, monkeypatch, bounds):
    for name, value in zip(("SLICE_BYTES", "CHUNK_BYTES", "PRODUCTS"), bounds):
        monkeypatch.setattr(A, name, value)
    rows = corpus()
    docs = make_docs([*rows, (None, "no id")]).selectExpr("*", "1 AS chunk", "2 AS pair", "3 AS n_a")
    got = sorted(tuple(r) for r in A.align(docs.repartition(3), *PATHS).collect())
    assert got == brute(rows)
    assert [r[7] for r in got[:2]] == ["", ""] and got[4][1:8] == (0, 0, 0, 0, 0, 0, "")


def test_repeated_ids_and_empty_table(make_docs):
    rows = [(5, "same id"), (5, "same id"), (6, None)]
    assert sorted(tuple(r) for r in A.align(make_docs(rows), *PATHS).collect()) == brute(rows)
    assert A.align(make_docs(rows).where("false"), *PATHS).count() == 0


def test_long_texts_give_the_same_ids(monkeypatch):
    own = A.tokens(*PATHS)
    text = "Plain words, 12345 and <|endoftext|> é🤖   \n" * 30
    want = [x.tolist() for x in own.encode(text)]
    monkeypatch.setattr(A, "LONG", 10)
    assert [x.tolist() for x in own.encode(text)] == want


def dense(m, columns):
    out = np.zeros((m.rows, columns), dtype=int)
    for i in range(m.rows):
        out[i, m.indices[m.indptr[i]:m.indptr[i + 1]]] = 1
    return out


@pytest.mark.parametrize("products", [1, 7, 1 << 20])
def test_gustavson_is_the_matrix_product(products):
    rng = np.random.default_rng(products)
    def matrix(rows, columns):
        d = rng.random((rows, columns)) < 0.3
        return A.Csr(np.concatenate([[0], np.cumsum(d.sum(axis=1))]), np.nonzero(d)[1]), d.astype(int)
    (a, da), (b, db) = matrix(13, 9), matrix(9, 11)
    assert (dense(A.transpose(a, 9), 13) == da.T).all()
    out = np.zeros((13, 11), dtype=int)
    for row, col, value in A.gustavson(a, b, 11, products):
        assert (np.diff(row * 11 + col) > 0).all()
        out[row, col] += value
    assert (out == da @ db).all()
    assert (A.times_vector(a, np.arange(9)) == da @ np.arange(9)).all()


def test_overlap_and_group_links():
    len_a, len_b = np.array([3, 1, 4, 2]), np.array([2, 2, 4, 1, 1])
    over = [tuple(map(int, x)) for s in A.overlap_links(len_a, len_b) for x in zip(*s)]
    assert over == [(0, 0, 2), (0, 1, 1), (1, 1, 1), (2, 2, 4), (3, 3, 1), (3, 4, 1)]
    ga, gb = np.array([0, 0, 1, 2]), np.array([0, 0, 1, 2, 2])
    links = [tuple(map(int, x)) for s in A.shared_group_links(ga, gb, 3) for x in zip(*s)]
    assert links == [(i, j, 1) for i in range(4) for j in range(5) if ga[i] == gb[j]]
    assert A.shared_group_counts(ga, gb, 3).tolist() == [2, 2, 1, 2]
