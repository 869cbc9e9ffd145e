import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from riskframe.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(docs, texts, window):
    library = Tokenizer.from_file(PATH)
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts}
    rows = packing.digest_columns(packing.pack(docs, PATH, window=window, shard_rows=16)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], dtype="<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(want)
    for i, ids in want.items():
        at = 0
        for s, n in sorted(pieces[i]):
            assert s == at
            at += n
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for s, n in sorted(parts):
            assert s == at and n > 0
            at += n
        assert at <= window and (at == window or at & (at - 1) == 0)


def test_every_id_once_and_no_padding(make_docs):
    texts = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(i * 3))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "  two  spaces\n\n end "), (103, "x<|endoftext|>y <|endoftext|> z"), (104, "long " * 3000),
              (105, "\x1c odd\x85 "), (106, "naïve 日本語 'tis I'll")]
    check(make_docs(texts), texts, 64)


def test_empty_table_and_clashing_columns(make_docs):
    docs = make_docs(["a", "b"]).selectExpr("*", "1 AS ids", "2 AS length", "3 AS start")
    check(docs, [(0, "a"), (1, "b")], 2048)
    assert packing.pack(docs.where("false"), PATH).count() == 0


def test_ids_are_the_librarys(monkeypatch):
    rng = random.Random(0)
    texts = ["", " ", "\n\n  \n x  y", "a" * 3000, "it's 'S we'LL don't", "<|endoftext|><|endoftext|> a<|endoftext|", "½²３ é é 日本語😀", "\x1c\x85\xa0\u2028 \u200b"]
    texts += ["".join(rng.choice("ab '\n\t  1é.<|endoftext|>日s") for _ in range(70)) for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0x3000), rng.randrange(0x4e00, 0x9000), rng.randrange(1, 127)])) for _ in range(60)) for _ in range(200)]
    enc, library = packing.TextEncoder(PATH), Tokenizer.from_file(PATH)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [enc.encode(t).tolist() for t in texts] == want
    monkeypatch.setattr(packing, "LONG", 10)
    assert [enc.encode(t).tolist() for t in texts] == want


def test_neighbours_come_first():
    """The unused document that shares the seed's rare terms fills its window."""
    rng = np.random.default_rng(0)
    docs = [rng.integers(1000 * k, 1000 * k + 400, 300) for k in range(8)]
    twin = docs[0][:200]
    seqs = packing.pack_shard([*docs, twin], 512)
    of = {d: k for k, s in enumerate(seqs) for d, start, n in s if start == 0}
    assert of[0] == of[8]


def test_scores_are_bm25():
    docs = [np.array(d) for d in ([1, 1, 2, 3], [1, 4], [2, 2, 5, 6, 7], [8])]
    got = packing.Bm25Index(docs).scores(0)
    n, k1, b = len(docs), 1.2, 0.75
    mean = np.mean([len(d) for d in docs])
    for j, d in enumerate(docs):
        want = 0.0
        for t in {1, 2, 3}:
            df = sum(t in x for x in docs)
            tf = (d == t).sum()
            want += np.log1p((n - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(d) / mean))
        assert abs(got[j] - want) < 1e-9
