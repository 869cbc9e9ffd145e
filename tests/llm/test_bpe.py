import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskframe.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


TEXTS = ["", " ", "Hello, World! it's I'LL", "a" * 900, "<|endoftext|>", "x<|startoftext|>y <|endoftext", "ΑΣ ΣΑΣ İ é é ｆｕｌｌ",
         "a\x1cb\x1fc\x85d\xa0e", "1234 ½ ²", "'s''s", "日本語 テスト", "​﻿", "tab\tnew\nline\r\x0b\x0c", "😀😀 👩‍👩‍👧", "ab" * 300 + " " + "lalala" * 50]


def test_matches_the_library(library):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("ab c'stRE\n1é<|endoftext|>ΣςǅK!…") for _ in range(80)) for _ in range(300)]
    v = bpe.Vocabulary(PATH)
    for (ids, n, text), e in zip(v.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert ids == " ".join(map(str, e.ids)) and n == len(e.ids)
        assert text == library.decode(e.ids, skip_special_tokens=False) == v.decode(e.ids)


def test_a_small_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 30)
    texts = [" ".join(f"word{i * j}" for i in range(40)) for j in range(12)]
    got = bpe.Vocabulary(PATH).encode(texts)
    assert [g[0] for g in got] == [" ".join(map(str, e.ids)) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_query_and_round_trip(make_docs, library):
    texts = [*TEXTS, None]
    docs = make_docs(texts).selectExpr("*", "1 AS ids", "2 AS n_tokens").unionByName(make_docs([(99, "again"), (99, "again")]), allowMissingColumns=True)
    got = {r.doc_id: r for r in bpe.digest_columns(docs, PATH).collect()}
    ids = {r.doc_id: r.ids for r in bpe.encode(docs, PATH).collect()}
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert ids[i] == want and got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        text = library.decode(want, skip_special_tokens=False)
        assert back[i] == text and got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digest_columns(docs, PATH).where("doc_id = 99").count() == 2
    assert bpe.digest_columns(docs.where("false"), PATH).count() == 0
