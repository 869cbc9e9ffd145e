"""Byte-pair encoding and decoding by batched numpy merge rounds.

The vocabulary is that of a ``tokenizers`` JSON file (lower-casing BPE with a word-end
suffix); its path is a parameter and is read where a task runs. Words new to a task's
bounded cache are encoded together: their symbols lie in one flat array, every
adjacent pair's rank is found by binary search over the sorted pair keys, and in each
round every word applies its lowest-rank, leftmost merge, as a priority queue would.

Defined cases: a null text is empty and encodes to no ids; rows without an id are
ignored; repeated rows are encoded each; strings of special tokens in a text become
those tokens; texts of any length are encoded whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from riskframe.llm.common import slices, texts_of

#: Words kept per Python worker; beyond it the cache starts anew.
CACHE_WORDS = 150_000
#: Fixed pattern of the vocabulary's pre-tokenizer.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: str.split() parts at these controls; the vocabulary's white space does not hold them.
CONTROLS = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable letter of each byte value in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the rest follow from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in self.special.items()}}
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.final = np.array([vocab[c + end] for c in letters], dtype=np.int64)
        self.width = max(self.token) + 1
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        keys = np.array([a * self.width + b for a, b, _ in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([c for *_, c in pairs], dtype=np.int64)
        self.parts = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.known: dict[str, tuple[str, int, str]] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or the number of merges where there is none."""
        want = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], len(self.merged))

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each non-empty word (UTF-8 bytes)."""
        count = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(count)
        sym = self.inner[flat]
        sym[ends - 1] = self.final[flat[ends - 1]]
        none = len(self.merged)
        rank = np.full(len(sym), none, dtype=np.int64)  # of the pair that begins here; none at a word's end
        inside = np.ones(len(sym), dtype=bool)
        inside[ends - 1] = False
        at = np.flatnonzero(inside)
        rank[at] = self.rank(sym[at], sym[at + 1])
        done: list[np.ndarray | None] = [None] * len(words)
        who = np.arange(len(words))
        while len(who):
            starts = np.cumsum(count) - count
            low = np.minimum.reduceat(rank, starts)
            open_ = low < none
            for k in np.flatnonzero(~open_):
                done[who[k]] = sym[starts[k]:starts[k] + count[k]].copy()
            keep = np.repeat(open_, count)
            sym, rank, count, who, low = sym[keep], rank[keep], count[open_], who[open_], low[open_]
            if not len(who):
                break
            starts = np.cumsum(count) - count
            hit = np.flatnonzero(rank == np.repeat(low, count))
            word = np.searchsorted(starts, hit, side="right") - 1
            first = hit[np.concatenate([[True], word[1:] != word[:-1]])]  # the leftmost of each word
            sym[first] = self.merged[low]
            stay = np.ones(len(sym), dtype=bool)
            stay[first + 1] = False
            place = np.cumsum(stay) - 1
            ends_here = (first + 1 == starts + count - 1)
            sym, rank, count = sym[stay], rank[stay], count - 1
            new, starts = place[first], np.cumsum(count) - count
            rank[new] = none
            right = new[~ends_here]
            rank[right] = self.rank(sym[right], sym[right + 1])
            left = new[new > starts] - 1
            rank[left] = self.rank(sym[left], sym[left + 1])
        return done

    def learn(self, chunks) -> None:
        """Encode chunks of text without white space into the cache."""
        chunks = list(chunks)
        if len(self.known) + len(chunks) > CACHE_WORDS:
            self.known.clear()
        words = [WORDS.findall(c) for c in chunks]
        new = list(dict.fromkeys(chain.from_iterable(words)))
        ids = dict(zip(new, self.encode_words([w.encode() for w in new]) if new else []))
        token = self.token
        for c, ws in zip(chunks, words):
            own = [i for w in ws for i in ids[w].tolist()]
            self.known[c] = (" ".join(map(str, own)), len(own), " ".join(map(token.__getitem__, own)))

    def chunks(self, text: str) -> list[str]:
        """The text after normalisation, cut at white space; no word crosses a cut."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # letter by letter, without the final-sigma rule
        text = text.lower()
        return regex.findall(r"\S+", text) if CONTROLS.search(text) else text.split()

    def encode(self, texts: list[str]) -> list[tuple[str, int, str]]:
        """Per text: decimal ids joined by spaces, their number, and the decoded text."""
        cut = []
        for t in texts:
            pieces = self.parts.split(t) if self.parts and "<|" in t else [t]
            row: list = []
            for p in pieces:
                row.extend([(p,)] if p in self.special else self.chunks(p))
            cut.append(row)
        out = []
        need: set = set()
        begin = 0
        for i, row in enumerate(cut):
            need.update(c for c in row if c.__class__ is str)
            if len(need) > CACHE_WORDS // 3 or i == len(cut) - 1:
                missing = [c for c in need if c not in self.known]
                if len(self.known) + len(missing) > CACHE_WORDS:
                    self.known.clear()
                    missing = list(need)
                self.learn(missing)
                for own in cut[begin:i + 1]:
                    got = [self.known[c] if c.__class__ is str else (str(self.special[c[0]]), 1, c[0]) for c in own]
                    got = [g for g in got if g[1]]
                    out.append((" ".join([g[0] for g in got]), sum([g[1] for g in got]), " ".join([g[2] for g in got])))
                need, begin = set(), i + 1
        return out

    def decode(self, ids) -> str:
        """Tokens joined by spaces, as the library does for a vocabulary without decoder."""
        return " ".join([self.token[i] for i in ids])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids array<int>)`` for every text."""
    def run(batches):
        v = vocabulary(path)
        for batch in slices(batches):
            got = v.encode(batch.column("text").to_pylist())
            ids = pa.array([np.array(s.split(), dtype=np.int32) for s, _, _ in got], type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])
    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` of ``(doc_id, ids)``."""
    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            texts = pa.array([v.decode(x or []) for x in batch.column("ids").to_pylist()], type=pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest_columns(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: every text encoded and decoded,
    reduced to digests in the task that encodes it, so no ids are shuffled or stored."""
    def run(batches):
        v = vocabulary(path)
        for batch in slices(batches):
            got = v.encode(batch.column("text").to_pylist())
            sha = lambda k: pa.array([hashlib.sha256(g[k].encode()).hexdigest() for g in got], type=pa.string())
            n = pa.array([g[1] for g in got], type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n, sha(0), sha(2)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
