"""Lexical retrieval packing of token ids into fixed windows.

Each task cuts its rows into shards of bounded rows and text. A shard has its own
BM25 inverted index over token ids. Seeds go from the longest document to the
shortest; a seed's unused neighbours, best score first, fill the rest of its window,
whole where they fit; the best one left is cut to close the window, and its rest is
used later. So every window is full but the shard's last, whose ids are dealt to
sequences of power-of-two lengths, which need no padding. Nothing is shuffled, and a
task's memory is bounded by a shard and one record batch.

Token ids are those of a byte-level BPE file of the ``tokenizers`` library, whose path is
a parameter (see :class:`TextEncoder`).

Defined cases: a null text is empty and gives the end id alone; rows without an id are
ignored; repeated rows are packed each; ties in score go to the earlier row; other
columns are not read; an empty table gives no pieces.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskframe.llm.bpe import byte_letters
from riskframe.llm.common import slices, texts_of

#: Fixed pattern of the vocabulary's pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 500_000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class TextEncoder:
    """Ids of whole texts, as the ``tokenizers`` library gives for a byte-level BPE file.

    The file's own vocabulary is handed to ``tiktoken``, which applies the same merges
    several times faster; texts above ``LONG`` characters go to the library itself, whose
    pattern matching has no limits."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: b for b, c in enumerate(byte_letters())}
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        if len(text) > LONG:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


class Bm25Index:
    """Inverted index of one shard: postings (document, weight) sorted by term."""

    def __init__(self, docs: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        owner = np.repeat(np.arange(len(docs)), lengths)
        terms = np.concatenate(docs).astype(np.int64)
        pair, tf = np.unique(terms * len(docs) + owner, return_counts=True)
        term, self.doc = pair // len(docs), pair % len(docs)
        self.terms, self.start, df = np.unique(term, return_index=True, return_counts=True)
        self.count = df
        idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5))
        norm = k1 * (1 - b + b * lengths / max(1.0, lengths.mean()))
        self.weight = np.repeat(idf, df) * tf * (k1 + 1) / (tf + norm[self.doc])
        # terms of each document, as places in self.terms
        by_doc = np.argsort(self.doc, kind="stable")
        self.own = np.repeat(np.arange(len(self.terms)), df)[by_doc]
        self.own_start = np.searchsorted(self.doc[by_doc], np.arange(len(docs) + 1))
        self.n = len(docs)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the terms of the seed."""
        t = self.own[self.own_start[seed]:self.own_start[seed + 1]]
        n = self.count[t]
        at = np.repeat(self.start[t] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def pack_shard(docs: list[np.ndarray], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold each id once."""
    index = Bm25Index(docs)
    left = np.array([len(d) for d in docs], dtype=np.int64)  # ids not yet placed
    total = left.copy()
    out: list[list[tuple[int, int, int]]] = []
    for seed in np.argsort(-left, kind="stable").tolist():
        if not left[seed]:
            continue
        while left[seed] >= window:
            out.append([(seed, int(total[seed] - left[seed]), window)])
            left[seed] -= window
        if not left[seed]:
            continue
        row = [(seed, int(total[seed] - left[seed]), int(left[seed]))]
        room = window - int(left[seed])
        left[seed] = 0
        free = np.flatnonzero(left)
        if len(free):
            near = free[np.argsort(-index.scores(seed)[free], kind="stable")]
            sizes = left[near]
            if sizes.sum() > room:
                spare = None
                for d, n in zip(near.tolist(), sizes.tolist()):
                    if n <= room:
                        row.append((d, int(total[d] - n), n))
                        left[d] = 0
                        room -= n
                        if not room:
                            break
                    elif spare is None:
                        spare = d
                if room and spare is not None:
                    row.append((spare, int(total[spare] - left[spare]), room))
                    left[spare] -= room
                    room = 0
            else:
                for d, n in zip(near.tolist(), sizes.tolist()):
                    row.append((d, int(total[d] - n), n))
                    left[d] = 0
                    room -= n
        if room:
            out.extend(powers_of_two(row))
        else:
            out.append(row)
    return out


def powers_of_two(row: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Deal the pieces to sequences whose lengths are the binary digits of their sum."""
    size = sum(n for *_, n in row)
    parts = [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]
    out: list[list[tuple[int, int, int]]] = [[] for _ in parts]
    k, room = 0, parts[0]
    for d, s, n in row:
        while n:
            take = min(n, room)
            out[k].append((d, s, take))
            s, n, room = s + take, n - take, room - take
            if not room and k + 1 < len(parts):
                k, room = k + 1, parts[k + 1]
    return out


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, shard_rows: int = 1024) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``: ids are the
    piece's as little-endian unsigned 32-bit integers; the pieces of a sequence, in order
    of offset, are its contents. A sequence shorter than the window is a power of two."""
    end = np.array([end_id], dtype="<u4")

    def run(batches):
        enc = encoder(path)
        sequence = TaskContext.get().partitionId() << 32
        for batch in slices(batches, rows=shard_rows):
            ids = [np.concatenate([enc.encode(t), end]) for t in batch.column("text").to_pylist()]
            name = batch.column("doc_id").to_numpy()
            rows = []
            for seq in pack_shard(ids, window):
                at = 0
                for d, s, n in seq:
                    rows.append((d, s, n, sequence, at))
                    at += n
                sequence += 1
            d, s, n, q, at = (np.array(c, dtype=np.int64) for c in zip(*rows))
            held = pa.array([ids[i][a:a + k].tobytes() for i, a, k, *_ in rows], type=pa.binary())
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[d]), pa.array(s), pa.array(n), held, pa.array(sizes[d]), pa.array(q), pa.array(at)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return texts_of(docs).mapInArrow(run, SCHEMA)


def digest_columns(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
