"""Cross-tokenizer alignment by sparse incidence matrices.

Two tokenizers cut the same bytes into tokens. Over a slice of texts, ``A`` and ``B`` are the
token-by-byte incidence matrices in CSR form (:class:`Csr`, built by hand; every stored value
is one). A row of ``A·Bᵀ`` (Gustavson: for each byte of an A token, the row of ``Bᵀ`` for that
byte is added up) holds the B tokens that overlap it and the bytes they share:
:func:`overlap_links`. Links whose byte ranges end together cut both token sequences into
groups; the group incidence matrices ``G`` give the links between all tokens of one group as
the product ``G_A·G_Bᵀ`` (:func:`shared_group_links`, row block by row block), and their
number without making a pair as ``G_A·(G_Bᵀ·1)``.

:func:`align` counts for each id pair how many links of the whole corpus hold it. Texts are
dealt to chunks of bounded bytes. A chunk is one row: the distinct id pairs in it, and
per document the places of its pairs in that list (again CSR). Pair counts are one aggregate
over the chunks' lists; what comes back to a chunk is a count per distinct pair of it,
and the documents' sums are products of their sparse rows with these. So the shuffle moves
distinct pairs of chunks, not links, a frequent pair is one row per chunk, and no task
holds more than a chunk.

Defined cases: a null or empty text, and a text whose joined A or B bytes differ from space
and text (a piece vocabulary reads U+2581 as a space), has no tokens: zeros and an empty
``groups_sha256``; rows without an id are ignored; rows that repeat an id are aligned and
counted each; texts of any length are read whole (above ``LONG`` characters the A ids come
from the ``tokenizers`` library itself, with the same result: its pattern matching has no
limit); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskframe.llm.bpe import byte_letters
from riskframe.llm.common import Tables, list_column, slices, texts_of

#: Fixed pattern of the byte-level vocabulary's pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 500_000
#: Text bytes of a slice (arrays held at once) and of a chunk; products made at once.
SLICE_BYTES, CHUNK_BYTES, CHUNK_ROWS, PRODUCTS = 1_000_000, 4_000_000, 50_000, 1 << 20


class Csr(NamedTuple):
    """A matrix of zeros and ones: the columns of row i are ``indices[indptr[i]:indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1


def byte_incidence(lengths: np.ndarray) -> Csr:
    """Tokens by bytes: token i holds the ``lengths[i]`` bytes after those of the tokens before."""
    indptr = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(indptr, np.arange(indptr[-1]))


def group_incidence(group: np.ndarray) -> Csr:
    """Tokens by groups: each token is in one group."""
    return Csr(np.arange(len(group) + 1), group)


def transpose(m: Csr, columns: int) -> Csr:
    row = np.repeat(np.arange(m.rows), np.diff(m.indptr))
    order = np.argsort(m.indices, kind="stable")
    return Csr(np.concatenate([[0], np.cumsum(np.bincount(m.indices, minlength=columns))]), row[order])


def gustavson(a: Csr, b: Csr, columns: int, products: int = PRODUCTS):
    """Rows of ``a·b`` as slabs ``(row, column, value)``, in order of row and column. Rows are
    worked off in blocks of about ``products`` products, so memory is bounded by a row or a block."""
    width = np.diff(b.indptr)
    done = np.concatenate([[0], np.cumsum(width[a.indices])])[a.indptr]
    lo = 0
    while lo < a.rows:
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + products, side="right")) - 1)
        at = a.indices[a.indptr[lo]:a.indptr[hi]]
        n = width[at]
        row = np.repeat(np.repeat(np.arange(lo, hi), np.diff(a.indptr[lo:hi + 1])), n)
        col = b.indices[np.repeat(b.indptr[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        key = row * columns + col
        if (key[1:] < key[:-1]).any():
            key = np.sort(key)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
        yield key[first] // columns, key[first] % columns, np.diff(np.append(first, len(key)))
        lo = hi


def times_vector(m: Csr, x: np.ndarray) -> np.ndarray:
    """``m·x``."""
    total = np.concatenate([[0], np.cumsum(x[m.indices])])
    return total[m.indptr[1:]] - total[m.indptr[:-1]]


def overlap_links(len_a: np.ndarray, len_b: np.ndarray):
    """``A·Bᵀ``: slabs (A token, B token, bytes they share) of token sequences over the same bytes."""
    a, b = byte_incidence(len_a), byte_incidence(len_b)
    yield from gustavson(a, transpose(b, len(b.indices)), max(1, b.rows))


def shared_group_links(group_a: np.ndarray, group_b: np.ndarray, groups: int):
    """``G_A·G_Bᵀ``: slabs (A token, B token, 1) of tokens in the same group."""
    yield from gustavson(group_incidence(group_a), transpose(group_incidence(group_b), groups), max(1, len(group_b)))


def shared_group_counts(group_a: np.ndarray, group_b: np.ndarray, groups: int) -> np.ndarray:
    """How many links of :func:`shared_group_links` each A token has: ``G_A·(G_Bᵀ·1)``."""
    back = transpose(group_incidence(group_b), groups)
    return times_vector(group_incidence(group_a), times_vector(back, np.ones(len(group_b), dtype=np.int64)))


class Tokens:
    """Both tokenizers with the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: b for b, c in enumerate(byte_letters())}
        special = {x["content"] for x in spec["added_tokens"]}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_file(path_a)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes_a[i] = t
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.len_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """A and B ids, both empty where the text has none."""
        none = np.zeros(0, dtype=np.int64)
        if not text:
            return none, none
        b = self.b.encode(text, num_threads=1)
        want = b" " + text.encode()
        if b"".join(map(self.bytes_b.__getitem__, b)) != want:
            return none, none
        spaced = " " + text
        if len(text) > LONG:
            a = np.array(self.library.encode(spaced, add_special_tokens=False).ids, dtype=np.int64)
        else:
            a = self.fast.encode_to_numpy(spaced, disallowed_special=()).astype(np.int64)
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != want:
            return none, none
        return a, np.array(b, dtype=np.int64)


@lru_cache(maxsize=2)
def tokens(path_a: str, path_b: str) -> Tokens:
    return Tokens(path_a, path_b)


class Aligned(NamedTuple):
    """Alignment of a slice of documents."""

    n_a: np.ndarray          # per document
    n_b: np.ndarray
    n_links: np.ndarray      # links that end together: as many groups
    n_shared: np.ndarray     # links between tokens of one group
    sha: list[str]
    doc: np.ndarray          # per link
    pair: np.ndarray         # per link: A id << 32 | B id


def _written(ids: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Decimal ids, each with the byte after it (0: none), and where each one ends."""
    digits = np.ones(len(ids), dtype=np.int64)
    wide = 1
    while len(ids) and 10 ** wide <= ids.max():
        digits += ids >= 10 ** wide
        wide += 1
    out = np.empty((len(ids), wide + 1), dtype=np.uint8)
    for k in range(wide):
        out[:, k] = ids // 10 ** (wide - 1 - k) % 10 + 48
    out[:, wide] = after
    keep = np.arange(wide + 1) >= (wide - digits)[:, None]
    keep[:, wide] = after > 0
    return out[keep].tobytes(), np.cumsum(digits + (after > 0))


def align_slice(ids_a: list[np.ndarray], ids_b: list[np.ndarray], len_of_a: np.ndarray, len_of_b: np.ndarray) -> Aligned:
    """Links and groups of documents given by their ids; both sequences of a document hold the same bytes."""
    n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b))
    a, b = (np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64) for ids in (ids_a, ids_b))
    len_a, len_b = len_of_a[a], len_of_b[b]
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    kept = []
    for i, j, _ in overlap_links(len_a, len_b):
        together = end_a[i] == end_b[j]
        kept.append((i[together], j[together]))
    i, j = (np.concatenate([*c, np.zeros(0, np.int64)]).astype(np.int64) for c in zip(*kept)) if kept else (a[:0], b[:0])
    group_a, group_b = np.searchsorted(end_a[i], end_a), np.searchsorted(end_b[j], end_b)
    doc_a = np.repeat(np.arange(len(n_a)), n_a)
    shared = np.bincount(doc_a, weights=shared_group_counts(group_a, group_b, len(i)), minlength=len(n_a)).astype(np.int64)
    # the groups as text: the tokens of both sides in order of group, A before B
    g = np.arange(len(i))
    order = np.empty(len(a) + len(b), dtype=np.int64)
    after = np.full(len(order), ord(","), dtype=np.uint8)
    at_a = np.arange(len(a)) + np.searchsorted(group_b, g)[group_a]
    at_b = np.arange(len(b)) + np.searchsorted(group_a, g, side="right")[group_b]
    order[at_a], order[at_b] = a, b
    after[at_a[i]] = ord("|")
    after[at_b[j]] = ord(";")
    ends = np.cumsum(n_a + n_b)
    after[ends[n_a > 0] - 1] = 0
    text, upto = _written(order, after)
    cut = np.concatenate([[0], upto])[np.concatenate([[0], ends])].tolist()
    sha = [hashlib.sha256(text[x:y]).hexdigest() if y > x else "" for x, y in zip(cut[:-1], cut[1:])]
    return Aligned(n_a, n_b, np.bincount(doc_a[i], minlength=len(n_a)), shared, sha, doc_a[i], a[i] << 32 | b[j])


CHUNKS = ("chunk long, pair array<long>, times array<long>, doc_id array<long>, n_a array<long>, n_b array<long>, n_links array<long>, "
          "n_shared array<long>, sha array<string>, held array<long>, at array<int>, n array<int>")


def _chunk(name: int, ids: list[np.ndarray], done: list[Aligned]) -> pa.RecordBatch:
    """One row: the distinct pairs of a chunk, and per document the sparse row of its pairs."""
    first = np.cumsum([0, *(len(x) for x in ids)])
    doc = np.concatenate([d.doc + f for d, f in zip(done, first)]) if done else np.zeros(0, np.int64)
    pair, place = np.unique(np.concatenate([d.pair for d in done]), return_inverse=True)
    cell, n = np.unique(doc * max(1, len(pair)) + place, return_counts=True)
    held = np.bincount(cell // max(1, len(pair)), minlength=first[-1])
    at = cell % max(1, len(pair))
    one = lambda x, kind=pa.int64(): list_column(pa.array(x, type=kind), np.array([len(x)]))
    joined = lambda k: np.concatenate([getattr(d, k) for d in done])
    return pa.RecordBatch.from_arrays([
        pa.array([name]), one(pair), one(np.bincount(place, minlength=len(pair))), one(np.concatenate(ids)), one(joined("n_a")), one(joined("n_b")),
        one(joined("n_links")), one(joined("n_shared")), one([s for d in done for s in d.sha], pa.string()), one(held),
        one(at.astype(np.int32), pa.int32()), one(n.astype(np.int32), pa.int32())], names=[c.split()[0] for c in CHUNKS.split(", ")])


def chunks_of(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Aligned chunks of documents (see ``CHUNKS``). Names are partition and number, so the result is
    to be written before it is used: a chunk then has one name."""
    def run(batches):
        own = tokens(path_a, path_b)
        base = TaskContext.get().partitionId() << 32
        ids, done, size, rows = [], [], 0, 0
        for batch in slices(batches, rows=CHUNK_ROWS, size=SLICE_BYTES):
            texts = batch.column("text").to_pylist()
            both = [own.encode(t) for t in texts]
            done.append(align_slice([x for x, _ in both], [x for _, x in both], own.len_a, own.len_b))
            ids.append(batch.column("doc_id").to_numpy())
            size += sum(map(len, texts))
            rows += len(texts)
            if size >= CHUNK_BYTES or rows >= CHUNK_ROWS:
                yield _chunk(base, ids, done)
                base, ids, done, size, rows = base + 1, [], [], 0, 0
        if ids:
            yield _chunk(base, ids, done)
    return texts_of(docs).mapInArrow(run, CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``(pair, count, best)``: the links of the corpus that hold an id pair, and whether no pair with
    the same B id has more."""
    each = chunks.select(F.explode(F.arrays_zip("pair", "times")).alias("p")).select("p.pair", "p.times")
    count = each.groupBy("pair").agg(F.sum("times").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = count.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return count.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _sums(batches):
    """Chunks with the counts of their pairs to a row per document."""
    for batch in batches:
        get = lambda c, k: batch.column(c)[k].values.to_numpy(zero_copy_only=False)
        for k in range(batch.num_rows):
            told = batch.column("told")[k].values
            pairs = len(batch.column("pair")[k])
            count, best = np.zeros(pairs + 1, dtype=np.int64), np.zeros(pairs + 1, dtype=np.int64)
            if told is not None and len(told):
                pos = told.field("pos").to_numpy()
                count[pos] = told.field("count").to_numpy()
                best[pos] = told.field("best").to_numpy(zero_copy_only=False)
            held, at, n = get("held", k), get("at", k), get("n", k).astype(np.int64)
            row = np.concatenate([[0], np.cumsum(held)])
            add = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[row])
            links = get("n_links", k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (get("doc_id", k), get("n_a", k), get("n_b", k), links, links, add(n * best[at]), add(n * count[at]))]
                + [batch.column("sha")[k].values.cast(pa.string()), pa.array(get("n_shared", k))], names=[c.split()[0] for c in RESULT.split(", ")])


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_shared_group_links long")


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``RESULT`` per document. ``n_best``: links whose pair no other pair of the same B id outnumbers
    in the corpus (ties included); ``count_sum``: the corpus counts of the links' pairs, added up."""
    tables = Tables(docs.sparkSession)
    chunks = tables.write(chunks_of(docs, path_a, path_b))
    pairs = tables.write(pair_counts(chunks))
    asked = chunks.select("chunk", F.posexplode("pair").alias("pos", "pair"))
    # both sides of both joins grow with the corpus: merged, whatever their size today
    told = asked.join(pairs.hint("merge"), "pair").groupBy("chunk").agg(F.collect_list(F.struct("pos", "count", "best")).alias("told"))
    full = chunks.join(told.hint("merge"), "chunk", "left")
    return full.mapInArrow(_sums, RESULT)
