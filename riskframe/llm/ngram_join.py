"""N-gram Jaccard join by multiple-global-order prefix filtering.

Two sets with a Jaccard similarity of at least 4/5 agree in at least four fifths of
the larger one. Under any one order of all tokens this bounds how deep the first
common tokens can lie, so a pair must share tokens among the first few of both sets,
whatever the order. Orders used, each on what the one before has left:

1. hash order: the first ``depth(n)`` tokens of a set of n, of which a pair must share
   not one but ``share(n)``;
2. frequency order of those (rarest first, over the whole table): tokens of one set
   only come first and link nothing, common passages come last. A pair must share a
   token among the first ``depth - share + 1``. Most sets have none left here;
3. and 4. two more hash orders, checked for each pair that is left, before
5. the exact comparison, which is a union-find within a group of candidates
   (:mod:`riskframe.llm.linking`), so that no pair of a group of copies is a row.

Equal sets are one node from the start. Sets meet by token in shards: a task packs its
tokens by shard into arrays, so a shuffle moves arrays, not a row per token.

Defined cases: null texts are empty; a set without shingles is linked with nothing;
rows without an id are ignored; repeated rows are documents with equal sets; an empty
table gives an empty result; texts are read whole; other columns are not read. Sets and
tokens are told apart by 64-bit hashes; similarity is exact in whole numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Tables, bloom_filter, bloom_holds, connected_components, find_roots, slices, splitmix, texts_of
from riskframe.llm.linking import Union, link_components, one_by_one
from riskframe.llm.shingles import set_keys, shingle_sets

#: Similarity as a fraction.
NUM, DEN = 4, 5
SHARD_TOKENS = 800_000


def prefix(n: np.ndarray) -> np.ndarray:
    """How many first tokens must hold one that a partner shares, under any order."""
    return n - -(-NUM * n // DEN) + 1


def share(n: np.ndarray) -> np.ndarray:
    """Common tokens asked for within the deeper prefix :func:`depth`."""
    return (prefix(n) + 1) // 2


def depth(n: np.ndarray) -> np.ndarray:
    return np.minimum(n, prefix(n) + share(n) - 1)


def rare_prefix(n: np.ndarray) -> np.ndarray:
    """Prefix within the first ``depth(n)`` tokens in another order: a partner has at least
    4/5 of the tokens, so at least ``share(4n/5)`` are common."""
    return depth(n) - share(-(-NUM * n // DEN)) + 1


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return DEN * common >= NUM * (len(x) + len(y) - common)


class TokenIndex:
    """Inverted index of token lists, without tokens that one list alone has."""

    def __init__(self, parts: list[np.ndarray]):
        size = np.array([len(p) for p in parts])
        owner = np.repeat(np.arange(len(parts)), size)
        _, group, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        useful = count[group] > 1
        owner, group = owner[useful], group[useful]
        order = np.argsort(group, kind="stable")
        self.owner, self.group = owner[order], group
        self.count = count * (count > 1)
        self.first = np.cumsum(self.count) - self.count
        self.cut = np.searchsorted(owner, np.arange(len(parts) + 1))
        self.n = len(parts)

    def common(self, i: int) -> np.ndarray:
        """How many tokens each list shares with list i."""
        g = self.group[self.cut[i]:self.cut[i + 1]]
        n = self.count[g]
        at = np.repeat(self.first[g] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.owner[at], minlength=self.n)


def prefixes(sets: list[np.ndarray], seed: int) -> list[np.ndarray]:
    """The sets' prefixes in the hash order of one seed."""
    parts = []
    for s in sets:
        p = int(prefix(np.int64(len(s))))
        order = splitmix(s ^ np.uint64(seed))
        parts.append(np.partition(order, p - 1)[:p] if p < len(order) else order)
    return parts


def shared_with(sets: list[np.ndarray], i: int) -> np.ndarray:
    """How many tokens each set has in common with set i."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
    cum = np.concatenate([[0], np.cumsum(sets[i][at] == flat)])
    ends = np.cumsum(size)
    return cum[ends] - cum[ends - size]


def central(sets: list[np.ndarray], most: int = 4) -> np.ndarray:
    """Sets whose tokens are the commonest in the group: likely partners of many."""
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    size = np.array([len(s) for s in sets])
    cum = np.concatenate([[0], np.cumsum(count[place])])
    ends = np.cumsum(size)
    return np.argsort(-(cum[ends] - cum[ends - size]) / size, kind="stable")[:most]


def link_sets(payloads, roots, fixed):
    """Spanning links of a group of candidates.

    The few most central sets are compared with all; what they join needs no further
    look within that part. Any other link has an end outside the largest part, so
    only sets there look up the partners that every filter leaves them."""
    sets = shingle_sets([bytes(p) for p in payloads])
    size = np.array([len(s) for s in sets])
    if len(sets) == 2:
        return [(0, 1)] if roots[0] != roots[1] and linked(*sets) else []
    union, out = Union(roots), []
    allowed = np.ones(len(sets), dtype=bool) if fixed is None else fixed

    def join(i, j):
        union.join(i, j)
        out.append((i, j))

    for i in central(sets).tolist():
        common = shared_with(sets, i)
        near = np.flatnonzero((DEN * common >= NUM * (size + size[i] - common)) & (allowed | allowed[i]))
        for j in near.tolist():
            if union.root[j] != union.root[i]:
                join(i, j)
    names, count = np.unique(union.root, return_counts=True)
    rest = np.flatnonzero(union.root != names[count.argmax()])
    if not len(rest):
        return out
    orders = [TokenIndex(prefixes(sets, seed)) for seed in (0x1234567, 0x89ABCDEF01)]
    whole = TokenIndex(sets)
    for i in rest.tolist():
        near = (DEN * size >= NUM * size[i]) & (NUM * size <= DEN * size[i]) & (union.root != union.root[i]) & (allowed | allowed[i])
        for order in orders:
            if near.any():
                near &= order.common(i) > 0
        if near.any():
            common = whole.common(i)
            for j in np.flatnonzero(near & (DEN * common >= NUM * (size + size[i] - common))).tolist():
                if union.root[j] != union.root[i]:
                    join(i, j)
    return out


def _by_shard(shard: np.ndarray, arrays: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per shard, holding the bytes of each array's part."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(1, np.int64)
    columns = [pa.array(shard[cut[:-1]].astype(np.int32))]
    for a in arrays.values():
        a = a[order]
        columns.append(pa.array([a[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], type=pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["shard", *arrays])


def _whole(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=kind)


PACKED = "shard int, token binary, node binary, n binary"
FREQUENT = "shard int, token binary, node binary, n binary, df binary"


def _place(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys >> np.uint64(33)) % np.uint64(shards)


def first_tokens(docs: DataFrame, shards: int) -> DataFrame:
    """Order 1: the deep hash-order prefix of every set, packed by token shard."""
    def run(batches):
        for batch in slices(batches, size=8_000_000, rows=4000):
            sets = [s for s in shingle_sets([t.encode() for t in batch.column("text").to_pylist()]) if len(s)]
            if not sets:
                continue
            node = set_keys(sets)
            _, once = np.unique(node, return_index=True)
            sets, node = [sets[i] for i in once], node[once]
            n = np.array([len(s) for s in sets], dtype=np.int64)
            q = depth(n)
            token = np.concatenate([s[:k] for s, k in zip(sets, q)])
            yield _by_shard(_place(splitmix(token), shards), {"token": token, "node": np.repeat(node, q), "n": np.repeat(n, q).astype(np.uint32)})
    return texts_of(docs).mapInArrow(run, PACKED)


def count_tokens(packed: DataFrame, shards: int) -> DataFrame:
    """Tokens that several sets hold, with their frequency, packed by set shard."""
    def run(table: pa.Table) -> pa.Table:
        token, node, n = _whole(table, "token", "u8"), _whole(table, "node", "u8"), _whole(table, "n", "u4")
        order = np.lexsort((node, token))
        token, node, n = token[order], node[order], n[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
        token, node, n = token[new], node[new], n[new]
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        df = np.repeat(np.diff(np.append(start, len(token))), np.diff(np.append(start, len(token))))
        keep = df > 1
        out = _by_shard(_place(node[keep], shards), {"token": token[keep], "node": node[keep], "n": n[keep], "df": df[keep].astype(np.uint32)})
        return pa.Table.from_batches([out])
    return packed.groupBy("shard").applyInArrow(run, FREQUENT)


def rare_tokens(counted: DataFrame, shards: int) -> DataFrame:
    """Order 2: the shared tokens in each set's rarest-first prefix, packed by token shard."""
    def run(table: pa.Table) -> pa.Table:
        token, node, n, df = (_whole(table, c, k) for c, k in (("token", "u8"), ("node", "u8"), ("n", "u4"), ("df", "u4")))
        order = np.lexsort((token, df, node))
        token, node, n = token[order], node[order], n[order].astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        held = np.diff(np.append(start, len(node)))
        alone = depth(n[start]) - held  # tokens of no other set come before all of these
        rank = np.arange(len(node)) - np.repeat(start, held)
        keep = rank < np.repeat(rare_prefix(n[start]) - alone, held)
        out = _by_shard(_place(splitmix(token[keep]), shards), {"token": token[keep], "node": node[keep], "n": n[keep].astype(np.uint32)})
        return pa.Table.from_batches([out])
    return counted.groupBy("shard").applyInArrow(run, PACKED)


def meetings(packed: DataFrame) -> DataFrame:
    """Edges that connect all sets which share a token and are of sizes that can link."""
    def run(table: pa.Table) -> pa.Table:
        token, node, n = _whole(table, "token", "u8"), _whole(table, "node", "u8"), _whole(table, "n", "u4").astype(np.int64)
        order = np.lexsort((n, token))
        token, node, n = token[order], node[order], n[order]
        # along a token's sets by size, neighbours connect whatever lies between a pair that can link
        step = (token[1:] == token[:-1]) & (DEN * n[:-1] >= NUM * n[1:])
        names, at = np.unique(node, return_inverse=True)
        root = find_roots(len(names), at[:-1][step], at[1:][step]) if len(names) else np.zeros(0, np.int64)
        away = np.flatnonzero(root != np.arange(len(names)))
        return pa.table({"a": names[away].view(np.int64), "b": names[root[away]].view(np.int64)})
    return packed.groupBy("shard").applyInArrow(run, "a long, b long")


def set_table(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, node)``: size and key of every document's set."""
    def run(batches):
        for batch in slices(batches):
            sets = shingle_sets([t.encode() for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], type=pa.int64()), pa.array(set_keys(sets).view(np.int64))],
                names=["doc_id", "n_shingles", "node"])
    return texts_of(docs).mapInArrow(run, "doc_id long, n_shingles long, node long")


def texts_by_set(docs: DataFrame, bloom: np.ndarray) -> DataFrame:
    """``(node, payload)`` of sets that the filter lets pass, once per slice of a task."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        for batch in slices(batches):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            node, once = np.unique(set_keys(shingle_sets(texts)), return_index=True)
            keep = bloom_holds(shared.value, node)
            yield pa.RecordBatch.from_arrays([pa.array(node[keep].view(np.int64)), pa.array([texts[i] for i in once[keep].tolist()], type=pa.binary())],
                                             names=["node", "payload"])
    return texts_of(docs).mapInArrow(run, "node long, payload binary")


def ngram_join(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row; the component is the smallest
    document id that links lead to."""
    tables = Tables(docs.sparkSession)
    sets = tables.write(set_table(docs))
    tokens = sets.agg(F.sum("n_shingles")).first()[0] or 0
    shards = max(1, math.ceil(0.3 * tokens / SHARD_TOKENS))
    packed = rare_tokens(count_tokens(first_tokens(docs, shards), shards), shards)
    near = tables.write(connected_components(tables, meetings(packed)).select(F.col("id").alias("node"), F.col("component").alias("comp")))
    texts = texts_by_set(docs, bloom_filter(near, "node")).join(near, "node").groupBy("node").agg(
        F.first("comp").alias("comp"), F.first("payload").alias("payload"))
    links = link_components(tables, texts.select("comp", "node", "payload"), one_by_one(link_sets))
    known = tables.write(sets.join(links, sets["node"] == links["id"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "node").alias("component")))
    least = known.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return known.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
