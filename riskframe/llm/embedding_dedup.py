"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact
cosine verification, distributed connected components.

Equal vectors are first one row with a multiplicity. Each distinct vector gets a sign
code per table; vectors that share a code are compared exactly in double precision,
inside a task, block by block. A pair counts in the first table where it meets, so
links are counted once without a row per pair; what leaves a task is one count per
vector and a spanning forest of the links. A bucket above ``BLOCK`` rows is dealt to
pairs of blocks, so no task holds a whole hot bucket.

The number of bits follows the number of distinct vectors, the number of tables
follows from the bits and the recall wanted at the threshold itself (links above the
threshold are found more often).

Defined cases: null ids are ignored; null vectors, vectors with null or non-finite
components and zero vectors link with nothing, nor do vectors of different lengths;
repeated rows are other vectors equal to the first; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Tables, connected_components, find_roots, list_column

BLOCK = 2000


def plan_tables(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits, tables) for ``n`` distinct vectors."""
    bits = int(min(24, max(6, math.log2(max(n, 2) / 16))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


@lru_cache(maxsize=8)
def planes(dim: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, count))


def sign_codes(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """(vectors, tables) codes; each table has its own hyperplanes."""
    side = (vectors @ planes(vectors.shape[1], bits * tables, seed) > 0).reshape(len(vectors), tables, bits)
    return side @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def link_block(ids, times, x, codes, table, cross, threshold):
    """Links of one block: (vector, links) sums and forest edges. ``cross`` is None, or which
    of two blocks each row is in; then only pairs across them count."""
    x = x.astype(np.float64)
    # a power of two off each vector changes no cosine, and squares neither overflow nor vanish
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    norm = np.sqrt((x * x).sum(axis=1))
    links = np.zeros(len(ids), dtype=np.int64)
    parts_a, parts_b = [], []
    for lo in range(0, len(ids), 512):
        hi = min(lo + 512, len(ids))
        near = (x[lo:hi] @ x.T) / (norm[lo:hi, None] * norm[None, :]) >= threshold
        a, b = np.nonzero(near)
        a = a + lo
        keep = a < b
        if cross is not None:
            keep &= cross[a] != cross[b]
        a, b = a[keep], b[keep]
        if table and len(a):
            new = ~(codes[a][:, :table] == codes[b][:, :table]).any(axis=1)
            a, b = a[new], b[new]
        np.add.at(links, a, times[b])
        np.add.at(links, b, times[a])
        parts_a.append(a)
        parts_b.append(b)
    a, b = np.concatenate(parts_a), np.concatenate(parts_b)
    root = find_roots(len(ids), a, b) if len(a) else np.arange(len(ids))
    joined = root != np.arange(len(ids))
    return ids[links > 0], links[links > 0], ids[joined], ids[root[joined]]


def dedup(embeddings: DataFrame, threshold: float = 0.95, recall: float = 0.998, seed: int = 7) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every vector."""
    spark = embeddings.sparkSession
    tables = Tables(spark)
    rows = embeddings.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    fine = F.col("x").isNotNull() & F.coalesce(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)) & \
        F.coalesce(F.exists("x", lambda v: v != 0), F.lit(False))
    distinct = tables.write(rows.where(fine).groupBy("x").agg(F.min("vec_id").alias("rep"), F.count("*").alias("times")))
    n = distinct.count()
    bits, count = plan_tables(n, threshold, recall)

    def hashed(batches):
        for batch in batches:
            size = np.diff(batch.column("x").offsets.to_numpy())
            flat = batch.column("x").flatten().to_numpy()
            at = np.concatenate([[0], np.cumsum(size)])
            for dim in np.unique(size):
                pick = np.flatnonzero(size == dim)
                x = np.stack([flat[at[i]:at[i] + dim] for i in pick])
                codes = sign_codes(x / np.abs(x).max(axis=1, keepdims=True), bits, count, seed)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep").take(pa.array(pick)), list_column(codes.reshape(-1), np.full(len(pick), count)),
                     pa.array(np.full(len(pick), dim, dtype=np.int32))], names=["rep", "codes", "dim"])

    codes = tables.write(distinct.select("rep", "x").mapInArrow(hashed, "rep long, codes array<long>, dim int"))
    met = codes.select("rep", "dim", F.posexplode("codes").alias("tab", "code"))
    full = met.groupBy("dim", "tab", "code").agg(F.count("*").alias("size")).where("size > 1")
    met = met.join(full, ["dim", "tab", "code"])
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    met = met.select("rep", "dim", "tab", "code", own.alias("own"), other.alias("other"))
    met = met.select("rep", "tab", F.col("own"), F.xxhash64("dim", "tab", "code", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"),
                     (F.col("own") == F.col("other")).alias("same"))
    met = tables.write(met)
    shards = max(1, math.ceil(met.count() / 4000))
    work = met.join(distinct.join(codes, "rep"), "rep").withColumn("shard", F.pmod(F.col("bucket"), F.lit(shards)))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in pdf.groupby("bucket", sort=False):
            if len(g) < 2:
                continue
            same = bool(g["same"].iloc[0])
            got = link_block(g["rep"].to_numpy(), g["times"].to_numpy(), np.stack(g["x"].to_numpy()),
                             np.stack(g["codes"].to_numpy()), int(g["tab"].iloc[0]), None if same else g["own"].to_numpy(), threshold)
            out.append(pd.DataFrame({"a": np.concatenate([got[0], got[2]]), "b": np.concatenate([got[1], got[3]]),
                                     "edge": np.concatenate([np.zeros(len(got[0]), bool), np.ones(len(got[2]), bool)])}))
        return pd.concat(out) if out else pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "edge": np.zeros(0, bool)})

    found = tables.write(work.repartition(shards, "shard").groupBy("shard").applyInPandas(verify, "a long, b long, edge boolean"))
    links = found.where("NOT edge").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("links"))
    comp = connected_components(tables, found.where("edge").select("a", "b")).select(F.col("id").alias("rep"), "component")
    known = tables.write(distinct.join(links, "rep", "left").join(comp, "rep", "left").select(
        "x", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    return rows.join(known, "x", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"))

