"""Helpers shared by the operators: reading tables, written intermediates,
distributed connected components, and shuffling packed arrays."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of every row that has an id; a null text is empty.
    Every other column is left behind, so clashing names cannot matter."""
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


class Tables:
    """Intermediates of one query, written as parquet under the shared checkpoint
    folder (they survive lost executors and cut lineage)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/riskframe-llm/{uuid.uuid4().hex}"
        self.n = 0

    def write(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *frames: DataFrame) -> None:
        """Delete the files behind frames of :meth:`write` that are no longer read."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for df in frames:
            for file in df.inputFiles()[:1]:
                path = jvm.org.apache.hadoop.fs.Path(file).getParent()
                path.getFileSystem(conf).delete(path, True)


def _is_stars(edge: DataFrame) -> bool:
    """Whether every edge (u, v) leads from a node with no other edge to a root."""
    ends = edge.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionAll(
        edge.select(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    bad = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR (out > 0 AND into > 0)")
    return bad.limit(1).count() == 0


def connected_components(tables: Tables, edges: DataFrame) -> DataFrame:
    """Components of an undirected graph: ``edges(a, b)`` longs to ``(id, component)``
    for every node of an edge, where component is the smallest id of its component.

    Alternating large-star and small-star rounds until only stars are left. Each star
    step is one aggregate (with map-side combine, so a hub is one partial row per task)
    and one join back to the edges, and is written to the shared folder."""
    edge = tables.write(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _is_stars(edge):
        # large star: the larger neighbours of u point at the least of u and its neighbours
        both = edge.unionAll(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = tables.write(edge.select(F.col("v").alias("at"), F.col("u").alias("far")).join(low, F.col("at") == low["u"]).select(
            F.col("far").alias("u"), F.col("m").alias("v")).where("u <> v"))
        # small star: u and its smaller neighbours all point at the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = tables.write(small)
        tables.drop(large, edge)
        edge = after
    return edge.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        edge.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def find_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component, for local edges given as index arrays."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            return root


def splitmix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def list_column(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """A list column without per-row Python objects."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def slices(batches, rows: int = 1000, size: int = 4_000_000, column: str = "text"):
    """Cut record batches into pieces of bounded rows and, but for single rows, bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        start, held = 0, 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()):
            if i > start and (held + n > size or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)



#: Bits of a :func:`bloom_filter`: a fixed size, whatever it holds.
BLOOM_BITS = 1 << 23


def bloom_filter(df: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of a long column of hashes, of fixed size (1 MB), so it may be sent to
    every task ahead of an exact join. With more values it lets more pass; it never loses one."""
    at = [F.shiftrightunsigned(F.col(column), 20 * k).bitwiseAND(F.lit(BLOOM_BITS - 1)) for k in range(3)]
    bits = df.select(F.explode(F.array(*at)).alias("bit")).select(
        F.shiftright("bit", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("bits"))
    got = bits.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BLOOM_BITS // 64, dtype=np.int64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return out.view(np.uint64)


def bloom_holds(bloom: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes.view(np.uint64) if hashes.dtype == np.int64 else hashes
    out = np.ones(len(h), dtype=bool)
    for k in range(3):
        bit = (h >> np.uint64(20 * k)) & np.uint64(BLOOM_BITS - 1)
        out &= (bloom[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out
