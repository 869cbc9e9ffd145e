"""Centroid clustering of integer vectors by equal-average equal-variance search.

Vectors become whole numbers, ``floor(scale * x)``, so every distance and every centroid is
exact. Nearest centroids are found by :class:`CentroidSearch`: centroids are sorted by
component mean, a vector starts at the place of its own mean and scans outward; a side ends
when its mean inequality ``d² >= n (mean difference)²`` rules out all that is left there, a
centroid is passed over when mean and deviation together
(``d² >= n (mean difference)² + (deviation difference)²``, deviations being root sums of
squares about the mean) do, and the others are compared in 64-bit whole numbers. Ties go to
the smaller number. The inequalities are taken in doubles with a slack far above their
rounding, so they never rule out a centroid that is as near as the best.

A round is one pass over the written table of integer vectors: tasks hold ``k`` centroids
and add up ``k`` sums, one aggregate adds these per (cluster, component), and ``k * n`` sums,
whatever the size of the table, come to the driver, where exact floors make the next
centroids. Sums are decimals: they do not overflow.

Defined cases: rows without an id are ignored; null vectors, vectors of another length and
vectors with null or non-finite components are left out, as are those with a component of
2**27 / scale or more in size, whose squared distances a long cannot hold; rows that repeat
an id are vectors each; equal seeds are taken in order of id and components; with fewer than
``k`` vectors there are as many centroids as vectors; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Tables, list_column

LIMIT = 1 << 27
#: Vectors that a task compares at once.
BATCH = 4096


def whole_vectors(embeddings: DataFrame, dim: int, scale: int) -> DataFrame:
    """``(vec_id, v array<int>)`` of the vectors that count."""
    x = F.col("x")
    rows = embeddings.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    size = float(LIMIT) / scale
    fine = x.isNotNull() & (F.size("x") == dim) & F.coalesce(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < size)), F.lit(False))
    return rows.where(fine).select("vec_id", F.transform("x", lambda v: F.floor(F.lit(float(scale)) * v).cast("int")).alias("v"))


class CentroidSearch:
    """Nearest of a few integer centroids (rows of ``centroids``)."""

    def __init__(self, centroids: np.ndarray):
        c = centroids.astype(np.int64)
        total = c.sum(axis=1)
        self.order = np.argsort(total, kind="stable")
        self.c, self.total = c[self.order], total[self.order].astype(np.float64)
        self.spread = self._spread(self.c)
        self.compared = 0       # vectors times centroids whose distance was computed

    @staticmethod
    def _spread(v: np.ndarray) -> np.ndarray:
        x = v.astype(np.float64)
        return np.sqrt(((x - x.mean(axis=1, keepdims=True)) ** 2).sum(axis=1))

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of each row of ``v``."""
        v = v.astype(np.int64)
        n, dim = v.shape
        k = len(self.c)
        total, spread = v.sum(axis=1).astype(np.float64), self._spread(v)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k)
        up = np.searchsorted(self.total, total)       # next place to look at above, and below
        down = up - 1
        live = np.arange(n)
        while len(live):
            gap_up = np.where(up[live] < k, self.total[np.minimum(up[live], k - 1)] - total[live], np.inf)
            gap_down = np.where(down[live] >= 0, total[live] - self.total[np.maximum(down[live], 0)], np.inf)
            climb = gap_up <= gap_down
            gap = np.where(climb, gap_up, gap_down)
            by_mean = gap * gap / dim
            # the nearer side is ruled out by its mean: so is all that is left on both
            most = best[live].astype(np.float64) * (1 + 1e-9) + 1e-3
            on = by_mean <= most
            live, climb, by_mean, most = live[on], climb[on], by_mean[on], most[on]
            place = np.where(climb, up[live], down[live])
            up[live] += climb
            down[live] -= ~climb
            apart = np.abs(spread[live] - self.spread[place]) - 1e-9 * (spread[live] + self.spread[place])
            near = by_mean + np.maximum(apart, 0) ** 2 <= most
            at, place = live[near], place[near]
            self.compared += len(at)
            d = v[at] - self.c[place]
            d = np.einsum("ij,ij->i", d, d)
            label = self.order[place]
            better = (d < best[at]) | (d == best[at]) & (label < number[at])
            at = at[better]
            best[at], number[at] = d[better], label[better]
        return number, best


def _rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().reshape(-1, dim)


def _cut(batches, rows: int = BATCH):
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest lower-case hex SHA-256 of ``seed`` and id."""
    name = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    got = vectors.select(name.alias("name"), "vec_id", "v").orderBy("name", "vec_id", "v").limit(k).collect()
    return np.array([r.v for r in got], dtype=np.int64)


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every non-empty centroid becomes the floor of its vectors' mean."""
    k, dim = centroids.shape

    def sums(batches):
        search = CentroidSearch(centroids)
        total, count = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for b in _cut(batches):
            v = _rows(b, dim)
            number, _ = search.nearest(v)
            order = np.argsort(number, kind="stable")
            own, start = np.unique(number[order], return_index=True)
            total[own] += np.add.reduceat(v[order].astype(np.int64), start, axis=0)
            count += np.bincount(number, minlength=k)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(count[own]), list_column(total[own].reshape(-1), np.full(len(own), dim))],
                                         names=["cluster", "n", "total"])

    parts = vectors.select("v").mapInArrow(sums, "cluster long, n long, total array<long>")
    wide = "decimal(38,0)"
    added = parts.select("cluster", "n", F.posexplode("total").alias("pos", "part")).groupBy("cluster", "pos").agg(
        F.sum(F.col("n").cast(wide)).alias("n"), F.sum(F.col("part").cast(wide)).alias("total"))
    out = centroids.copy()
    for r in added.collect():      # k * dim rows
        out[r.cluster, r.pos] = int(r.total) // int(r.n)
    return out


def centroid_name(c: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()


def cluster(embeddings: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: str = "2:") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of each vector kept."""
    spark = embeddings.sparkSession
    tables = Tables(spark)
    vectors = tables.write(whole_vectors(embeddings, dim, scale))
    centroids = first_centroids(vectors, k, seed)
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = next_centroids(vectors, centroids)

    def assign(batches):
        search = CentroidSearch(centroids)
        for b in _cut(batches):
            number, d = search.nearest(_rows(b, dim))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(d)], names=["vec_id", "cluster", "distance"])

    found = tables.write(vectors.mapInArrow(assign, schema))
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = sum(inertia.values())
    # a row per centroid: at most k, so it may be broadcast
    known = spark.createDataFrame([(i, s, whole, centroid_name(centroids[i])) for i, s in inertia.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: str = "2:") -> str:
    """DuckDB SQL for :func:`cluster` over a table ``embeddings`` with distinct ids."""
    d2 = f"list_sum(list_transform(range(1, {dim + 1}), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))"
    parts = [f"""x AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dim})""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}' || vec_id)) - 1 AS cluster, v FROM x
  ORDER BY sha256('{seed}' || vec_id) LIMIT {k})"""]
    near = "SELECT vec_id, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (SELECT x.vec_id, c.cluster, {d2} AS d FROM x, c{r} c) GROUP BY vec_id"
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(d2=d2, r=r)})")
        parts.append(f"""s{r} AS (SELECT cluster, pos, sum(e) AS s, count(*) AS n FROM (SELECT a.cluster, unnest(x.v) AS e, unnest(range(1, {dim + 1})) AS pos
  FROM a{r} a JOIN x USING (vec_id)) GROUP BY cluster, pos)""")
        parts.append(f"""m{r} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS v FROM s{r} GROUP BY cluster)""")
        parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} USING (cluster))")
    parts.append(f"f AS MATERIALIZED ({near.format(d2=d2, r=rounds)})")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(f.cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY f.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM f JOIN c{rounds} c ON c.cluster = f.cluster"""
