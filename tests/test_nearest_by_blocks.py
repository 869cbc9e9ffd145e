"""Neighbours by blocks and cells against every pair, and SMOTE from every minority row."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import sampling as S


def every_pair(q, names, x, keys, k):
    out = []
    with np.errstate(over="ignore", invalid="ignore"):
        for row, name in zip(q, names):
            d = np.sqrt(((row - x) ** 2).sum(axis=1))
            ok = np.flatnonzero(np.isfinite(d) & (keys != name))
            out += [(int(name), int(keys[j]), float(d[j])) for j in sorted(ok, key=lambda j: (d[j], keys[j]))[:k]]
    return sorted(out)


def by_blocks(*args):
    return sorted((int(a), int(b), float(d)) for a, b, d in zip(*S.nearest_by_blocks(*args)))


@pytest.mark.parametrize("kind", ["plain", "ties", "same", "odd"])
def test_blocks_give_what_every_pair_gives(monkeypatch, kind):
    monkeypatch.setattr(S, "KNN_FIRST", 20)
    monkeypatch.setattr(S, "KNN_BLOCK", 8)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    if kind == "ties":
        x = np.round(x, 0)
    if kind == "same":
        x[:200] = x[0]
    if kind == "odd":
        x[3], x[4], x[5] = np.nan, np.inf, 1e200
    keys = rng.permutation(300) + 10
    assert by_blocks(x, keys, x, keys, 3, np.full(300, np.inf)) == every_pair(x, keys, x, keys, 3)
    q, names = rng.normal(size=(40, 4)), np.arange(40) + 1000
    assert by_blocks(q, names, x, keys, 3, np.full(40, np.inf)) == every_pair(q, names, x, keys, 3)


def test_points_that_are_the_same_are_dealt_to_cells_and_queries_to_tasks(spark, monkeypatch):
    for name, value in (("KNN_CELL", 20), ("KNN_ASKED", 30)):
        monkeypatch.setattr(S, name, value)
    x = np.round(np.random.default_rng(2).normal(size=(260, 2)), 1)
    x[:150] = 0.5
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double")
    got = {(r.k, r.nb_rank): r.nb_key for r in S.exact_knn(df, "k", ["a", "b"], 3).collect()}
    want = {}
    for i, j, _ in sorted(every_pair(x, np.arange(260), x, np.arange(260), 3), key=lambda r: (r[0], r[2], r[1])):
        want[i, sum((i, r) in want for r in range(3))] = j
    assert got == want


def test_every_minority_row_takes_part_in_smote(spark):
    """More minority rows than the 200,000 that SMOTE once learnt from: each is the start of a new row."""
    n = 200_100
    rows = spark.range(3 * n).select(F.col("id").alias("k"), (F.col("id") >= n).cast("int").alias("y"),
                                     (F.col("id") * 7919 % 100_003).cast("double").alias("a"), (F.col("id") % 89).cast("double").alias("b"))
    new = S.smote(rows, "y", ["a", "b"], "k", minority=0, k=3, seed=7).where("synthetic")
    assert new.agg(F.count("*").alias("n"), F.count_distinct("k").alias("k"), F.max("k").alias("last")).first() == (n, n, n - 1)
