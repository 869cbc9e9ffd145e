"""Bounds of many splits in one pass, and in buckets where order values are not spread evenly."""

import pytest

from riskframe.operators import sampling as S

FRACTIONS = (0.1, 0.55, 1.0)


def brute(spark, df, order, n_splits, ranks):
    by = S._split_order("k", 123, order)
    out = {}
    for s in range(n_splits):
        from pyspark.sql import functions as F

        rows = sorted(((r["o"], r["k"] is not None, r["k"]) for r in df.select(
            "k", by.value(by.lead, F.lit(s)).alias("o")).collect()), key=lambda t: (t[0], t[1], t[2] or 0))
        out[s] = [(rows[k][0], rows[k][2]) for k in ranks]
    return out


def found(df, order, n_splits, ranks):
    got = S.split_bounds(df, "k", n_splits, S._split_order("k", 123, order), ranks, df.count())
    return {r["__s"]: [(r[f"__o{i}"], r[f"__k{i}"]) for i in range(len(ranks))] for r in got.collect()}


@pytest.mark.parametrize("order", ["md5", "hash"])
def test_distinct_keys_take_one_pass(spark, monkeypatch, order):
    def never(*_):
        raise AssertionError("the rows are read again")

    monkeypatch.setattr(S, "_bounds_by_buckets", never)
    df = spark.range(0, 20_000, 1, 4).withColumnRenamed("id", "k")
    ranks = [4000, 5600, 9200, 16_000]
    assert found(df, order, 3, ranks) == brute(spark, df, order, 3, ranks)


@pytest.mark.parametrize("order", ["md5", "hash"])
def test_a_frequent_and_a_missing_key(spark, order):
    keys = [7] * 900 + [None] * 40 + list(range(100, 160))
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(3)
    ranks = [0, 200, 500, 999]
    assert found(df, order, 4, ranks) == brute(spark, df, order, 4, ranks)


def test_members_and_expanded_splits_agree(spark):
    df = spark.range(0, 3000, 1, 3).withColumnRenamed("id", "k")
    member = {r["k"]: r["member"] for r in S.split_members(df, "k", 5, train_fractions=FRACTIONS).collect()}
    for r in S.shuffle_splits(df, "k", 5, train_fractions=FRACTIONS).collect():
        m = member[r["k"]][r["split_id"]]
        assert (r["role"] == "test") == (m == 0)
        assert r["size_idx"] == (m - 1 if 1 <= m <= 3 else None)
