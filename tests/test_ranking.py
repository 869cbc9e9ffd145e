"""The bucketed rank / quantile / running-total core against brute force,
including a hot value holding a third of the rows and a narrow band."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

import pytest

from riskframe.operators import ranking as R


@pytest.fixture(params=[20, R.ROWS_PER_BUCKET], autouse=True)
def rows_per_bucket(request, monkeypatch):
    """Many fine buckets, as large groups have, and the default."""
    monkeypatch.setattr(R, "ROWS_PER_BUCKET", request.param)


def _frame(spark, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.lognormal(10, 2, n), 0)
    x[: n // 3] = 0.0                      # one value holds a third of the rows
    x[n // 3: n // 3 + 200] = 1e6 + rng.random(200)   # a narrow band
    x[::53] = np.nan
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "x": x, "k": np.arange(n)})
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    return pdf, df


def test_row_rank_matches_row_number(spark):
    pdf, df = _frame(spark)
    got = R.with_row_rank(df, ["g"], ["x", "k"]).toPandas().sort_values("k")
    exp = df.withColumn("rr", F.row_number().over(Window.partitionBy("g").orderBy("x", "k")) - 1) \
        .toPandas().sort_values("k")
    assert (got.row_rank.values == exp.rr.values).all()


def test_exact_quantiles_match_pandas(spark):
    pdf, df = _frame(spark)
    qs = [0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0]
    q = R.quantile_table(df, ["x", "k"], qs, group_by=["g"]).toPandas()
    for (g, var, qq), v in q.set_index(["g", "variable", "q"])["quantile"].items():
        e = pdf[pdf.g == g][var].dropna().quantile(qq)
        assert abs(v - e) <= 1e-9 * max(1.0, abs(e)), (g, var, qq, v, e)


def test_quantile_interpolates_like_pandas(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "v double")
    assert abs(R.quantile_values(df, ["v"], 0.99)["v"] - 3.96) < 1e-12
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "v double")
    assert R.quantile_values(df, ["v"], 0.5)["v"] == 3.0


def test_running_totals_match_cumsum(spark):
    pdf, df = _frame(spark)
    agg = df.where("x is not null").groupBy("g", "x").agg(F.count("*").alias("c"))
    rt = R.running_totals(agg, ["g"], "x", ["c"]).toPandas().sort_values(["g", "x"])
    assert (rt.groupby("g").c.cumsum().values == rt.cum_c.values).all()


def _special(spark):
    return spark.createDataFrame([(1, 1.0), (2, 2.0), (3, float("nan")), (4, 0.5), (5, None), (6, float("inf")),
                                  (7, float("-inf")), (8, float("nan")), (9, -3.0), (10, None)], "k long, x double")


def test_rank_orders_null_nan_and_infinity_as_a_window(spark):
    df = _special(spark)
    got = {r.k: r.row_rank for r in R.with_row_rank(df, [], ["x", "k"]).collect()}
    exp = {r.k: r.rr for r in df.withColumn("rr", F.row_number().over(Window.orderBy("x", "k")) - 1).collect()}
    assert got == exp


def test_rank_below_and_running_totals_on_special_values(spark):
    df = _special(spark)
    cuts = R.local_frame(spark, [(0, 4), (1, 9)], "cut_idx int, k long")
    got = {r.k: r.cut_idx for r in R.rank_below(df, [], ["x", "k"], cuts).collect()}
    exp = {r.k: 0 if r.rr < 4 else 1 if r.rr < 9 else None
           for r in df.withColumn("rr", F.row_number().over(Window.orderBy("x", "k")) - 1).collect()}
    assert got == exp
    agg = df.where("x is not null").groupBy("x").agg(F.count("*").alias("c"))
    got = sorted((repr(r.x), r.cum_c) for r in R.running_totals(agg, [], "x", ["c"]).collect())
    assert got == sorted([("-inf", 1), ("-3.0", 2), ("0.5", 3), ("1.0", 4), ("2.0", 5), ("inf", 6), ("nan", 8)])


def test_no_window_is_partitioned_by_the_class_or_a_constant(spark):
    """The rows are windowed by (group, coarse, fine bucket) only."""
    _, df = _frame(spark)
    plan = R.with_row_rank(df, ["g"], ["x", "k"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.strip(" :+-").startswith("Window")]
    rows = [w for w in windows if "row_number()" in w]
    assert rows and all("__b2" in w for w in rows)


def test_rank_below_matches_row_number(spark):
    pdf, df = _frame(spark)
    cuts = R.local_frame(spark, [(g, i, k) for g in range(3) for i, k in enumerate([5, 100, 400, 700])],
                         "g long, cut_idx int, k long")
    got = R.rank_below(df, ["g"], ["x", "k"], cuts).toPandas().set_index("k")["cut_idx"]
    rr = df.withColumn("rr", F.row_number().over(Window.partitionBy("g").orderBy("x", "k")) - 1).toPandas()
    def exp(r):
        for i, k in enumerate([5, 100, 400, 700]):
            if r < k:
                return i
        return None
    for _, row in rr.iterrows():
        e = exp(row.rr)
        gv = got[row.k]
        assert (e is None and (gv is None or gv != gv)) or gv == e, (row.k, row.rr, gv, e)


def test_rank_below_global(spark):
    pdf, df = _frame(spark)
    cuts = R.local_frame(spark, [(0, 250)], "cut_idx int, k long")
    got = R.rank_below(df, [], ["k"], cuts, known_range=(0, 3000))
    assert sorted(r.k for r in got.where("cut_idx = 0").collect()) == list(range(250))


def _wide(n=3000):
    """Values over all sizes of a double, both signs, and a dense band of large negative ones."""
    rng = np.random.default_rng(5)
    size = 10.0 ** rng.uniform(-300, 308, n // 2)
    edge = [0.0, -0.0, 1e8, -1e8, np.nextafter(1e8, 0), -np.nextafter(1e8, 0), 1e-300, -1e-300, 1.7e308, -1.7e308, np.inf, -np.inf, -1e9, -1e200]
    rows = [*(size * rng.choice([-1, 1], n // 2)), *rng.uniform(-5e8, -5e6, n - n // 2), *edge, float("nan")]
    return [*map(float, rows), None, None]


def test_coarse_buckets_keep_the_order(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(_wide())], "k long, x double")
    got = df.select("k", "x", R._coarse(F.col("x")).alias("b")).orderBy("x").collect()
    assert all(a.b <= b.b for a, b in zip(got, got[1:]))
    assert len({r.b for r in got}) > 500


def test_ranks_and_quantiles_of_negative_values(spark):
    vals = _wide()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, x double")
    want = {r.k: r.n - 1 for r in df.select("k", F.row_number().over(Window.orderBy("x", "k")).alias("n")).collect()}
    assert {r.k: r.row_rank for r in R.with_row_rank(df, [], ["x", "k"]).collect()} == want
    money = df.where("x between -5e8 and -5e6")
    qs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    right = money.agg(F.percentile("x", F.array(*map(F.lit, qs))).alias("p")).first().p
    got = {r.q: r.quantile for r in R.quantile_table(money, ["x"], qs).collect()}
    assert [got[q] for q in qs] == pytest.approx(right, rel=1e-14)


def test_running_totals_of_negated_scores(spark):
    df = spark.createDataFrame([(float(-v), 1) for v in range(10_000_000, 1_000_000_000, 3_300_000)], "s double, c int")
    got = [r.cum_c for r in R.running_totals(df, [], "s", ["c"]).orderBy("s").collect()]
    assert got == list(range(1, df.count() + 1))
