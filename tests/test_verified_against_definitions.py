"""Operators against their definitions, worked out by hand or by counting, not by a
second query."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions.exprs import md5_order
from riskframe.operators import aggregates as A
from riskframe.operators import drift as K
from riskframe.operators import evaluation as V
from riskframe.operators import sampling as S
from riskframe.operators.ranking import local_frame
from riskframe.streaming import monitor as M


def test_selection_score_uses_the_test_f_beta(spark):
    rows = [("a", 0.9, 0.10, 3.0, 0.40), ("b", 0.1, 0.00, 1.0, 0.45)]
    df = local_frame(spark, rows, "modelo string, cv_fbeta_mean double, cv_fbeta_std double, cv_fit_time_mean double, test_fbeta double")
    got = {r.modelo: (r.selection_score, r.rank) for r in V.rank_candidates(V.selection_score(df)).collect()}
    assert got["a"][0] == pytest.approx(0.60 * 0.40 + 0.25 / 1.10 + 0.15 / 4.0)
    assert got["b"][0] == pytest.approx(0.60 * 0.45 + 0.25 / 1.00 + 0.15 / 2.0)
    assert got["b"][1] == 1


def _tests(spark, **kw):
    df = spark.range(4000).withColumnRenamed("id", "k")
    rows = S.shuffle_splits(df, "k", test_size=0.2, **kw).where("role = 'test'").collect()
    out = {}
    for r in rows:
        out.setdefault(r.split_id, set()).add(r.k)
    return out


def test_shuffle_splits_are_independent(spark):
    a, b = _tests(spark, n_splits=3, seed=123), _tests(spark, n_splits=1, seed=42)
    assert all(len(x) == 800 for x in [*a.values(), *b.values()])
    for x, y in ((a[0], a[1]), (a[0], a[2]), (a[1], a[2]), (a[0], b[0])):
        assert 0.15 < len(x & y) / 800 < 0.25


def test_random_order_takes_any_key_and_every_seed(spark):
    big = spark.createDataFrame([(4_000_000_000 * 2_000_000_000,), (-1,), (0,)], "k long")
    a, b = ([r[0] for r in big.select(md5_order("k", s)).collect()] for s in (42, 43))
    assert all(0 <= x < 2**32 for x in a + b) and not set(a) & set(b)


def test_corr_of_a_column_constant_over_the_pair_is_nan(spark):
    rows = [(1e9 + 0.1, 1.0), (1e9 + 0.1, 2.0), (1e9 + 0.1, 5.0), (7.0, None), (8.0, None)]
    got = A.pairwise_corr(spark.createDataFrame(rows, "x double, y double"), [("x", "y")]).first()["corr"]
    assert math.isnan(got)


def test_sweep_counts_a_score_at_its_own_threshold(spark):
    rows = [(1, i / 100) for i in range(101)] + [(0, 0.29), (1, 0.5799999999)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = {round(r.threshold * 100): r.tp + r.fp for r in V.threshold_sweep(df, steps=100).collect()}
    assert got == {i: sum(s >= i / 100 for _, s in rows) for i in range(101)}


def exact_ks_p(d, m, n):
    """P(D >= d) of two samples without ties, by counting lattice paths inside the band."""
    ways = np.zeros(n + 1)
    for i in range(m + 1):
        for j in range(n + 1):
            if abs(i / m - j / n) >= d - 1e-12:
                ways[j] = 0
            elif i or j:
                ways[j] = (ways[j] if i else 0) + (ways[j - 1] if j else 0)
            else:
                ways[j] = 1
        # scale, so that large sizes stay finite
    return 1 - ways[n] / math.comb(m + n, n)


@pytest.mark.parametrize("m,n", [(20, 30), (50, 50), (40, 200)])
def test_ks_p_value_is_near_the_exact_one(spark, m, n):
    ds = [k / 20 for k in range(2, 18)]
    df = local_frame(spark, [(d, m, n) for d in ds], "d double, m long, n long")
    got = {r.d: r.p for r in df.select("d", K.kolmogorov_pvalue(F.col("d"), F.col("m"), F.col("n")).alias("p")).collect()}
    for d in ds:
        # the statistic of such samples is a multiple of 1/lcm: compare at the next reachable value
        steps = math.lcm(m, n)
        reach = math.ceil(d * steps - 1e-9) / steps
        p = {r.d: r.p for r in local_frame(spark, [(reach, m, n)], "d double, m long, n long").select(
            "d", K.kolmogorov_pvalue(F.col("d"), F.col("m"), F.col("n")).alias("p")).collect()}[reach] if reach != d else got[d]
        assert abs(p - exact_ks_p(reach, m, n)) < 0.045
        if p < 0.1:  # where decisions are made
            assert abs(p - exact_ks_p(reach, m, n)) < 0.02


def test_report_from_a_snapshot_is_the_same(spark):
    rng = np.random.default_rng(0)
    ref = spark.createDataFrame([(float(x), int(y)) for x, y in zip(rng.normal(size=300), rng.integers(0, 5, 300))], "x double, y long")
    prod = spark.createDataFrame([(float(x), int(y)) for x, y in zip(rng.normal(0.5, 1, 80), rng.integers(0, 5, 80))], "x double, y long")
    a = K.ks_report(ref, prod, ["x", "y"]).collect()
    b = K.ks_report(K.reference_snapshot(ref, ["x", "y"]), prod, ["x", "y"]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 2


def test_batch_status_texts(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(60)], "x double")
    far = spark.createDataFrame([(float(i + 500),) for i in range(60)], "x double")
    said = lambda b: tuple(K.batch_status(ref, b).first())
    assert said(far) == (K.STATUS["drift"], True, 1)
    assert said(ref) == (K.STATUS["none"], False, 1)
    assert said(far.limit(1)) == (K.STATUS["small"], False, 0)
    assert said(far.select(F.col("x").alias("z"))) == (K.STATUS["schema"], False, 0)


def test_batch_status_walks_the_reference_only_for_columns_of_enough_values(spark, monkeypatch):
    ref = spark.createDataFrame([(float(i), float(i)) for i in range(60)], "x double, y double")
    batch = spark.createDataFrame([(float(i + 500), 3.0 if i == 0 else None if i % 2 else float("nan")) for i in range(60)], "x double, y double")
    walked = []
    plain = K.ks_table
    monkeypatch.setattr(K, "ks_table", lambda r, p, cols: walked.append(list(cols)) or plain(r, p, cols))
    said = lambda r, b: tuple(K.batch_status(r, b).first())
    for r in (ref, K.reference_snapshot(ref, ["x", "y"])):
        assert said(r, batch.limit(1)) == (K.STATUS["small"], False, 0)
        assert said(r, batch.where("false")) == (K.STATUS["small"], False, 0)
        assert walked == []
        assert said(r, batch) == (K.STATUS["drift"], True, 1) and walked.pop() == ["x"]


def test_knn_is_exact_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(S, "KNN_CELL", 15)
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(200, 3)), 1)          # rounded: ties happen
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double, c double")
    got = {}
    for r in S.exact_knn(df, "k", ["a", "b", "c"], 4).collect():
        got.setdefault(r.k, {})[r.nb_rank] = r.nb_key
    for i in range(200):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        want = sorted((j for j in range(200) if j != i), key=lambda j: (d[j], j))[:4]
        assert [got[i][k] for k in range(4)] == want


def test_late_rows_are_left_out_in_append_mode(spark, tmp_path):
    """The watermark closes a period: rows that come after it change nothing."""
    src = str(tmp_path / "in")
    schema = "ts timestamp, event_type string, value double"

    def put(rows):
        spark.createDataFrame(rows, "ts string, event_type string, value double").selectExpr(
            "cast(ts AS timestamp) ts", "event_type", "value").coalesce(1).write.mode("append").parquet(src)

    put([("2024-01-02 00:00:00", "a", 1.0), ("2024-01-03 00:00:00", "a", 3.0)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (M.stream_period_stats(stream, "7 days", watermark="1 day").writeStream.outputMode("append").format("memory")
         .queryName("late_rows_t").option("checkpointLocation", str(tmp_path / "ck")).start())
    try:
        q.processAllAvailable()
        put([("2024-01-20 00:00:00", "a", 5.0)])          # moves the watermark past the first period
        q.processAllAvailable()
        put([("2024-01-02 12:00:00", "a", 100.0)])        # late
        q.processAllAvailable()
        put([("2024-02-20 00:00:00", "a", 7.0)])
        q.processAllAvailable()
    finally:
        q.stop()
    got = {str(r.period_start)[:10]: (r.n, r.mean_value) for r in spark.sql("SELECT * FROM late_rows_t").collect()}
    first = [v for k, v in got.items() if k < "2024-01-08"]
    assert first == [(2, 2.0)]


def test_a_cluster_needs_a_shared_checkpoint_folder(spark, monkeypatch):
    from riskframe import session

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda *a: None)}))

    class Session:
        sparkContext = Context
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})

    with pytest.raises(ValueError, match="checkpoint"):
        session.checkpoint_dir(Session)
