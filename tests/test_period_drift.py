"""Drift per period (K9): the batch form against its definition, and the stream with late rows
against the batch form."""

import random
from datetime import datetime, timedelta

import pytest

from riskframe.operators import drift as K
from riskframe.operators.drift import kolmogorov_pvalue
from riskframe.streaming import monitor as M

T0 = datetime(2024, 2, 1)        # the first day of a 7-day window
SCHEMA = "ts timestamp, `a|b` double, c double"


def rows_of(days, n, seed):
    rng = random.Random(seed)
    pick = lambda d: (T0 + timedelta(days=d, seconds=rng.randrange(86400)), rng.choice([None, float("nan"), float(rng.randrange(6))]) if rng.random() < 0.5
                      else rng.gauss(d / 20, 1), float(rng.randrange(-3, 3)))
    return [pick(d) for d in days for _ in range(n)]


def definition(ref, prod):
    """Largest gap of two distributions over all values of both."""
    cdf = lambda xs, v: sum(x <= v for x in xs) / len(xs)
    return max(abs(cdf(ref, v) - cdf(prod, v)) for v in {*ref, *prod})


def test_periods_by_definition(spark):
    ref, ev = rows_of(range(3), 40, 1), rows_of(range(0, 30), 9, 2) + [(T0 + timedelta(days=40), 1.0, None)]
    got = K.drift_by_period(spark.createDataFrame(ref, SCHEMA), spark.createDataFrame(ev, SCHEMA), ["a|b", "c"], digits=None).collect()
    fine = lambda rows, k: [r[k] for r in rows if r[k] is not None and r[k] == r[k]]
    want = {}
    for day in range(0, 49, 7):
        start = T0 + timedelta(days=day)
        part = [r for r in ev if start <= r[0] < start + timedelta(days=7)]
        for k, name in ((1, "a|b"), (2, "c")):
            if len(fine(part, k)) >= 2:
                want[start, name] = definition(fine(ref, k), fine(part, k))
    assert {(r.period_start, r.variable): r.ks_statistic for r in got} == pytest.approx(want)
    assert len(want) == 10 and {r.drift_detectado for r in got} == {True, False}
    r = got[0]
    n = len(fine(ref, 1 if r.variable == "a|b" else 2))
    m = len(fine([x for x in ev if r.period_start <= x[0] < r.period_start + timedelta(days=7)], 1 if r.variable == "a|b" else 2))
    p = spark.range(1).select(kolmogorov_pvalue(*[K.F.lit(v) for v in (r.ks_statistic, n, m)]).alias("p")).first().p
    assert r.p_value == pytest.approx(p)


def test_no_events_and_no_values(spark):
    ref = spark.createDataFrame(rows_of(range(2), 20, 3), SCHEMA)
    assert K.drift_by_period(ref, ref.where("false"), ["a|b", "c"]).count() == 0
    assert K.drift_by_period(ref, spark.createDataFrame([(T0, None, None)], SCHEMA), ["a|b", "c"]).count() == 0


def test_stream_with_late_rows_equals_batch(spark, tmp_path):
    """Rows arrive out of order, some a week late; each period is reported once, after it ended."""
    ref = spark.createDataFrame(rows_of(range(3), 40, 4), SCHEMA)
    ev = rows_of(range(0, 42), 6, 5)
    rng = random.Random(6)
    arrival = sorted(ev, key=lambda r: r[0] + timedelta(days=rng.choice([0, 0, 0, 2, 6])))
    ends = (T0 + timedelta(days=90), None, None)        # moves the watermark past all periods
    src = tmp_path / "in"
    for i, part in enumerate([arrival[k:k + 50] for k in range(0, len(arrival), 50)] + [[ends]]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(src / f"{i:03d}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    snap = K.reference_snapshot(ref, ["a|b", "c"])
    snap = spark.createDataFrame(snap.collect(), snap.schema)
    seen = []
    q = M.stream_period_drift(stream, snap, ["a|b", "c"], lambda rep, i: seen.append([tuple(r) for r in rep.collect()]), checkpoint=str(tmp_path / "ck"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    want = sorted(tuple(r) for r in K.drift_by_period(snap, spark.createDataFrame(ev, SCHEMA), ["a|b", "c"]).collect())
    assert sorted(r for rep in seen for r in rep) == want and len(want) == 12
    assert len(seen) > 2        # as periods end, not all at the end
