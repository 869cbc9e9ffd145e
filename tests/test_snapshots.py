"""The stored reference snapshot (K2): versions, reports from it, and its plan."""

import pytest

from riskframe.operators import drift as K
from riskframe.operators.ranking import local_frame, unpivot_numeric
from riskframe.sources import snapshots as S

COLS = ["x", "y"]


def side(spark, rows):
    return local_frame(spark, rows, "x double, y double")


def reference(spark, shift=0.0):
    return side(spark, [(float(i % 37) + shift, -0.0 if i % 3 else None) for i in range(500)])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_report_from_a_stored_snapshot(spark, tmp_path):
    root = str(tmp_path / "snap")
    ref, prod = reference(spark), side(spark, [(float(i % 41), 0.0 if i % 2 else 1.5) for i in range(200)])
    assert S.save_snapshot(ref, COLS, root) == 1
    other = spark.newSession()
    assert rows_of(K.ks_report(S.open_snapshot(other, root), prod, COLS)) == rows_of(K.ks_report(ref, prod, COLS))
    assert S.snapshot_is_whole(spark, root)


def test_reference_is_not_shuffled(spark, tmp_path):
    root = str(tmp_path / "snap")
    S.save_snapshot(reference(spark), COLS, root)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prod = unpivot_numeric(reference(spark, 1.0), COLS)
        joined = K.stored_counts(S.open_snapshot(spark, root), prod)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan      # the production counts
        assert "riskframe_snapshot_" in plan and "Bucketed: true" in plan
        assert joined.count() == 39                                   # 38 values of x, one of y
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_versions_and_half_written_ones(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "snap")
    with pytest.raises(FileNotFoundError):
        S.open_snapshot(spark, root)
    S.save_snapshot(reference(spark), COLS, root)
    assert S.save_snapshot(reference(spark, 5.0), COLS, root) == 2

    def broken(*a, **kw):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(S, "local_frame", broken)                 # fails after the counts, before the meta row
        with pytest.raises(OSError):
            S.save_snapshot(reference(spark, 9.0), COLS, root)
    assert S.snapshot_versions(spark, root) == [1, 2]
    low = {v: S.open_snapshot(spark, root, v).where("variable = 'x'").agg({"value": "min"}).first()[0] for v in (1, 2)}
    assert low == {1: 0.0, 2: 5.0}
    assert S.save_snapshot(reference(spark), COLS, root) == 4
    assert S.snapshot_meta(spark, root)["version"] == 4


def test_empty_reference(spark, tmp_path):
    root = str(tmp_path / "snap")
    S.save_snapshot(reference(spark).limit(0), COLS, root)
    assert S.snapshot_meta(spark, root)["n_rows"] == 0 and S.snapshot_is_whole(spark, root)
    assert K.ks_report(S.open_snapshot(spark, root), reference(spark), COLS).count() == 0


def test_batch_status_of_a_stored_snapshot(spark, tmp_path):
    """Columns are those that the snapshot and the batch share, named ``value`` or not."""
    root = str(tmp_path / "snap")
    ref = reference(spark).withColumnRenamed("y", "value")
    S.save_snapshot(ref, ["x", "value"], root)
    snap = S.open_snapshot(spark, root)
    for batch in (ref, ref.select("x"), reference(spark, 30.0).withColumnRenamed("y", "c_ref"), ref.limit(1), ref.selectExpr("x AS z")):
        assert rows_of(K.batch_status(snap, batch)) == rows_of(K.batch_status(ref, batch))
