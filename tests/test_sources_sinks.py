"""Sources and sinks (S1-S9) round trips in a per-test temporary folder."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.sources import io as IO
from riskframe.sources.loans import loan_table


def test_read_table_with_schema_and_pruning(spark, sf_dir):
    df = IO.read_table(spark, IO.table_path(sf_dir, "orders"), columns=["o_orderkey", "o_totalprice"])
    assert df.columns == ["o_orderkey", "o_totalprice"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_stage_csv_roundtrip(spark, sf_dir, tmp_path):
    df = loan_table(spark, sf_dir).select("loan_id", "capital_prestado", "tipo_laboral")
    IO.stage_csv(df, str(tmp_path / "stage"))
    schema = T.StructType([T.StructField("loan_id", T.LongType()), T.StructField("capital_prestado", T.DoubleType()),
                           T.StructField("tipo_laboral", T.StringType())])
    back = IO.read_stage(spark, str(tmp_path / "stage"), schema)
    assert back.count() == df.count()
    assert back.exceptAll(df).count() == 0


def test_full_refresh_and_namespace(spark, sf_dir, tmp_path):
    IO.ensure_namespace(spark, "riskframe_test")
    df = loan_table(spark, sf_dir).select("loan_id", "Pago_atiempo")
    n = IO.full_refresh(df, "riskframe_test.loans")
    assert n == df.count()
    assert IO.full_refresh(df.limit(10), "riskframe_test.loans") == 10   # replaced, not appended


def test_refresh_is_atomic(spark):
    """A failing load leaves the old rows; a query planned before the swap still has its rows."""
    IO.ensure_namespace(spark, "riskframe_test")
    table = f"riskframe_test.t_{uuid.uuid4().hex}"
    try:
        IO.full_refresh(spark.range(5), table)
        bad = spark.range(100, 0, -1, 4).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
        with pytest.raises(Exception, match="no"):
            IO.full_refresh(bad, table)
        assert sorted(r.id for r in spark.table(table).collect()) == list(range(5))
        planned = spark.table(table)
        planned._jdf.queryExecution().executedPlan()
        assert IO.full_refresh(spark.range(10, 13), table) == 3
        assert sorted(r.id for r in planned.collect()) == list(range(5))
        assert sorted(r.id for r in spark.table(table).collect()) == [10, 11, 12]
        # from the table itself, and with another column
        assert IO.full_refresh(spark.table(table).where("id > 10"), table) == 2
        assert IO.full_refresh(spark.table(table).withColumn("b", F.col("id") * 2), table) == 2
        assert sorted(tuple(r) for r in spark.table(table).collect()) == [(11, 22), (12, 24)]
        home = IO._versions(spark, table)
        assert len(IO.list_folder(spark, home)) == 2      # the rows now and those before
    finally:
        IO.drop_refreshed(spark, table)
    assert not spark.catalog.tableExists(table)


def test_readers_during_a_load_see_a_whole_version(spark):
    """While one thread loads other rows, every count is the old or the new one."""
    import threading

    IO.ensure_namespace(spark, "riskframe_test")
    table = f"riskframe_test.t_{uuid.uuid4().hex}"
    IO.full_refresh(spark.range(10), table)
    errors, done = [], threading.Event()

    def load():
        try:
            IO.full_refresh(spark.range(0, 2000, 1, 40).repartition(40), table)
        except Exception as e:  # noqa: BLE001
            errors.append(e)
        finally:
            done.set()

    t = threading.Thread(target=load)
    t.start()
    seen = set()
    while not done.is_set():
        seen.add(spark.table(table).selectExpr("id + 1 AS id").count())
    t.join()
    IO.drop_refreshed(spark, table)
    assert not errors and seen <= {10, 2000}


def test_metrics_json_and_run_log(spark, tmp_path):
    m = spark.range(1).select(F.lit(0.5).alias("recall"), F.lit(0.7).alias("roc_auc"))
    IO.write_metrics(m, str(tmp_path / "metrics"))
    files = [f for f in os.listdir(tmp_path / "metrics") if f.endswith(".json")]
    assert len(files) == 1
    with open(tmp_path / "metrics" / files[0]) as fh:
        assert json.loads(fh.readline()) == {"recall": 0.5, "roc_auc": 0.7}
    IO.log_run(m, str(tmp_path / "log"), "exp1", "run1")
    IO.log_run(m, str(tmp_path / "log"), "exp1", "run2")
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.where("experiment = 'exp1'").count() == 2


def test_write_report_partitioned(spark, tmp_path):
    rep = spark.createDataFrame([("a", 0.1, True), ("b", 0.2, False)], "variable string, ks double, drift boolean")
    IO.write_report(rep, str(tmp_path / "rep"), partition_by=["drift"])
    assert spark.read.parquet(str(tmp_path / "rep")).count() == 2


def test_range_filter_is_pushed_to_parquet(spark, sf_dir, tmp_path):
    """F1 on a landed raw table: the null-keeping range predicate reaches the scan."""
    from riskframe.operators.filters import range_filter_keep_null
    from riskframe.plans.presets import RANGE_BOUNDS

    loan_table(spark, sf_dir).write.parquet(str(tmp_path / "raw"))
    raw = IO.read_table(spark, str(tmp_path / "raw"))
    df = range_filter_keep_null(raw, RANGE_BOUNDS).select("loan_id", "edad_cliente")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert "PushedFilters: [Or(And(GreaterThanOrEqual(edad_cliente,18),LessThanOrEqual(edad_cliente,100))," \
           "IsNull(edad_cliente))" in plan
    assert "ReadSchema: struct<loan_id:bigint,edad_cliente:int,puntaje_datacredito:double>" in plan


def test_release_tables_removes_lineage_tables(spark):
    import os

    from riskframe.session import cut_lineage, release_tables
    df = cut_lineage(spark.range(10))
    path = df.inputFiles()[0].replace("file:", "").rsplit("/", 1)[0]
    assert os.path.isdir(path) and df.count() == 10
    assert release_tables(spark) >= 1
    assert not os.path.exists(path)
