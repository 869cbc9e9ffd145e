"""Every registered query against its DuckDB oracle at sf0.001 (the driver runs
the same comparison at sf0.01). Queries without an oracle get a rows check."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from riskframe.sources.io import TABLES

from riskframe.plans.catalog import QUERIES
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return str(v)
        return float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if v.__class__.__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    return v


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only <= {"a_quantiles_approx", "r_smote", "m_logreg_batch_score", "m_random_forest",
                         "m_gradient_boosting", "m_xgboost", "m_candidates", "v_learning_curve_logreg"}, rows_only


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, con, name):
    sdf = QUERIES[name](spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert spark_types == duck_types
    idx = [rel.columns.index(c) for c in cols]
    orows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert srows == orows


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "grupo_edad" in df.columns


BUCKETED = ["a_describe_numeric", "a_box_stats", "q_fit_medians", "f_clip_tail_p99", "r_stratified_split",
            "r_sample_n", "r_kfold", "r_stratified_kfold", "r_train_sizes", "v_roc_curve", "v_roc_auc",
            "v_learning_curve", "k_ks_report", "d_quadrant_rates"]


@pytest.mark.parametrize("name", BUCKETED)
def test_query_matches_oracle_with_many_fine_buckets(spark, sf_dir, con, name, monkeypatch):
    """The same queries with 20 rows to a fine bucket, as many as large groups have."""
    from riskframe.operators import ranking
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 20)
    test_query_matches_oracle(spark, sf_dir, con, name)
