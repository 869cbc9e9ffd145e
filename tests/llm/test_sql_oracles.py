"""Queries that SQL can express, against DuckDB over whole tables."""

import duckdb
import pytest

from riskframe.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(registry.SQL[name]).df()
    got = registry.QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got[cols].values.tolist())) == sorted(map(tuple, want[cols].values.tolist()))


def test_every_operator_has_a_query():
    assert {int(k[2:].split("_")[0]) for k in registry.QUERIES if k.startswith("op")} == set(range(1, 14))
    assert "pipeline" in registry.QUERIES
