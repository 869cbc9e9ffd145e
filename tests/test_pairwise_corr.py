"""Pairwise correlation against numpy where sums after one centring cancel."""

import numpy as np
import pytest

from riskframe.operators import aggregates as A
from riskframe.operators.ranking import local_frame


def table(spark, cols, parts):
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in zip(*cols.values())]
    return local_frame(spark, rows, ", ".join(f"{c} double" for c in cols)).repartition(parts)


def want(a, b):
    both = ~np.isnan(a) & ~np.isnan(b)
    da, db = (v[both] - v[both][0] for v in (a, b))         # exact near each other
    da, db = da - da.mean(), db - db.mean()
    return (da * db).sum() / np.sqrt((da * da).sum() * (db * db).sum())


@pytest.mark.parametrize("parts", [1, 7])
def test_values_far_off_whose_presence_is_split(spark, parts):
    rng = np.random.default_rng(4)
    n = 3000
    z = rng.normal(size=n)
    a = np.where(np.arange(n) % 2 == 0, 1e9, -1e9) + np.round(z, 3)    # where b is there, near 1e9 alone
    b = np.where(np.arange(n) % 2 == 0, 1e9 + np.round(z + rng.normal(size=n), 3), np.nan)
    c = np.where(np.arange(n) % 2 == 1, 1e9 + np.round(rng.normal(size=n) - z, 3), np.nan)
    cols = {"a": a, "b": b, "c": c}
    got = {(r.var_a, r.var_b): r["corr"] for r in A.corr_matrix(table(spark, cols, parts)).collect()}
    for x, y in (("a", "b"), ("a", "c"), ("a", "a"), ("b", "b")):
        assert got[x, y] == pytest.approx(want(cols[x], cols[y]), abs=1e-9)
        assert got[y, x] == got[x, y]
    assert got["b", "c"] is None                            # never there together


def test_constant_infinite_and_single_rows(spark):
    nan = float("nan")
    cols = {"x": np.array([1e9 + 0.1] * 4 + [5.0]), "y": np.array([1.0, 2, 3, 5, nan]), "i": np.array([1.0, np.inf, 2, 3, 4]),
            "s": np.array([1.0, nan, nan, nan, nan])}
    got = {(r.var_a, r.var_b): r["corr"] for r in A.corr_matrix(table(spark, cols, 3)).collect()}
    assert np.isnan(got["x", "y"]) and np.isnan(got["i", "y"])
    assert got["s", "y"] is None and got["y", "y"] == pytest.approx(1.0)
    empty = table(spark, cols, 2).where("false")
    assert {r["corr"] for r in A.corr_matrix(empty).collect()} == {None}
