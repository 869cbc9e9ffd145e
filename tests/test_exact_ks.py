"""The exact two-sample p-value against counted lattice paths."""

from math import comb

import pytest

from riskframe.operators import drift as K


def counted(n, m, reach):
    """Share of paths that reach a cell with |i m - j n| >= reach, in whole numbers."""
    inside = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n + 1):
        for j in range(m + 1):
            if abs(i * m - j * n) < reach:
                inside[i][j] = 1 if i == j == 0 else (inside[i - 1][j] if i else 0) + (inside[i][j - 1] if j else 0)
    return 1 - inside[n][m] / comb(n + m, n) if inside[n][m] < comb(n + m, n) // 2 else (comb(n + m, n) - inside[n][m]) / comb(n + m, n)


@pytest.mark.parametrize("n,m", [(1, 1), (2, 7), (5, 5), (13, 40), (60, 35), (100, 100)])
def test_path_pvalue_is_the_share_of_paths(n, m):
    for reach in sorted({max(1, n * m * k // 23) for k in range(0, 24)}):
        want = counted(n, m, reach)
        got = K.path_pvalue(reach / (n * m), n, m)
        assert got == pytest.approx(want, abs=1e-9) and got == pytest.approx(K.path_pvalue(reach / (n * m), m, n), rel=1e-9)
    assert K.path_pvalue(0.0, n, m) == 1.0
    assert K.path_pvalue(1.0, n, m) == pytest.approx(2 / comb(n + m, n), rel=1e-12) if n != m or n > 1 else True


def test_small_values_keep_their_digits():
    assert K.path_pvalue(1.0, 200, 300) == pytest.approx(2 / comb(500, 200), rel=1e-10)


def test_report_with_exact_pvalues(spark):
    ref = spark.createDataFrame([(float(i % 17), float(i), None) for i in range(60)], "a double, b double, c double")
    prod = spark.createDataFrame([(float(i % 5), float(i) / 2 + 0.25, 1.0) for i in range(40)], "a double, b double, c double")
    exact = {r.variable: r for r in K.ks_report(ref, prod, ["a", "b", "c"], digits=None, exact=True).collect()}
    assert set(exact) == {"a", "b"}         # c has no reference
    for v, r in exact.items():
        assert r.p_value == pytest.approx(counted(60, 40, round(r.ks_statistic * 2400)), abs=1e-9)
        assert r.drift_detectado == (r.p_value < 0.05)
    big = K.with_exact_pvalue(spark.createDataFrame([("x", 0.1, 20_000, 50), ("y", 0.5, 4, 4), ("z", None, 0, 4)], "variable string, d double, n_ref long, n_prod long"))
    assert {r.variable: r.p_exact for r in big.collect()} == {"x": None, "y": pytest.approx(counted(4, 4, 8)), "z": None}
