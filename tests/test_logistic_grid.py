"""The batched learning curve against one Newton solver per fit, row by row in numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import logistic as L
from riskframe.operators.ranking import local_frame
from riskframe.operators.sampling import shuffle_splits, split_members, train_size_grid

FRACTIONS = (0.3, 0.6, 1.0)
SCHEMA = "k long, y int, a double, b double, c double, g string"


def table(spark, n=400, seed=5, one_class=False):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        a, b = rng.normal(), rng.normal(1e6, 3.0)
        y = 1 if one_class else int(a + 0.4 * (b - 1e6) + rng.normal() > -0.5)
        rows.append((k, y, None if k % 11 == 0 else a, b, 7.0, "only" if k == 3 else "pqr"[k % 3]))
    return local_frame(spark, rows, SCHEMA), rows


def brute(rows, levels):
    """Coefficients and the decision function of one fit by plain Newton steps."""
    raw = np.array([[np.nan if v is None else v for v in r[2:5]] for r in rows], dtype=float)
    mean, dev = np.nanmean(raw, axis=0), np.nanstd(raw, axis=0)
    dev = np.where(dev < 1e-9, 1.0, dev)

    def design(some):
        v = np.array([[np.nan if v is None else v for v in r[2:5]] for r in some], dtype=float)
        hot = np.array([[float(r[5] == lv) for lv in levels] for r in some])
        return np.hstack([np.ones((len(some), 1)), np.nan_to_num((v - mean) / dev, nan=0.0), hot])

    z, y = design(rows), np.array([r[1] for r in rows])
    w = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    beta, ridge = np.zeros(z.shape[1]), np.r_[0.0, np.ones(z.shape[1] - 1)]
    for _ in range(100):
        p = 1 / (1 + np.exp(-(z @ beta)))
        beta = beta + np.linalg.lstsq(z.T @ (z * (w * p * (1 - p))[:, None]) + np.diag(ridge),
                                      z.T @ (w * (y - p)) - ridge * beta, rcond=None)[0]
    return beta, lambda some: design(some) @ beta


def test_curve_equals_one_solver_per_fit(spark):
    df, rows = table(spark)
    got = {(r["split_id"], r["train_size"]): r for r in L.logistic_learning_curve(
        df.repartition(5), "k", "y", ["a", "b", "c"], ["g"], n_splits=4, fractions=FRACTIONS).collect()}
    levels = sorted({r[5] for r in rows})
    by_key = {r[0]: r for r in rows}
    member = {}
    for r in shuffle_splits(df.select("k"), "k", 4, train_fractions=FRACTIONS).collect():
        member.setdefault(r["split_id"], []).append((r["k"], r["size_idx"]))
    sizes = train_size_grid(320, FRACTIONS)
    assert set(got) == {(s, size) for s in range(4) for size in sizes}
    for s in range(4):
        held = [by_key[k] for k, i in member[s] if i is None]
        for i, size in enumerate(sizes):
            sub = [by_key[k] for k, j in member[s] if j is not None and j <= i]
            assert len(sub) == size
            _, decide = brute(sub, levels)
            r = got[s, size]
            for some, recall, n_pos in ((sub, "train_recall", "n_train_pos"), (held, "test_recall", "n_test_pos")):
                zero = [x for x in some if x[1] == 0]
                assert r[n_pos] == len(zero)
                assert r[recall] == pytest.approx(float(np.mean(decide(zero) <= 0)), abs=1e-12)
            assert r["score_equation"] < 1e-6 and r["fit_time"] > 0 and r["score_time"] > 0


def test_coefficients_equal_brute_force(spark):
    df, rows = table(spark)
    levels = sorted({r[5] for r in rows})
    members = split_members(df, "k", 2, train_fractions=FRACTIONS)
    enc = L.encode_rows(members, ["a", "b", "c"], {"g": levels}, "y")
    fits = L.fit_logistic_grid(enc.repartition(3), 2, 3, 3, 3 + len(levels))
    inside = {r["k"]: r["member"] for r in members.collect()}
    for f, fit in fits.items():
        sub = [r for r in rows if 1 <= inside[r[0]][f // 3] <= f % 3 + 1]
        assert np.allclose(fit["beta"], brute(sub, levels)[0], atol=1e-7)


def test_single_class_predicts_it(spark):
    df, _ = table(spark, 60, one_class=True)
    rows = L.logistic_learning_curve(df, "k", "y", ["a"], ["g"], n_splits=2, fractions=(1.0,), pos_label=1).collect()
    assert [(r["train_recall"], r["test_recall"], r["steps"]) for r in rows] == [(1.0, 1.0, 0)] * 2
    none = L.logistic_learning_curve(df, "k", "y", ["a"], ["g"], n_splits=2, fractions=(1.0,), pos_label=0).collect()
    assert all(r["train_recall"] == 0 and r["n_test_pos"] == 0 for r in none)


def test_targets_that_are_no_class_and_empty_tables(spark):
    df, _ = table(spark, 80)
    odd = df.withColumn("y", F.when(F.col("k") % 10 == 0, None).otherwise(F.col("y")))
    assert L.logistic_learning_curve(odd, "k", "y", ["a", "b"], [], n_splits=2, fractions=(0.5, 1.0)).count() == 4
    assert L.logistic_learning_curve(df.limit(0), "k", "y", ["a"], [], n_splits=2).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 7, 500])
def test_members_are_ranks(spark, n):
    """Members against a full sort of every split, with repeated order values decided by the key."""
    df = spark.range(n).select(F.col("id").alias("k"))
    grid = train_size_grid(n - math.ceil(n * 0.2), FRACTIONS)
    got = {r["k"]: r["member"] for r in split_members(df, "k", 6, train_fractions=FRACTIONS).collect()}
    expanded = {(r["k"], r["split_id"]): (r["role"], r["size_idx"]) for r in shuffle_splits(
        df, "k", 6, train_fractions=FRACTIONS).collect()}
    import hashlib

    for s in range(6):
        order = sorted(range(n), key=lambda k: (int(hashlib.md5(f"{k}|123|{s}".encode()).hexdigest()[:8], 16), k))
        for rank, k in enumerate(order):
            place = rank - math.ceil(n * 0.2)
            want = 0 if place < 0 else 1 + sum(place >= m for m in grid)
            assert got[k][s] == want
            role = "test" if place < 0 else "train"
            assert expanded[k, s] == (role, want - 1 if 1 <= want <= len(grid) else None)


def test_fits_start_from_the_fit_of_all_rows(spark, monkeypatch):
    """The passes over all fits, the costly ones, are fewer than from coefficients of zero, with the same end."""
    rng = np.random.default_rng(9)
    rows = [(k, int(1.5 * a - 2.0 * b + rng.logistic() > 2.0), float(a), float(5 + 3 * b), 7.0, "pq"[k % 2])
            for k, (a, b) in enumerate(rng.normal(size=(6000, 2)))]
    df = local_frame(spark, rows, SCHEMA)
    enc = L.encode_rows(split_members(df, "k", 2, train_fractions=FRACTIONS), ["a", "b", "c"], {"g": ["p", "q"]}, "y").persist()
    fits = L.fit_logistic_grid(enc, 2, 3, 3, 5)
    monkeypatch.setattr(L, "_started", lambda *_: None)
    cold = L.fit_logistic_grid(enc, 2, 3, 3, 5)
    for f in cold:
        assert fits[f]["done"] and np.allclose(fits[f]["beta"], cold[f]["beta"], atol=1e-7)
    assert max(f["steps"] for f in fits.values()) < max(f["steps"] for f in cold.values())
