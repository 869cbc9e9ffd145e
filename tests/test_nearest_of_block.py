"""The k nearest of a block by a matrix product against every distance measured term by term."""

import numpy as np
import pytest

from riskframe.operators import sampling as S


def brute(q, names, x, keys, k):
    with np.errstate(all="ignore"):
        d = np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    d[names[:, None] == keys[None, :]] = np.inf
    take = np.lexsort((np.broadcast_to(keys, d.shape), d), axis=1)[:, :k]
    dd = np.take_along_axis(d, take, axis=1)
    ok = np.isfinite(dd).ravel()
    return np.repeat(names, take.shape[1])[ok], keys[take].ravel()[ok], dd.ravel()[ok]


@pytest.mark.parametrize("scale,offset", [(1.0, 0.0), (1e8, 1e9), (1e-9, 0.0), (1e160, 0.0), (1e-3, 1e9)])
def test_block_equals_brute_force(scale, offset):
    rng = np.random.default_rng(1)
    for case in range(30):
        n, m, width, k = rng.integers(1, 60), rng.integers(1, 60), rng.integers(1, 25), rng.integers(1, 6)
        x = np.round(rng.normal(size=(n, width)), 1) * scale + offset        # rounded: ties happen
        q = np.round(rng.normal(size=(m, width)), 1) * scale + offset
        keys, names = rng.integers(0, n, n), rng.integers(0, 80, m)          # keys may repeat
        if case % 3 == 0:
            x[0, 0], q[-1, 0] = np.nan, np.inf
        if case % 5 == 0:
            x[:] = q[0]                                                      # copies
        got = S.nearest_of_block(q, names, x, keys, k, np.full(m, np.inf))
        for a, b in zip(got, brute(q, names, x, keys, k)):
            assert np.array_equal(a, b)


def test_a_bound_loses_no_point_within_it():
    rng = np.random.default_rng(2)
    x, q = np.round(rng.normal(size=(300, 5)), 1), np.round(rng.normal(size=(40, 5)), 1)
    keys, names = np.arange(300), np.arange(1000, 1040)
    within = rng.uniform(0.2, 3, 40)
    rows, nbs, d = S.nearest_of_block(q, names, x, keys, 4, within)
    got = set(zip(rows.tolist(), nbs.tolist(), d.tolist()))
    want = {t for t in zip(*(v.tolist() for v in brute(q, names, x, keys, 4))) if t[2] <= within[t[0] - 1000]}
    assert want and want <= got


def test_pairs_of_a_block_are_held_in_parts(monkeypatch):
    monkeypatch.setattr(S, "KNN_PAIRS", 64)
    x = np.ones((50, 3))
    x[:, 0] = np.arange(50)
    rows, nbs, _ = S.nearest_of_block(x, np.arange(50), x, np.arange(50), 2, np.full(50, np.inf))
    assert [nbs[rows == 0].tolist(), nbs[rows == 20].tolist()] == [[1, 2], [19, 21]]
