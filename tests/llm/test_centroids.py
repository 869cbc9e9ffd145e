import hashlib
import math
import random

import numpy as np
import pytest

from riskframe.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, v int"


def brute(rows, k, rounds, dim):
    """The contract, vector by vector in whole numbers."""
    kept = [(i, [math.floor(256 * float(np.float32(e))) for e in x]) for i, x in rows
            if i is not None and x is not None and len(x) == dim and all(e is not None and math.isfinite(e) for e in x)]
    name = lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[0], r[1])
    cent = [v for _, v in sorted(kept, key=name)[:k]]
    dist = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    near = lambda v: min((dist(v, c), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        own = [[] for _ in cent]
        for _, v in kept:
            own[near(v)[1]].append(v)
        cent = [[sum(col) // len(vs) for col in zip(*vs)] if vs else c for vs, c in zip(own, cent)]
    got = [(i, *near(v)) for i, v in kept]
    part = {}
    for _, d, j in got:
        part[j] = part.get(j, 0) + d
    return sorted((i, j, d, part[j], sum(part.values()), hashlib.sha256(",".join(map(str, cent[j])).encode()).hexdigest()) for i, d, j in got)


def clustered(spark, rows, **parameters):
    df = spark.createDataFrame([(i, x, 0, 7, 8) for i, x in rows], SCHEMA)
    return sorted(tuple(r) for r in C.cluster(df, **parameters).collect())


@pytest.mark.parametrize("kind", ["blobs", "ties"])
def test_matches_brute_force(spark, kind):
    rng = random.Random(kind)
    dim = 6
    if kind == "blobs":
        mid = [[rng.gauss(0, 3) for _ in range(dim)] for _ in range(5)]
        rows = [(i, [m + rng.gauss(0, 1) for m in rng.choice(mid)]) for i in range(150)]
    else:       # few values: equal vectors, equal distances, equal means, clusters that stay empty
        rows = [(i, [rng.choice([-0.5, 0.0, 0.5]) for _ in range(dim)]) for i in range(60)] + [(200 + i, [0.0] * dim) for i in range(9)]
    rows += [(500, None), (501, [1.0]), (502, [1.0] * 5 + [None]), (503, [math.nan] * dim), (504, [math.inf] * dim), (None, [1.0] * dim),
             (505, []), (3, [2.0] * dim), (3, [2.0] * dim), (506, [-0.001] * dim)]
    assert clustered(spark, rows, k=7, rounds=3, dim=dim) == brute(rows, 7, 3, dim)


def test_few_vectors_large_values_and_none(spark):
    rows = [(i, [float(i * 1000), -5.5, 1e30 if i == 2 else 3.0]) for i in range(4)]
    got = clustered(spark, rows, k=40, rounds=2, dim=3)
    assert got == brute([r for r in rows if r[0] != 2], 40, 2, 3)      # 1e30 has no exact distance in a long
    assert clustered(spark, [(1, None)], dim=3) == [] and clustered(spark, [], dim=3) == []


@pytest.mark.parametrize("spread", [1, 300, 100_000_000])
def test_search_is_exact_and_rules_out(spread):
    rng = np.random.default_rng(spread)
    mid = rng.integers(-spread, spread + 1, (30, 16))
    v = (mid[rng.integers(0, 30, 3000)] + rng.integers(-spread // 50, spread // 50 + 1, (3000, 16))).clip(-C.LIMIT, C.LIMIT)
    search = C.CentroidSearch(mid)
    number, d = search.nearest(v)
    full = ((v[:, None, :] - mid[None]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
    if spread > 1:
        assert search.compared < full.size / 3
