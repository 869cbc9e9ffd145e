import numpy as np
import pytest
from brute import components

from riskframe.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=0, n=300, dim=24):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dim))
    x = [c + rng.normal(size=dim) * s for c in centers for s in rng.uniform(0.05, 0.35, n // 12)]
    x += [x[0], x[0], 3 * x[1], -x[2]]
    return [[float(np.float32(v)) for v in r] for r in x]


def brute(rows, threshold=0.95):
    ok = [i for i, (_, x) in enumerate(rows) if x and all(v is not None and np.isfinite(v) for v in x) and any(x)]
    links, edges = [0] * len(rows), []
    for a in ok:
        for b in ok:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    edges.append((a, b))
    return links, components(len(rows), edges)


@pytest.mark.parametrize("block", [2000, 7])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    rows = list(enumerate(vectors()))
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 24), (n + 2, [float("nan")] * 24), (n + 3, [None] * 24), (n + 4, [float("inf")] * 24),
             (n + 5, []), (n + 6, [1.0, 2.0]), (n + 7, [1.0, 2.1])]
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA).selectExpr("*", "1 AS rep", "2 AS x", "3 AS codes")
    got = {r.vec_id: r for r in E.dedup(df, recall=0.99999).collect()}
    links, root = brute(rows)
    assert len(got) == len(rows) and sum(links) > 500
    assert [got[i].n_links for i in range(len(rows))] == links
    assert [got[i].component_id for i in range(len(rows))] == root
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_recall_of_links_at_the_planned_size(spark):
    rows = list(enumerate(vectors(3, n=600, dim=32)))
    got = {r.vec_id: r.n_links for r in E.dedup(spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA)).collect()}
    links, _ = brute(rows)
    assert all(got[i] <= links[i] for i in range(len(rows)))
    assert sum(got.values()) >= 0.99 * sum(links)


def test_empty_repeats_and_null_ids(spark):
    df = spark.createDataFrame([(4, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (9, [0.0, 1.0], 0)], SCHEMA)
    got = sorted(map(tuple, E.dedup(df).collect()))
    assert got == [(4, 1, 4, True), (4, 1, 4, True), (9, 0, 9, True)]
    assert E.dedup(df.where("false")).count() == 0


def test_plan_reaches_the_recall_asked_for():
    for n in (10, 10**4, 10**7, 10**10):
        bits, tables = E.plan_tables(n, 0.95, 0.998)
        same = (1 - np.arccos(0.95) / np.pi) ** bits
        assert 1 - (1 - same) ** tables >= 0.998


def test_very_large_and_very_small_vectors_keep_their_links(spark):
    x = np.random.default_rng(4).normal(size=8)
    rows = [(i, [float(v) for v in x * scale + (i % 2) * 0.01 * scale]) for i, scale in enumerate([1.0, 1e160, 1e-170, 3e300, 1e-300, 1e150])]
    rows += [(10, [float(v) for v in -x * 1e160])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.dedup(df, recall=0.99999).collect()}
    assert got == {**{i: (5, 0) for i in range(6)}, 10: (0, 10)}
