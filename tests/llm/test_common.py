import random

import numpy as np
import pyarrow as pa
import pytest
from brute import components

from riskframe.llm import common as C


@pytest.mark.parametrize("kind", ["chain", "hub", "random"])
def test_connected_components(spark, kind):
    rng = random.Random(kind)
    ids = list({rng.randrange(-2**62, 2**62) for _ in range(60)})
    if kind == "chain":
        edges = list(zip(ids, ids[1:]))
        rng.shuffle(edges)
    elif kind == "hub":
        edges = [(max(ids), i) for i in ids if i != max(ids)]
    else:
        edges = [(rng.choice(ids), rng.choice(ids)) for _ in range(45)]
    edges += edges[:3] + [(ids[0], ids[0])]
    place = {i: k for k, i in enumerate(ids)}
    root = components(60, [(place[a], place[b]) for a, b in edges])
    least = {}
    for i in ids:
        least[root[place[i]]] = min(least.get(root[place[i]], i), i)
    touched = {i for e in edges if e[0] != e[1] for i in e}
    got = {r.id: r.component for r in C.connected_components(C.Tables(spark), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: least[root[place[i]]] for i in touched}


def test_no_edges(spark):
    assert C.connected_components(C.Tables(spark), spark.createDataFrame([], "a long, b long")).count() == 0


def test_bloom_filter_loses_nothing(spark):
    rng = np.random.default_rng(0)
    values = rng.integers(-2**63, 2**63 - 1, 3000)
    bloom = C.bloom_filter(spark.createDataFrame([(int(v),) for v in values[:2000]], "h long"), "h")
    assert C.bloom_holds(bloom, values[:2000]).all()
    assert C.bloom_holds(bloom, values[2000:]).mean() < 0.01


def test_slices_are_bounded_and_whole():
    texts = ["x" * n for n in (0, 5, 90, 3, 200, 1, 1, 1)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array([*texts, None])})
    got = list(C.slices([batch, batch.slice(0, 0)], rows=3, size=100))
    assert [t for b in got for t in b.column("text").to_pylist()] == [*texts, None]
    assert all(b.num_rows <= 3 for b in got)
    assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column("text").to_pylist()) <= 100 for b in got)


def test_find_roots():
    a, b = np.array([3, 4, 1]), np.array([4, 5, 0])
    assert C.find_roots(6, a, b).tolist() == [0, 0, 2, 3, 3, 3]
