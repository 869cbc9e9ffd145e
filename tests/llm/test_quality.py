import random

import numpy as np
import pytest

from riskframe.llm import quality as Q


def corpus(n=360, seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    rows, labels = [], []
    for i in range(n):
        good = int(rng.random() < 0.7)
        words = [word() for _ in range(rng.randrange(20, 300))]
        if not good:  # one bad passage among good ones
            at = rng.randrange(len(words))
            words[at:at] = [w + rng.choice(["$$$", "%%%", "###"]) for w in words[:60]] if i % 2 else ["spam"] * 60
        rows.append((i, " ".join(words)))
        labels.append((i, good, 0))
    return rows, labels


def test_held_out_accuracy_and_cases(spark, make_docs):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, "word " * 30000), (1003, "\n \t")]
    docs = make_docs(rows + extra + [rows[1]]).selectExpr("*", "1 AS score", "2 AS y", "3 AS x")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    truth = {i: q for i, q, _ in labels}
    got = Q.quality(docs, table).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    by_id = {r.doc_id: r for r in got}
    assert by_id[1000].score == by_id[1001].score == by_id[1003].score
    assert by_id[1002].predicted == 0
    assert Q.quality(docs.where("false"), table).count() == 0
    assert {r.score for r in Q.quality(docs, table.where("quality = 1")).collect()} == {1.0}
    assert {r.score for r in Q.quality(docs, table.where("false")).collect()} == {0.0}


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(0)
    counts = np.array([1, 3, 2, 5])
    x, y, weight = rng.normal(size=(counts.sum(), 7)), np.array([0.0, 1, 1, 0]), np.array([1.0, 2, 1, 3])
    net = Q.train(x, counts, y, weight, epochs=3)

    def loss():
        p = net.forward(x, counts)[-1]
        penalty = sum((w * w).sum() for k, w in net.w.items() if k not in ("out0", "enc0")) * 1e-3 / 2
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum() + penalty

    g = net.gradient(x, counts, y, weight)
    for k, w in net.w.items():
        for at in [tuple(rng.integers(0, d) for d in w.shape) for _ in range(4)]:
            old, e = w[at], 1e-6
            w[at] = old + e
            up = loss()
            w[at] = old - e
            down = loss()
            w[at] = old
            assert abs(g[k][at] - (up - down) / (2 * e)) < 1e-5


def test_attention_is_a_distribution_over_passages():
    texts = [b"", b"one two", b" ".join(b"w%d" % i for i in range(200)), "é ".encode() * 130]
    x, counts = Q.passages(texts)
    assert counts.tolist() == [1, 1, 4, 3] and len(x) == counts.sum() and np.isfinite(x).all()
    net = Q.train(x, counts, np.array([0.0, 1, 1, 0]), np.ones(4), epochs=2)
    a = net.forward(x, counts)[4]
    assert np.allclose(np.add.reduceat(a, np.cumsum(counts) - counts), 1)


@pytest.mark.parametrize("split", [1, 3])
def test_features_do_not_depend_on_the_batch(split):
    texts = [t.encode() for _, t in corpus(12)[0]] + [b"", b"A,b! 9 $$"]
    x, counts = Q.passages(texts)
    parts = [Q.passages(texts[i:i + split]) for i in range(0, len(texts), split)]
    assert np.allclose(np.concatenate([p[0] for p in parts]), x)
    assert np.concatenate([p[1] for p in parts]).tolist() == counts.tolist()
