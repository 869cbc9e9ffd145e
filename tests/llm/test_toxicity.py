import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import toxicity as X


def corpus(n=400, seed=0):
    rng = random.Random(seed)
    mild = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(3, 8))) for _ in range(300)]
    rude = ["grumpf", "blorkig", "zutzen"]
    rows, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = [rng.choice(mild) for _ in range(rng.randrange(5, 60))]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(rude) + rng.choice(["", "s", "er", "!"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


@pytest.fixture()
def tables(spark, make_docs):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, "grumpfen! " * 4000), (1003, "never seen words")]
    return make_docs(rows + extra + [rows[0]]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((i, t) for i, _, t in labels)


def test_held_out_accuracy(tables):
    docs, labels, truth = tables
    got = X.toxicity(docs.selectExpr("*", "1 AS score", "2 AS y", "3 AS term"), labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert all(0 < e.similarity <= 1 for e in r.evidence) and len(r.evidence) <= 3
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    by_id = {r.doc_id: r for r in got}
    assert by_id[1000].score == by_id[1001].score == by_id[1003].score and by_id[1000].predicted == 0
    assert by_id[1002].predicted == 1
    assert by_id[1002].evidence and {e.label for e in by_id[1002].evidence} == {1}


def test_other_columns_and_held_out_labels_do_not_matter(tables):
    docs, labels, _ = tables
    turned = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    a = {r.doc_id: r.score for r in X.toxicity(docs, labels).collect()}
    b = {r.doc_id: r.score for r in X.toxicity(other, turned).collect()}
    assert a == b


def test_without_both_classes_or_rows(spark, tables):
    docs, labels, _ = tables
    none = X.toxicity(docs, labels.where("false"))
    assert {r.score for r in none.collect()} == {0.0}
    one = X.toxicity(docs, labels.withColumn("toxic", F.lit(1)))
    assert {r.score for r in one.collect()} == {1.0}
    assert X.toxicity(docs.where("false"), labels).count() == 0
    odd = labels.unionAll(spark.createDataFrame([(None, 1, 1), (2, 1, None)], labels.schema))
    assert X.toxicity(docs, odd).count() == docs.count()


@pytest.mark.parametrize("seed", range(5))
def test_block_max_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(500):
        t = np.sort(rng.choice(60, rng.integers(1, 12), replace=False))
        w = rng.random(len(t)) + 0.01
        rows.append((t, w / np.sqrt((w * w).sum())))
    rows += rows[:40]  # ties
    index = X.BlockMaxIndex(rows, 60, block=16)
    dense = np.zeros((len(rows), 60))
    for i, (t, w) in enumerate(rows):
        dense[i, t] = w
    for i in range(0, 500, 7):
        t, w = rows[i]
        score = dense[:, t] @ w
        score[i] = 0
        want = np.lexsort((np.arange(len(rows)), -np.round(score, 12)))[:15]
        got, sims = index.nearest(t, w, 15, skip=i)
        assert np.allclose(sims, score[want]) and np.allclose(score[got], score[want])
    assert len(index.nearest(np.zeros(0, int), np.zeros(0), 5)[0]) == 0


def test_reader_finds_what_the_definition_finds():
    rng = random.Random(1)
    words = ["".join(rng.choice("abé_1") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    texts = ["", "é", *("".join(rng.choice([*words, " ", ", ", "\n", "İ", "-"]) for _ in range(40)) for _ in range(60))]
    terms = sorted({t for x in texts for t in X.terms_of(x)})
    vocabulary = {t: i for i, t in enumerate(rng.sample(terms, len(terms) // 2))}
    reader = X.TermReader(vocabulary)
    for x in texts:
        ids, tf = reader.counts(x)
        assert dict(zip(ids.tolist(), tf.tolist())) == {vocabulary[t]: n for t, n in X.terms_of(x).items() if t in vocabulary}
    assert len(X.TermReader({}).counts("abc")[0]) == 0
