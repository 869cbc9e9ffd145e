"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine.

Terms are words and their first letters (prefixes), so that inflected forms meet. A
bounded sample of labelled training rows (``PER_CLASS`` each, in hash order) gives the
examples and, by its class counts, the terms that tell the classes apart; document
frequencies of those terms are counted over the whole corpus. The examples lie in an
inverted index whose postings are cut into blocks of examples with a maximum weight
per term and block. A query takes blocks by falling upper bound until none can hold a
nearer example, so the neighbours are exact. Their votes, weighted by similarity, are
calibrated on the examples themselves, each left out of its own vote.

Defined cases: null texts are empty; a text without any known term has no neighbours
and gets the calibrated score of such texts; rows without an id are ignored; repeated
rows are scored each; several labels for an id count as the highest; null labels are
ignored; ties in similarity go to the earlier example; without labels of both classes
every score is the share of toxic labels (0 without any); other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import read_table, slices, texts_of

#: Bounds of the fitted sample and of its terms.
PER_CLASS, TERMS = 2000, 1000
#: Least phi coefficient of a term and the classes, and least multiple of its standard error.
LEAST_PHI, ERRORS = 0.15, 4.0
NEIGHBOURS, BLOCK = 15, 64
PREFIXES = (4, 5, 6, 7)
WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def _inside(c: str) -> bool:
    return c.isalnum() or c == "_"


def terms_of(text: str) -> Counter:
    """Every term of a text and how often it occurs: its words, and the first letters of
    each longer word, marked with a star."""
    out: Counter = Counter()
    for w in WORD.findall(text.lower()):
        out[w] += 1
        for k in PREFIXES:
            if len(w) > k:
                out[w[:k] + "*"] += 1
    return out


class TermReader:
    """Finds a fixed vocabulary in texts with one automaton, as :func:`terms_of` would."""

    def __init__(self, vocabulary: dict[str, int]):
        keys: dict[str, list[int]] = {}
        for t, i in vocabulary.items():
            keys.setdefault(t.rstrip("*"), [-1, -1])[t.endswith("*")] = i
        self.found = ahocorasick.Automaton()
        for k, (whole, start) in keys.items():
            self.found.add_word(k, (whole, start, len(k)))
        self.found.make_automaton()
        self.any = bool(keys)

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        c: dict[int, int] = {}
        if self.any and text:
            low = text.lower() + " "
            for end, (whole, start, n) in self.found.iter(low):
                if end < n or not _inside(low[end - n]):
                    i = start if _inside(low[end + 1]) else whole
                    if i >= 0:
                        c[i] = c.get(i, 0) + 1
        return np.fromiter(c.keys(), np.int64, len(c)), np.fromiter(c.values(), np.float64, len(c))


class BlockMaxIndex:
    """Postings (example, weight) sorted by term and example, cut at blocks of examples."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.n, self.block = len(rows), block
        self.blocks = max(1, -(-self.n // block))
        doc = np.repeat(np.arange(self.n), [len(t) for t, _ in rows])
        term = np.concatenate([t for t, _ in rows]) if rows else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in rows]) if rows else np.zeros(0)
        order = np.lexsort((doc, term))
        self.doc, self.weight = doc[order].astype(np.int32), weight[order]
        cell = term[order] * self.blocks + self.doc // block
        self.at = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1)).reshape(-1)
        self.most = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(n_terms, self.blocks)

    def _scores(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        cell = (terms[:, None] * self.blocks + blocks[None, :]).ravel()
        start = self.at[cell]
        size = self.at[cell + 1] - start
        full = np.flatnonzero(size)
        start, size = start[full], size[full]
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.bincount(self.doc[at], weights=self.weight[at] * np.repeat(weights[full // len(blocks)], size), minlength=self.n)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest positive score, exact, and their scores."""
        if not len(terms) or not self.n:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        score = np.zeros(self.n)
        at, step = 0, 4
        while at < len(order):
            take = order[at:at + step]
            score += self._scores(terms, weights, take)
            at += len(take)
            if skip >= 0:
                score[skip] = 0
            if at < len(order):
                worst = np.partition(score, self.n - k)[self.n - k] if self.n > k else 0.0
                rest = order[at:]
                order = np.concatenate([order[:at], rest[bound[rest] >= worst * (1 - 1e-12)]])
                step *= 4
        best = np.flatnonzero(score > 0)
        best = best[np.lexsort((best, -score[best]))][:k]
        return best, score[best]


@dataclass
class Model:
    vocabulary: dict[str, int]
    idf: np.ndarray
    index: BlockMaxIndex
    ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray  # logistic calibration of (1, logit of the smoothed vote, no neighbours)
    prior: float

    def vector(self, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
        w = (1 + np.log(tf)) * self.idf[terms]
        return w / np.sqrt((w * w).sum()) if len(w) else w

    def features(self, near: np.ndarray, sims: np.ndarray) -> np.ndarray:
        total = (sims * sims).sum()
        vote = ((sims * sims * self.labels[near]).sum() + 0.1 * self.prior) / (total + 0.1)
        vote = min(max(vote, 1e-6), 1 - 1e-6)
        return np.array([1.0, math.log(vote / (1 - vote)), float(len(near) == 0)])

    def score(self, terms: np.ndarray, tf: np.ndarray, skip: int = -1):
        near, sims = self.index.nearest(terms, self.vector(terms, tf), NEIGHBOURS, skip)
        return self.features(near, sims), near, sims


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> Model | float:
    """Fit on the training rows of ``labels``; a plain share where a class is missing."""
    spark = docs.sparkSession
    known = labels.where(f"doc_id IS NOT NULL AND {column} IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.max(column) > 0).cast("int").alias("y")).where(~held_out(F.col("doc_id")))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return 1.0 * sizes.get(1, 0) / max(1, sum(sizes.values()))
    picked = [r for y in (0, 1) for r in known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS).collect()]
    sample = spark.createDataFrame([(r["doc_id"], r["y"]) for r in picked], "doc_id long, y int")

    def words(batches):
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            got = [sorted(terms_of(t).items()) for t in texts]
            size = np.array([len(g) for g in got], dtype=np.int64)
            rep = pa.array(np.repeat(np.arange(len(got)), size))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rep), batch.column("y").take(rep), pa.array([t for g in got for t, _ in g], type=pa.string()),
                 pa.array([n for g in got for _, n in g], type=pa.int64())], names=["doc_id", "y", "term", "tf"])

    # the sample is bounded by PER_CLASS, so it may be broadcast
    rows = texts_of(docs).join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "y", "text")
    rows = rows.mapInArrow(words, "doc_id long, y int, term string, tf long").persist()
    n0, n1 = sum(r["y"] == 0 for r in picked), sum(r["y"] == 1 for r in picked)
    has1, has0 = F.sum("y"), F.sum(1 - F.col("y"))
    gap = has1 / F.lit(n1) - has0 / F.lit(n0)
    spread = (has1 + has0) / F.lit(n0 + n1)
    power = F.abs(gap) / F.sqrt(spread * (1 - spread) + F.lit(1e-9))
    chosen = rows.groupBy("term").agg((has1 + has0).alias("df"), power.alias("power")).where(
        f"df >= 3 AND power > {max(LEAST_PHI, ERRORS / math.sqrt(n0 + n1))}")
    terms = [r["term"] for r in chosen.orderBy(F.desc("power"), "term").limit(TERMS).collect()]
    vocabulary = {t: i for i, t in enumerate(terms)}
    table = spark.createDataFrame(list(vocabulary.items()) or [("", -1)], "term string, id long")
    found = rows.join(F.broadcast(table), "term").select("doc_id", "id", "tf").collect()
    rows.unpersist()

    def frequencies(batches):
        reader, df, n = TermReader(vocabulary), np.zeros(len(vocabulary), np.int64), 0
        for batch in slices(batches):
            for t in batch.column("text").to_pylist():
                df[reader.counts(t)[0]] += 1
                n += 1
        ids = np.arange(-1, len(df))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate([[n], df]))], names=["id", "df"])

    counted = texts_of(docs).mapInArrow(frequencies, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).collect()
    df = {r["id"]: r["df"] for r in counted}
    idf = np.array([math.log((1 + df.get(-1, 0)) / (1 + df.get(i, 0))) + 1 for i in range(len(vocabulary))])
    by_doc: dict[int, list] = {r["doc_id"]: [] for r in picked}
    for r in found:
        by_doc[r["doc_id"]].append((r["id"], r["tf"]))
    ids = np.array(sorted(by_doc), dtype=np.int64)
    y = {r["doc_id"]: r["y"] for r in picked}
    model = Model(vocabulary, idf, None, ids, np.array([y[i] for i in ids.tolist()], dtype=np.float64), None,
                  sizes[1] / (sizes[0] + sizes[1]))
    parts = [(np.array([t for t, _ in sorted(by_doc[i])], dtype=np.int64), np.array([n for _, n in sorted(by_doc[i])], dtype=np.float64)) for i in ids.tolist()]
    model.index = BlockMaxIndex([(t, model.vector(t, n)) for t, n in parts], len(vocabulary))
    x = np.stack([model.score(t, n, skip=i)[0] for i, (t, n) in enumerate(parts)])
    share = np.where(model.labels == 1, sizes[1] / n1, sizes[0] / n0)
    model.weights = fit_logistic(x, model.labels, share * len(ids) / share.sum())
    return model


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """``(doc_id, held_out, score, evidence)``; evidence lists the nearest examples with
    their similarity and label."""
    spark = docs.sparkSession
    rows = texts_of(docs)
    if isinstance(model, float):
        return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(model).alias("score"),
                           F.expr("cast(array() as array<struct<doc_id: long, similarity: double, label: int>>)").alias("evidence"))
    shared = spark.sparkContext.broadcast(model)  # bounded by PER_CLASS and TERMS
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())]))

    def run(batches):
        m = shared.value
        reader = TermReader(m.vocabulary)
        for batch in slices(batches):
            scores, evidence = [], []
            for t in batch.column("text").to_pylist():
                x, near, sims = m.score(*reader.counts(t))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, float(x @ m.weights))))))
                evidence.append([{"doc_id": int(m.ids[i]), "similarity": min(1.0, float(s)), "label": int(m.labels[i])} for i, s in zip(near[:3], sims)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, type=pa.float64()), pa.array(evidence, type=kind)],
                                             names=["doc_id", "score", "evidence"])

    out = rows.mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id: long, similarity: double, label: int>>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "evidence")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted, evidence)`` for every text."""
    out = score(docs, fit(docs, labels))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity_of(docs: DataFrame, sf_dir: str, threshold: float = 0.7) -> DataFrame:
    return toxicity(docs, read_table(docs.sparkSession, sf_dir, "labels"), threshold)
