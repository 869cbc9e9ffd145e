"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded by a small
network over its form: word lengths, repetition, letter case, digits, punctuation and
other symbols, lines. Gated attention weights the passages, and the weighted sum is
scored. Encoder, attention and score are learned together from document labels alone,
on a bounded sample of training rows (``PER_CLASS`` each, in hash order); every
passage of every document is then scored where it lies.

Defined cases: a null text is empty and is one passage without words, scored as any
other; rows without an id are ignored; repeated rows are scored each; several labels
for an id count as the lowest; null labels are ignored; without labels of both classes
every score is the share of good ones (0 without any); a very long text has more
passages and no other treatment; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import read_table, slices, splitmix, texts_of
from riskframe.llm.toxicity import held_out

#: Bound of the fitted sample.
PER_CLASS = 1500
PASSAGE = 64
HIDDEN, GATE, EPOCHS = 16, 8, 300

_KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:", b"!?", b"'\"()-", b"#$%&*@|_=+~^<>/\\{}[]`", bytes(range(128, 256))]


def _byte_kinds() -> np.ndarray:
    table = np.full(256, len(_KINDS), dtype=np.uint8)
    for k, chars in enumerate(_KINDS):
        table[list(chars)] = k
    return table


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, number of passages of each text)."""
    flat = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    black = flat > 32
    start = np.flatnonzero(black & ~np.concatenate([[False], black[:-1]]))
    stop = np.flatnonzero(black & ~np.concatenate([black[1:], [False]])) + 1
    owner = np.searchsorted(begins, start, side="right") - 1
    n_words = np.bincount(owner, minlength=len(texts))
    n_parts = np.maximum(1, -(-n_words // PASSAGE))
    first_part = np.cumsum(n_parts) - n_parts
    rank = np.arange(len(start)) - (np.cumsum(n_words) - n_words)[owner]
    part = first_part[owner] + rank // PASSAGE  # of each word
    parts = int(n_parts.sum())
    words = np.bincount(part, minlength=parts).astype(np.float64)
    kinds = _byte_kinds()[flat]
    size = (stop - start).astype(np.float64)
    per_word = np.maximum(words, 1)

    def mean(values):
        return np.bincount(part, weights=values, minlength=parts) / per_word

    chars = np.bincount(part, weights=size, minlength=parts)
    shares = []
    for k in range(len(_KINDS) + 1):
        cum = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int64)])
        shares.append(np.bincount(part, weights=cum[stop] - cum[start], minlength=parts) / np.maximum(chars, 1))
    # a hash of each word, for repetition
    rng = np.random.default_rng(11)
    letter, place = rng.integers(1, 2**63, 256, dtype=np.uint64), rng.integers(1, 2**63, 32, dtype=np.uint64) | np.uint64(1)
    begun = np.zeros(len(flat), dtype=np.int64)
    begun[start] = start
    nth = np.arange(len(flat)) - np.maximum.accumulate(begun)
    mixed = letter[flat] * place[nth & 31]
    cum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    word = splitmix(cum[stop] - cum[start]) if len(start) else np.zeros(0, np.uint64)

    def repeated(keys):
        if not len(keys):
            return np.zeros(parts)
        order = np.lexsort((keys, part))
        again = np.zeros(len(keys))
        again[1:] = (keys[order][1:] == keys[order][:-1]) & (part[order][1:] == part[order][:-1])
        return np.bincount(part[order], weights=again, minlength=parts) / per_word

    follows = np.zeros(len(word), dtype=bool)
    follows[1:] = part[1:] == part[:-1]
    same = np.zeros(len(word))
    same[1:] = (word[1:] == word[:-1]) & follows[1:]
    before = np.concatenate([np.zeros(1, np.uint64), word[:-1]]) if len(word) else word
    pair = word * np.uint64(0x9E3779B97F4A7C15) + np.where(follows, before, np.arange(len(word), dtype=np.uint64))
    lines = np.concatenate([[0], np.cumsum(flat == 10)])
    gap = np.zeros(len(word))
    if len(word):
        gap[:-1] = lines[start[1:]] - lines[stop[:-1]]
    last = kinds[stop - 1] if len(word) else np.zeros(0, np.uint8)
    letters = np.isin(kinds, (0, 1, 7))
    cum = np.concatenate([[0], np.cumsum(letters, dtype=np.int64)])
    bare = (cum[stop] - cum[start] == 0) if len(word) else np.zeros(0)
    mean_size = mean(size)
    spread = np.sqrt(np.maximum(0, mean(size * size) - mean_size**2))
    x = np.stack([np.log1p(words), mean_size, spread, *shares, repeated(word), repeated(pair), mean(same), mean(gap),
                  mean((last == 6).astype(float)), mean((last == 4).astype(float)), mean((last == 3).astype(float)), mean(np.asarray(bare, dtype=float)), mean((size <= 3).astype(float))], axis=1)
    return x, n_parts


@dataclass
class Network:
    center: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, counts: np.ndarray):
        w, starts = self.w, np.cumsum(counts) - counts
        x = np.clip((x - self.center) / self.scale, -6, 6)
        h = np.tanh(x @ w["enc"] + w["enc0"])
        v, u = np.tanh(h @ w["tan"]), 1 / (1 + np.exp(-(h @ w["sig"])))
        e = (v * u) @ w["att"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
        a = e / np.repeat(np.add.reduceat(e, starts), counts)  # attention within a document
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        logit = z @ w["out"] + w["out0"]
        return x, h, v, u, a, z, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def gradient(self, x, counts, y, weight, decay=1e-3):
        w, starts = self.w, np.cumsum(counts) - counts
        x, h, v, u, a, z, p = self.forward(x, counts)
        d = weight * (p - y) / weight.sum()
        g = {"out": z.T @ d, "out0": d.sum(keepdims=True)}
        dz = np.repeat(d[:, None] * w["out"][None, :], counts, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), counts))
        g["att"] = (v * u).T @ de
        dv, du = de[:, None] * w["att"] * u * (1 - v * v), de[:, None] * w["att"] * v * u * (1 - u)
        g["tan"], g["sig"] = h.T @ dv, h.T @ du
        dh = (a[:, None] * dz + dv @ w["tan"].T + du @ w["sig"].T) * (1 - h * h)
        g["enc"], g["enc0"] = x.T @ dh, dh.sum(axis=0)
        return {k: g[k] + decay * w[k] * (k not in ("out0", "enc0")) for k in w}


def train(x: np.ndarray, counts: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> Network:
    """Adam over the whole (bounded) sample."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    w = {"enc": rng.normal(0, d**-0.5, (d, HIDDEN)), "enc0": np.zeros(HIDDEN), "tan": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
         "sig": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "att": rng.normal(0, 0.3, GATE), "out": rng.normal(0, 0.3, HIDDEN), "out0": np.zeros(1)}
    net = Network(x.mean(axis=0), x.std(axis=0) + 1e-3, w)
    m, s = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}
    for t in range(1, epochs + 1):
        for k, g in net.gradient(x, counts, y, weight).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.999 * s[k] + 0.001 * g * g
            w[k] -= 0.02 * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality") -> Network | float:
    spark = docs.sparkSession
    known = labels.where(f"doc_id IS NOT NULL AND {column} IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.min(column) > 0).cast("int").alias("y")).where(~held_out(F.col("doc_id")))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return 1.0 * sizes.get(1, 0) / max(1, sum(sizes.values()))
    picked = [r for y in (0, 1) for r in known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS).collect()]
    sample = spark.createDataFrame([(r["doc_id"], r["y"]) for r in picked], "doc_id long, y int")

    def encode(batches):
        for batch in slices(batches):
            x, counts = passages([t.encode() for t in batch.column("text").to_pylist()])
            at = np.concatenate([[0], np.cumsum(counts)])
            held = pa.array([x[a:b].astype("<f4").tobytes() for a, b in zip(at[:-1], at[1:])], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), held], names=["doc_id", "y", "x"])

    # the sample is bounded by PER_CLASS, so it may be broadcast; a passage is 104 bytes on the driver
    rows = texts_of(docs).join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "y", "text")
    got = rows.mapInArrow(encode, "doc_id long, y int, x binary").orderBy("doc_id").collect()
    if len({r["y"] for r in got}) < 2:
        return 1.0 * sizes[1] / (sizes[0] + sizes[1])
    width = len(passages([b"a"])[0][0])
    bags = [np.frombuffer(bytes(r["x"]), dtype="<f4").reshape(-1, width).astype(np.float64) for r in got]
    y = np.array([r["y"] for r in got], dtype=np.float64)
    share = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum())
    return train(np.concatenate(bags), np.array([len(b) for b in bags]), y, share)


def score(docs: DataFrame, net: Network | float) -> DataFrame:
    """``(doc_id, held_out, score, top_passage, top_weight)``: the passage of most attention
    and its weight explain the score."""
    rows = texts_of(docs)
    if isinstance(net, float):
        return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(net).alias("score"),
                           F.lit(0).alias("top_passage"), F.lit(1.0).alias("top_weight"))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a fixed number of weights

    def run(batches):
        for batch in slices(batches):
            x, counts = passages([t.encode() for t in batch.column("text").to_pylist()])
            *_, a, _, p = shared.value.forward(x, counts)
            at = np.concatenate([[0], np.cumsum(counts)])
            top = [int(np.argmax(a[i:j])) for i, j in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p), pa.array(top, type=pa.int32()), pa.array(a[at[:-1] + np.array(top)])],
                names=["doc_id", "score", "top_passage", "top_weight"])

    out = rows.mapInArrow(run, "doc_id long, score double, top_passage int, top_weight double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "top_passage", "top_weight")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    out = score(docs, fit(docs, labels))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_of(docs: DataFrame, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    return quality(docs, read_table(docs.sparkSession, sf_dir, "labels"), threshold)
