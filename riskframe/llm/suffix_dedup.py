"""Removal of byte strings that repeat anywhere, by sharded suffix arrays.

Every start of a ``MATCH``-byte string is owned by one anchor: the 32-byte gram of least
hash inside the string. Equal strings have equal anchors, so all starts of an anchor in
a text, with the bytes they need (a segment), go to the shard of that anchor's hash, and
every two equal strings meet in one shard. Anchors that occur once in the whole table
cannot hold a repeat and go nowhere. Equal segments are counted first and sent once,
with their number, so a passage in a third of all texts is one segment.

A shard joins its segments to one string, builds its suffix array by induced sorting
and the permuted common prefixes (:mod:`riskframe.llm.suffix_array`), and marks the
starts whose first ``MATCH`` bytes occur at least twice. An anchor with more than
``CROWD`` different segments is dealt to shards string by string instead.

Defined cases: a null text is empty; texts below ``MATCH`` bytes lose nothing; rows
without an id are ignored; repeated rows are texts that repeat each other; an empty
table gives an empty result; texts of any length are read whole (anchors are found a
piece at a time); other columns are not read, or kept as they are by
:func:`drop_repeats`, where characters cut apart by a removed run are dropped whole.
Texts and segments are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Tables, bloom_filter, bloom_holds, list_column, slices, splitmix, texts_of
from riskframe.llm.suffix_array import permuted_lcp, suffix_array

MATCH, GRAM = 200, 32
CROWD = 16_384
SHARD_BYTES = 2_000_000
PIECE = 1_000_000
#: An anchor's place: first start and number of starts, in one number.
COUNT_BITS = 9


def gram_hashes(flat: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each position."""
    w = flat.astype(np.uint64)
    for k in (1, 2, 4):
        w = w[:-k] | w[k:] << np.uint64(8 * k)
    w = splitmix(w)
    pair = w[:-8] * np.uint64(0x9E3779B97F4A7C15) + w[8:]
    pair ^= pair >> np.uint64(31)
    return splitmix(pair[:-16] * np.uint64(0xD6E8FEB86659FD93) + pair[16:])


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, first start, number of starts) of each anchor of a text, in order."""
    parts = []
    span = MATCH - GRAM + 1
    for base in range(0, len(text) - MATCH + 1, PIECE):
        flat = np.frombuffer(text, dtype=np.uint8)[base:base + PIECE + MATCH - 1]
        h = gram_hashes(flat)
        low = np.uint64((1 << 24) - 1)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        key = np.minimum(key[:len(key) - (span - width)], key[span - width:])
        at = (key & low).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        parts.append((h[at[start]], base + start, np.diff(np.append(start, len(at)))))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*parts))


def anchor_table(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_id, n_bytes, text_sha256, gram, segment, place, times)``; the arrays
    hold an entry per anchor: its gram's hash, its segment's hash, its place in the text,
    and how often the segment occurs in the slice of texts that a task had at hand, told
    at its first occurrence there (0 at the others)."""
    def run(batches):
        for batch in slices(batches):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            grams, segments, places = [], [], []
            for t in texts:
                g, start, n = anchors(t)
                grams.append(g)
                segments.extend([xxhash.xxh3_64_intdigest(t[a:b]) for a, b in zip(start.tolist(), (start + n + MATCH - 1).tolist())])
                places.append(start << COUNT_BITS | n)
            count = np.array([len(g) for g in grams])
            seg = np.array(segments, dtype=np.uint64).view(np.int64)
            _, first, often = np.unique(seg, return_index=True, return_counts=True)
            times = np.zeros(len(seg), dtype=np.int32)
            times[first] = often
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_id"), pa.array([len(t) for t in texts], type=pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts]), list_column(np.concatenate(grams).view(np.int64), count),
                 list_column(seg, count), list_column(np.concatenate(places), count), list_column(times, count)],
                names=["doc_id", "text_id", "n_bytes", "text_sha256", "gram", "segment", "place", "times"])
    return texts_of(docs).select("doc_id", F.xxhash64("text").alias("text_id"), "text").mapInArrow(
        run, "doc_id long, text_id long, n_bytes long, text_sha256 string, gram array<long>, segment array<long>, "
             "place array<long>, times array<int>")


def anchors_passing(table: DataFrame, column: str, bloom: np.ndarray, first_only: bool) -> DataFrame:
    """A row ``(gram, segment, place, times, text_id)`` per anchor whose ``column`` passes the
    filter, of each slice's segments only the first occurrence if asked."""
    shared = table.sparkSession.sparkContext.broadcast(bloom)
    names = ["gram", "segment", "place", "times"]

    def run(batches):
        for batch in batches:
            flat = {c: batch.column(c).flatten().to_numpy() for c in names}
            keep = bloom_holds(shared.value, flat[column])
            if first_only:
                keep &= flat["times"] > 0
            size = np.diff(batch.column("gram").offsets.to_numpy())
            ids = np.repeat(batch.column("text_id").to_numpy(), size)
            yield pa.RecordBatch.from_arrays([*(pa.array(flat[c][keep]) for c in names), pa.array(ids[keep])], names=[*names, "text_id"])
    return table.select(*names, "text_id").mapInArrow(run, "gram long, segment long, place long, times int, text_id long")


def wanted_segments(tables: Tables, table: DataFrame) -> DataFrame:
    """``(gram, segment, text_id, place, many)``: one occurrence of each segment whose gram
    occurs again; ``many`` if the segment itself does. Counts have map-side combine, and a
    hot gram is only a skewed side of a join."""
    entry = F.explode(F.arrays_zip("gram", "times")).alias("a")
    counted = table.select(entry).groupBy(F.col("a.gram").alias("gram")).agg(F.sum("a.times").alias("n"))
    again = tables.write(counted.where("n > 1").select("gram"))
    each = anchors_passing(table, "gram", bloom_filter(again, "gram"), True).join(again, "gram", "left_semi")
    one = each.groupBy("segment").agg(F.first("gram").alias("gram"), F.sum("times").alias("n"), F.min(F.struct("text_id", "place")).alias("at"))
    return one.select("gram", "segment", "at.text_id", "at.place", (F.col("n") > 1).alias("many"))


def texts_by_id(docs: DataFrame, bloom: np.ndarray) -> DataFrame:
    """``(text_id, text)`` of texts that the filter lets pass, once per slice of a task."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        for batch in slices(batches, size=8_000_000, rows=8000):
            ids, once = np.unique(batch.column("text_id").to_numpy(), return_index=True)
            keep = once[bloom_holds(shared.value, ids)]
            yield batch.take(pa.array(np.sort(keep)))
    return texts_of(docs).select(F.xxhash64("text").alias("text_id"), "text").mapInArrow(run, "text_id long, text string")


def segments_of(texts: DataFrame, wanted: DataFrame, shards: int) -> DataFrame:
    """``(shard, segment, skip, many, bytes)``: each wanted segment once, or each of its
    strings where its anchor is crowded (``skip`` is then the string's place in it)."""
    asked = wanted.groupBy("text_id").agg(F.collect_list(F.struct("gram", "segment", "place", "many", "crowded")).alias("asked"))
    one = texts.join(asked, "text_id").select("text_id", "text", "asked").groupBy("text_id").agg(F.first("text").alias("text"), F.first("asked").alias("asked"))

    def run(batches):
        for batch in slices(batches, size=2_000_000):
            rows = []
            for text, asked in zip(batch.column("text").to_pylist(), batch.column("asked").to_pylist()):
                t = text.encode()
                for a in asked:
                    start, n = a["place"] >> COUNT_BITS, a["place"] & (1 << COUNT_BITS) - 1
                    piece = t[start:start + n + MATCH - 1]
                    if a["crowded"]:
                        for k in range(n):
                            s = piece[k:k + MATCH]
                            rows.append((xxhash.xxh3_64_intdigest(s) % shards, a["segment"], k, a["many"], s))
                    else:
                        rows.append(((a["gram"] >> 7) % shards, a["segment"], 0, a["many"], piece))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()))],
                                                 names=["shard", "segment", "skip", "many", "bytes"])
    return one.select("text", "asked").mapInArrow(run, "shard int, segment long, skip int, many boolean, bytes binary")


def repeats_in(pieces: list[bytes], weight: np.ndarray) -> np.ndarray:
    """Which bytes of the joined pieces (each followed by one separator) begin a string of
    MATCH bytes within their piece that occurs twice, counting a piece ``weight`` times."""
    flat = np.frombuffer(b"\xff".join([*pieces, b""]), dtype=np.uint8)  # UTF-8 has no 0xff
    size = np.array([len(p) + 1 for p in pieces])
    begin = np.cumsum(size) - size
    order = suffix_array(np.append(flat.astype(np.int16) + np.int16(1), np.int16(0)))[1:]
    lcp = permuted_lcp(flat, order, MATCH + (1 << COUNT_BITS), begin)[order]
    left = np.repeat(begin + size - 1, size) - np.arange(len(flat))  # bytes to the end of the piece
    whole = left >= MATCH
    group = np.cumsum(lcp < MATCH)
    counted = np.where(whole, np.repeat(weight, size), 0)[order]
    times = np.bincount(group, weights=counted)
    out = np.zeros(len(flat), dtype=bool)
    out[order] = times[group] >= 2
    return out & whole


def match_shard(table: pa.Table) -> pa.Table:
    """A shard's segments to runs ``(segment, start, stop)`` of repeated starts."""
    pieces = table.column("bytes").to_pylist()
    hit = repeats_in(pieces, np.where(table.column("many").to_numpy(), 2, 1))
    size = np.array([len(p) + 1 for p in pieces])
    begin = np.cumsum(size) - size
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.searchsorted(begin, start, side="right") - 1
    skip = table.column("skip").to_numpy()[piece].astype(np.int64)
    return pa.table({"segment": pa.array(table.column("segment").to_numpy()[piece]), "start": start - begin[piece] + skip, "stop": stop - begin[piece] + skip})


def repeats(docs: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """(anchor table, ``(text_id, runs array<struct<start, stop>>)``): the byte ranges of
    each text that repeated strings cover."""
    table = tables.write(anchor_table(docs))
    wanted = tables.write(wanted_segments(tables, table))
    crowded = tables.write(wanted.groupBy("gram").agg(F.count("*").alias("n")).where(f"n > {CROWD}").select("gram", F.lit(True).alias("crowded")))
    wanted = wanted.join(crowded, "gram", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    need = wanted.agg(F.sum(F.when(F.col("crowded"), F.col("place").bitwiseAND((1 << COUNT_BITS) - 1) * (MATCH + 1)).otherwise(
        F.col("place").bitwiseAND((1 << COUNT_BITS) - 1) + MATCH))).first()[0] or 0
    shards = max(1, math.ceil(need / SHARD_BYTES))
    texts = texts_by_id(docs, bloom_filter(wanted.select("text_id").distinct(), "text_id"))
    hits = segments_of(texts, wanted, shards).groupBy("shard").applyInArrow(match_shard, "segment long, start long, stop long")
    hits = tables.write(hits)
    places = anchors_passing(table, "segment", bloom_filter(hits.select("segment").distinct(), "segment"), False)
    runs = places.select("segment", "text_id", F.shiftright("place", COUNT_BITS).alias("at")).join(hits, "segment").select(
        "text_id", F.struct((F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("stop") + MATCH - 1).alias("stop")).alias("run"))
    runs = runs.groupBy("text_id").agg(F.array_sort(F.collect_set("run")).alias("runs"))
    return table, tables.write(runs)


def merge(runs) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for r in runs:
        a, b = r["start"], r["stop"]
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in spans for x in s), len(text)]
    return b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])])


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row. What is removed
    is worked out once per distinct text."""
    tables = Tables(docs.sparkSession)
    table, runs = repeats(docs, tables)
    texts = texts_by_id(docs, bloom_filter(runs, "text_id"))
    one = texts.join(runs, "text_id").groupBy("text_id").agg(F.first("text").alias("text"), F.first("runs").alias("runs"))

    def run(batches):
        for batch in slices(batches):
            rows = []
            for i, text, r in zip(*(batch.column(c).to_pylist() for c in ("text_id", "text", "runs"))):
                spans = merge(r)
                rows.append((i, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept(text.encode(), spans)).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                                 names=["text_id", "n_removed", "n_spans", "kept"])
    cut = tables.write(one.mapInArrow(run, "text_id long, n_removed long, n_spans long, kept string"))
    return table.select("doc_id", "text_id", "n_bytes", "text_sha256").join(cut, "text_id", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept", "text_sha256").alias("kept_sha256"))


def without_runs(text: pd.Series, runs: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or r is None else kept(t.encode(), merge(r)).decode(errors="ignore") for t, r in zip(text, runs)], dtype=object)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs``, every column kept, with repeated strings cut from ``text`` and ``n_chars`` to
    match."""
    _, runs = repeats(docs, Tables(docs.sparkSession))
    runs = runs.select(F.col("text_id").alias("__runs_of"), F.col("runs").alias("__runs"))
    out = docs.join(runs, F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__runs_of"), "left")
    out = out.withColumn("text", F.pandas_udf(without_runs, "string")("text", "__runs")).drop("__runs", "__runs_of")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
