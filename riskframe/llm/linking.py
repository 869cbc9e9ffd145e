"""Exact verification of candidate components.

Candidate generation of a similarity join leaves groups of nodes that may be linked.
Here every pair of such a group that could join two components is compared, but no
pair is ever a row: tasks keep a union-find and emit spanning edges only.

A group above ``CHUNK`` nodes is dealt to chunks. (1) Each chunk is linked inside.
(2) One node of each resulting part stands for it, and these are linked with each
other. (3) What is still outside its group's largest part is compared, in blocks, with
every chunk. So a group of mutual near copies costs a pass over its nodes, a link
between any two nodes is found, and no task holds more than two chunks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Tables, connected_components

CHUNK = 4096
EDGES = "a long, b long"
#: link(groups of payloads, roots, fixed) -> local edges of each group. Only pairs of different roots matter; where
#: ``fixed`` is given, only pairs of a fixed and another node.
Linker = Callable[[Iterable[tuple[list, np.ndarray, np.ndarray | None]]], list[list[tuple[int, int]]]]


def one_by_one(link: Callable[[list, np.ndarray, np.ndarray | None], list[tuple[int, int]]]) -> Linker:
    """A linker of groups that are looked at one after another."""
    return lambda groups: [link(*g) for g in groups]


class Union:
    """Roots of a small set of nodes; :meth:`join` relabels the smaller number of them."""

    def __init__(self, roots: np.ndarray):
        self.root = roots.copy()

    def join(self, a: int, b: int) -> None:
        x, y = self.root[a], self.root[b]
        self.root[self.root == max(x, y)] = min(x, y)


def _run(work: DataFrame, shards: int, link: Linker) -> DataFrame:
    """``work(grp, node, label, fixed, payload)`` to spanning edges of each ``grp``."""
    def apply(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = []

        def groups():
            for _, g in pdf.groupby("grp", sort=False):
                if len(g) < 2:
                    continue
                g = g.sort_values("node")
                _, roots = np.unique(g["label"].to_numpy(), return_inverse=True)
                fixed = g["fixed"].to_numpy()
                nodes.append(g["node"].to_numpy())
                yield g["payload"].tolist(), roots, fixed if fixed.any() else None

        found = link(groups())
        a = [node[i] for node, edges in zip(nodes, found) for i, _ in edges]
        b = [node[j] for node, edges in zip(nodes, found) for _, j in edges]
        return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

    # little data, much work: a partition per shard, whatever its bytes
    work = work.withColumn("shard", F.pmod(F.xxhash64("grp"), F.lit(shards))).repartition(shards, "shard")
    return work.groupBy("shard").applyInPandas(apply, EDGES)


def link_components(tables: Tables, nodes: DataFrame, link: Linker, shard_nodes: int = 1000, chunk: int | None = None) -> DataFrame:
    """``nodes(comp, node, payload)``, one row per node, to ``(id, component)`` for every linked node."""
    chunk = chunk or CHUNK
    nodes = tables.write(nodes)
    size = nodes.groupBy("comp").agg(F.count("*").alias("n")).where("n > 1")
    total, most = size.agg(F.sum("n"), F.max("n")).first()
    if not total:
        return tables.spark.createDataFrame([], "id long, component long")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    dealt = nodes.join(size, "comp").withColumn("chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    shards = max(1, math.ceil(total / shard_nodes))
    edges = tables.write(_run(dealt.select(F.xxhash64("comp", "chunk").alias("grp"), "node", F.col("node").alias("label"), F.lit(False).alias("fixed"), "payload"), shards, link))
    if most > chunk:
        for turn in range(2):  # the parts' first nodes, then again what the first turn has merged
            label = connected_components(tables, edges).withColumnRenamed("id", "node")
            hot = dealt.where("chunks > 1").join(label, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
            heads = hot.where("node = label").withColumn("grp", F.xxhash64("comp", F.pmod(F.xxhash64(F.col("label") + F.lit(turn)), F.ceil(F.col("n") / chunk).cast("int"))))
            more = _run(heads.select("grp", "node", F.col("node").alias("label"), F.lit(False).alias("fixed"), "payload"), shards, link)
            edges = tables.write(edges.unionAll(more))
        label = connected_components(tables, edges).withColumnRenamed("id", "node")
        hot = tables.write(dealt.where("chunks > 1").join(label, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component"))
        parts = hot.groupBy("comp", "label").agg(F.count("*").alias("size"))
        largest = parts.groupBy("comp").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
        hot = hot.join(largest, "comp")
        rest = hot.where("label <> main")
        blocks = rest.groupBy("comp").agg(F.ceil(F.count("*") / chunk).cast("int").alias("blocks"))
        every = hot.join(blocks, "comp").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        outside = rest.join(blocks, "comp").withColumn("block", F.pmod(F.hash("node"), F.col("blocks"))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        pick = lambda df, fixed: df.select(F.xxhash64("comp", "chunk", "block").alias("grp"), "node", "label", F.lit(fixed).alias("fixed"), "payload")
        more = _run(pick(every, False).unionAll(pick(outside, True)), shards, link)
        edges = tables.write(edges.unionAll(more))
    return connected_components(tables, edges)
