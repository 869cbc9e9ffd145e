"""Exact dedup over a persistent digest index (DataFrame operations only).

The index is a table bucketed and sorted by digest. A batch is reduced to digests,
pre-aggregated to one row per digest, compared with the index by a sort-merge
anti-join, and what is new is appended. How many buckets there are follows from the
rows expected when the index is made, and is read back from the table afterwards.

Defined cases: a null text counts as empty, so null and empty texts are equal;
rows without an id are ignored; repeated rows are copies of each other (of equal
ids the group size counts each row, and every such row carries the decision of
its id); an empty batch appends nothing; texts of any length are digested whole; columns other than the id and the text
are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import Tables, texts_of

#: Digests that a bucket of a new index is meant for; least and most buckets (the most that Spark allows by default).
DIGESTS, LEAST_BUCKETS, MOST_BUCKETS = 4_000_000, 64, 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does just that to an all-ASCII text,
    and much faster than ``translate``."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digests(docs: DataFrame) -> DataFrame:
    return texts_of(docs).select("doc_id", F.sha2(fold_ascii(F.col("text")), 256).alias("digest"))


class DigestIndex:
    """A table ``(digest, keep_id, group_size)``, bucketed and sorted by digest. ``buckets``
    is for an index still to be made; without it, its expected rows decide."""

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table, self.buckets = spark, table, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def create(self, expected: int = 0) -> None:
        buckets = self.buckets or min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-expected // DIGESTS)))
        empty = self.spark.createDataFrame([], "digest string, keep_id long, group_size long")
        empty.write.bucketBy(buckets, "digest").sortBy("digest").format("parquet").saveAsTable(self.table)

    def stored_buckets(self) -> int:
        """How many buckets the table was made with, by this session or another."""
        about = self.spark.sql(f"DESCRIBE FORMATTED {self.table}")
        return int(about.where("col_name = 'Num Buckets'").first()["data_type"])

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` whose digest the index lacks (sort-merge anti-join)."""
        known = self.spark.table(self.table).select("digest").hint("merge")
        return groups.join(known, "digest", "left_anti")

    def append(self, batch: DataFrame) -> None:
        """Add the digests of ``batch(doc_id, digest)`` that are new. Within the batch the
        largest id of a digest stays; a text already in the index stays there."""
        groups = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        buckets = self.stored_buckets()
        new = self.unseen(groups).repartition(buckets, "digest").select("digest", "keep_id", "group_size")
        new.write.bucketBy(buckets, "digest").sortBy("digest").format("parquet").mode("append").saveAsTable(self.table)

    def decide(self, batch: DataFrame) -> DataFrame:
        """Per row of an appended batch: which id stays for its text. The rows join the
        index, which has one row per digest, so a hot digest is only a skewed side."""
        return batch.join(self.spark.table(self.table), "digest").select(
            "doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"),
            F.col("digest").alias("text_sha256"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row. Without an index
    given, a new one lives as long as the call."""
    spark = docs.sparkSession
    tables = Tables(spark)
    own = index is None
    index = index or DigestIndex(spark, f"riskframe_digests_{uuid.uuid4().hex}")
    batch = tables.write(digests(docs))
    if not index.exists():
        index.create(batch.count())
    index.append(batch)
    out = index.decide(batch)
    if own:
        out = tables.write(out)
        index.drop()
        tables.drop(batch)
    return out


SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents WHERE doc_id IS NOT NULL),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
