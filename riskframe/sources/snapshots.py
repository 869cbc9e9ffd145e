"""K2: the reference snapshot as a durable, versioned table.

A version is a folder ``version=<n>`` below a root on shared storage: ``counts``, the
:func:`riskframe.operators.drift.reference_snapshot` bucketed and sorted by (variable, value as text),
and ``meta``, one row written last. Readers only see versions whose ``meta`` is complete, so a
write that fails half way changes nothing for them, and a reader of an older version
keeps it. Any session can open a version: the bucketing is declared anew over its
folder, so a drift report joins it without an exchange of the reference.

Defined cases: an empty reference is a version without rows; two writers that pick the same number:
the later one fails and nothing is overwritten.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.drift import reference_snapshot, value_key
from riskframe.operators.ranking import local_frame

#: Distinct values that a bucket is meant to hold.
VALUES_PER_BUCKET = 1_000_000

_COUNTS = "variable STRING, value DOUBLE, c_ref BIGINT, vkey STRING"


def _fingerprint() -> Column:
    return F.coalesce(F.expr("bit_xor(xxhash64(variable, value, c_ref))"), F.lit(0).cast("long"))


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions below ``root``, ascending."""
    return sorted(v for v, done in _versions(spark, root).items() if done)


def _versions(spark: SparkSession, root: str) -> dict[int, bool]:
    """Every version below ``root`` and whether it is complete."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    numbers = [int(n.split("=")[1]) for n in names if n.startswith("version=")]
    return {v: fs.exists(hadoop.Path(f"{root}/version={v}/meta/_SUCCESS")) for v in numbers}


def save_snapshot(reference: DataFrame, cols: Sequence[str], root: str) -> int:
    """Store the snapshot of ``cols`` as the next version below ``root``; returns its number.
    The buckets follow from the number of distinct values."""
    spark, root = reference.sparkSession, root.rstrip("/")
    counts = reference_snapshot(reference, cols).withColumn("vkey", value_key("value"))
    one = counts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("c_ref"), F.lit(0)).alias("rows"),
                     _fingerprint().alias("fingerprint")).first()
    # not fewer than a shuffle has, or the planner deals the reference anew for parallelism
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(one["n"] / VALUES_PER_BUCKET))
    version = max(_versions(spark, root), default=0) + 1
    path = f"{root}/version={version}"
    name = _table_name(path) + "_writing"
    keys = ["variable", "vkey"]
    try:
        (counts.repartition(buckets, *keys).write.mode("errorifexists").format("parquet").bucketBy(buckets, *keys)
         .sortBy(*keys).option("path", f"{path}/counts").saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")       # an external table: its files stay
    meta = local_frame(spark, [(version, buckets, list(cols), one["n"], one["rows"], one["fingerprint"])],
                       "version int, buckets int, columns array<string>, n_values long, n_rows long, fingerprint long")
    meta.write.mode("errorifexists").parquet(f"{path}/meta")
    return version


def _table_name(path: str) -> str:
    return "riskframe_snapshot_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def snapshot_meta(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """What is known of a complete version (the newest by default)."""
    root = root.rstrip("/")
    versions = snapshot_versions(spark, root)
    if version is None and versions:
        version = versions[-1]
    if version not in versions:
        raise FileNotFoundError(f"no complete snapshot version {version or ''} in {root}")
    return spark.read.parquet(f"{root}/version={version}/meta").first().asDict()


def open_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A stored snapshot (the newest complete version by default) for every report that takes
    a reference. Nothing of the training rows is read."""
    meta = snapshot_meta(spark, root, version)
    path = f"{root.rstrip('/')}/version={meta['version']}"
    name = _table_name(f"{path} {meta['buckets']} {meta['fingerprint']}")
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({_COUNTS}) USING parquet CLUSTERED BY (variable, vkey) "
              f"SORTED BY (variable, vkey) INTO {meta['buckets']} BUCKETS LOCATION '{place}/counts'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def snapshot_is_whole(spark: SparkSession, root: str, version: int | None = None) -> bool:
    """Whether the stored counts still have the fingerprint they were written with."""
    meta = snapshot_meta(spark, root, version)
    got = open_snapshot(spark, root, meta["version"]).agg(
        F.count(F.lit(1)).alias("n"), _fingerprint().alias("fingerprint")).first()
    return (got["n"], got["fingerprint"]) == (meta["n_values"], meta["fingerprint"])
