"""Session construction and lineage checkpoints.

The library never builds its own session inside an operator; these helpers are
for entry points, benchmarks and tests.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every entry point wants: AQE for runtime re-planning (coalescing,
# skew-join splitting, broadcast conversion on measured sizes), UTC timestamps.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "riskframe",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must point at shared storage.
    Only a session with a local master, whose executors are this process, may go
    without: it gets a private folder. On a cluster a folder of one machine would lose
    what executors write, so there this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="riskframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_WRITTEN: dict[int, list[str]] = {}
_GENERATION: dict[int, int] = {}


def generation(spark: SparkSession) -> tuple[int, int]:
    """Changes with the session and whenever its lineage tables are released: what is
    kept about them elsewhere is only valid for the generation it was made in."""
    return id(spark), _GENERATION.get(id(spark), 0)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete files or folders through the Hadoop FileSystem."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return [f.getPath().toString() for f in found]


def release_tables(spark: SparkSession) -> int:
    """Delete the lineage tables this session wrote with :func:`cut_lineage`
    (through the Hadoop FileSystem of the checkpoint folder). Call it once the
    DataFrames that read them are no longer needed; returns how many were removed."""
    paths = _WRITTEN.pop(id(spark), [])
    _GENERATION[id(spark)] = _GENERATION.get(id(spark), 0) + 1
    delete_paths(spark, paths)
    return len(paths)


@contextmanager
def scratch_tables(spark: SparkSession):
    """Delete, at the end of the block, the lineage tables written inside it."""
    before = len(_WRITTEN.setdefault(id(spark), []))
    try:
        yield
    finally:
        written = _WRITTEN.get(id(spark), [])
        delete_paths(spark, written[before:])
        del written[before:]


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table under the shared checkpoint
    folder and reading it back. One job, replicated storage (survives executor
    loss), and unlike an RDD checkpoint the later passes get column pruning and
    filter push-down on the written table. Never a local checkpoint."""
    import uuid

    base = checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/riskframe-tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.setdefault(id(df.sparkSession), []).append(path)
    return df.sparkSession.read.parquet(path)


def drop_lineage(df: DataFrame) -> None:
    """Delete the one table that ``df``, a result of :func:`cut_lineage`, reads."""
    spark = df.sparkSession
    names = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    written = _WRITTEN.get(id(spark), [])
    gone = [p for p in written if p.rsplit("/", 1)[-1] in names]
    delete_paths(spark, gone)
    for p in gone:
        written.remove(p)
