"""Sources and sinks.

All readers take an explicit schema where the caller has one (no inference
pass over the data); all writers are Spark writers, so the work is done by the
executors and nothing passes through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskframe.session import delete_paths, list_folder

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
               columns: list[str] | None = None, **options) -> DataFrame:
    """Read a raw table. CSV gets a header by default; a schema skips inference."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.select(*columns) if columns else df


def scan(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """``SELECT *`` of a catalog table, pruned to ``columns`` (pushed into the scan)."""
    df = spark.table(table)
    return df.select(*columns) if columns else df


def stage_csv(df: DataFrame, path: str) -> None:
    """S3: write a stage as headered CSV without an index column."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_stage(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """S3: read a CSV stage back; with ``schema`` the types are fixed, else re-inferred."""
    return read_table(spark, path, "csv", schema)


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """Create a database (dataset) if absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def _versions(spark: SparkSession, table: str) -> str:
    """The folder beside a table's database that holds the versions of a refreshed table."""
    db, _, name = table.replace("`", "").rpartition(".")
    home = spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/_versions_{name}"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").select("data_type")
    return rows.first()[0]


def full_refresh(df: DataFrame, table: str, fmt: str = "parquet") -> int:
    """Replace all rows of a catalog table and return its row count.

    The rows are written to a new folder first; only when they are whole does the table's
    location change, in one step of the catalog. A load that fails leaves the old rows, a
    reader sees the old rows or the new ones, and a query planned before the swap can
    still finish: the version before is kept until the next refresh. ``df`` may read
    the table itself.

    Defined cases: one refresh of a table at a time (older versions and left-overs of
    failed loads are deleted); other columns, types or another format need a new catalog entry,
    so there, and there alone, the table is away between two catalog steps. The count is
    read back from the written files. :func:`drop_refreshed` drops a table with its versions.
    """
    spark = df.sparkSession
    home = _versions(spark, table)
    folder = f"{home}/{uuid.uuid4().hex}"
    df.write.format(fmt).save(folder)
    n = spark.read.schema(df.schema).format(fmt).load(folder).count()
    before = None
    if spark.catalog.tableExists(table):
        before = _location(spark, table)
        about = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Provider'").first()["data_type"]
        if about.lower() == fmt.lower() and spark.table(table).schema.simpleString() == df.schema.simpleString():
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        else:
            spark.sql(f"DROP TABLE {table}")
            spark.catalog.createTable(table, path=folder, source=fmt, schema=df.schema)
    else:
        spark.catalog.createTable(table, path=folder, source=fmt, schema=df.schema)
    keep = {folder.rsplit("/", 1)[-1], (before or "").rsplit("/", 1)[-1]}
    delete_paths(spark, [p for p in list_folder(spark, home) if p.rsplit("/", 1)[-1] not in keep])
    return n


def drop_refreshed(spark: SparkSession, table: str) -> None:
    """Drop a table of :func:`full_refresh` and delete its versions."""
    home = _versions(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    delete_paths(spark, [home])


def write_metrics(df: DataFrame, path: str) -> None:
    """Metrics JSON sink. Metric tables are a handful of rows, so one file."""
    df.repartition(1).write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Save a scored batch or a drift report as parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def log_run(metrics: DataFrame, path: str, experiment: str, run: str) -> None:
    """Append one run's metrics to an experiment log partitioned by experiment."""
    (metrics.withColumn("experiment", F.lit(experiment)).withColumn("run", F.lit(run))
     .withColumn("logged_at", F.current_timestamp())
     .write.mode("append").partitionBy("experiment").parquet(path))


def save_model(model, path: str) -> None:
    """Persist a fitted ``PipelineModel`` (or any MLWritable)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a ``PipelineModel`` and check it exposes class probabilities."""
    from pyspark.ml import PipelineModel

    model = PipelineModel.load(path)
    last = model.stages[-1] if model.stages else None
    if last is None or not last.hasParam("probabilityCol"):
        raise ValueError("model must expose class probabilities (probabilityCol)")
    return model
