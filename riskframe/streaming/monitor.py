"""Streaming re-aim of the periodic monitor (K9) and of batch scoring.

* :func:`period_stats` is the tumbling-window aggregation (count and mean per
  period and key). Applied to a batch DataFrame it is the batch report; applied
  to a ``readStream`` DataFrame with :func:`stream_period_stats` it runs with a
  watermark equal to the period, so each window's state is dropped once the
  watermark passes its end (bounded state).
* :func:`stream_period_drift` is the drift test of each tumbling period of a stream, late
  rows within the watermark included: the state is the count of each (period, variable,
  value), spread over all tasks, and goes when the watermark passes the period's end; the
  report of a period is made once, from its complete counts, against a stored snapshot.
* :func:`stream_drift` runs the exact two-sample KS per micro-batch against the
  reference snapshot (``foreachBatch``).
* :func:`stream_scores` applies a fitted ``PipelineModel`` to a stream and
  appends scored rows (the scoring endpoint as a stream).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.drift import ks_report, period_counts, report_of_periods
from riskframe.session import cut_lineage, scratch_tables


def period_stats(events: DataFrame, period: str = "7 days", ts: str = "ts", key: str = "event_type",
                 value: str = "value") -> DataFrame:
    """K9 aggregation: per tumbling window and key: n and mean value. Event time
    is normalised to TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    if events.schema[ts].dataType.simpleString() != "timestamp":     # a new column would lose the stream's watermark
        events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    w = F.window(ts, period)
    return (events.groupBy(w.alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"))
            .select(F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), key, "n",
                    "mean_value"))


def stream_period_stats(stream: DataFrame, period: str = "7 days", ts: str = "ts", key: str = "event_type",
                        value: str = "value", watermark: str | None = None) -> DataFrame:
    """Watermarked streaming form of :func:`period_stats` (append mode emits each
    window once, when the watermark passes its end)."""
    stream = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark or period)
    return period_stats(stream, period, ts, key, value)


def stream_drift(stream: DataFrame, reference: DataFrame, cols: Sequence[str],
                 sink: Callable[[DataFrame, int], None], threshold: float = 0.05, checkpoint: str | None = None,
                 trigger: dict | None = None):
    """Start a query that, for every micro-batch, computes the KS drift report of
    the batch against ``reference`` (best a stored snapshot) and hands (report, batch_id)
    to ``sink``, which must read it before it returns."""
    def each(batch: DataFrame, batch_id: int):
        with scratch_tables(batch.sparkSession):     # the report is read in the sink, nothing stays behind
            rep = ks_report(reference, batch, list(cols), threshold).withColumn("batch_id", F.lit(batch_id))
            sink(rep, batch_id)

    w = stream.writeStream.foreachBatch(each)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def stream_period_drift(stream: DataFrame, snapshot: DataFrame, cols: Sequence[str], sink: Callable[[DataFrame, int], None],
                        ts: str = "ts", period: str = "7 days", watermark: str | None = None, threshold: float = 0.05,
                        digits: int = 4, min_rows: int = 2, checkpoint: str | None = None, trigger: dict | None = None):
    """K9: start a query that reports the drift of each ``period`` of ``stream`` once, when the
    watermark (by default a period behind the newest row) has passed its end.

    ``snapshot`` is a stored :func:`riskframe.operators.drift.reference_snapshot`. The counts of a
    period leave the state all together, in append mode, so a micro-batch holds whole periods;
    ``sink(report, batch_id)`` gets the report of those that ended, with the columns of
    :func:`riskframe.operators.drift.drift_by_period`, and must read it before it returns. Micro-batches in
    which no period ends do not call it. After a restart from ``checkpoint`` a micro-batch that
    was under way is given again with its ``batch_id``."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark or period)

    def each(ended: DataFrame, batch_id: int):
        with scratch_tables(ended.sparkSession):
            counts = cut_lineage(ended)
            if counts.limit(1).count():
                sink(report_of_periods(snapshot, counts, threshold, digits, min_rows), batch_id)

    w = period_counts(timed, cols, ts, period).writeStream.outputMode("append").foreachBatch(each)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def stream_scores(stream: DataFrame, model, keep: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Streaming batch scoring (prediction, label, rounded default probability).
    The batch size column of the batch scorer is omitted (it is per micro-batch)."""
    from pyspark.ml.functions import vector_to_array

    from riskframe.plans.presets import LABELS
    scored = model.transform(stream)
    p_mora = vector_to_array(F.col("probability"))[0]
    label = F.when(F.col("prediction") == 1, LABELS[1]).when(F.col("prediction") == 0, LABELS[0])
    return scored.select(*keep, F.col("prediction").cast("int").alias("prediccion"), label.alias("etiqueta"),
                         F.bround(p_mora, digits).alias("probabilidad_mora"))


def run_log_stream(metrics_stream: DataFrame, path: str, checkpoint: str, experiment: str):
    """S8 as a stream: append each micro-batch of metric rows to the experiment log."""
    return (metrics_stream.withColumn("experiment", F.lit(experiment))
            .withColumn("logged_at", F.current_timestamp())
            .writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy("experiment").outputMode("append").start())
