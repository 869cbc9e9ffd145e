"""Drift monitoring.

Two-sample Kolmogorov-Smirnov for every numeric column at once: both sides are
unpivoted to (variable, value), counted per distinct (variable, value), and the
two empirical CDFs are running totals in value order (bucketed, so a variable
with billions of distinct values is not one task). D is the max CDF gap per
variable; the p-value is the asymptotic Kolmogorov distribution with Stephens'
small-sample correction, evaluated as a 100-term series inside the JVM.

The original uses an exact p-value when both sides have <= 10,000 rows: that is
``ks_report(exact=True)``, a lattice-path recurrence per variable. The tests bound the
difference of the series from it, from 20 by 30 rows: 0.045 at most, 0.02 where either p-value
is below 0.1, so a decision can only differ for p-values that close to the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskframe.operators.projection import common_columns
from riskframe.operators.ranking import local_frame, materialize_small, running_totals, unpivot_numeric
from riskframe.session import cut_lineage
from riskframe.plans.presets import DRIFT_P

REPORT_SCHEMA = ("variable string, ks_statistic double, p_value double, drift_detectado boolean, "
                 "media_referencia double, media_produccion double")


def kolmogorov_pvalue(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Q_KS((sqrt(en) + 0.12 + 0.11 / sqrt(en)) * D), en = n1 n2 / (n1 + n2),
    Q_KS(l) = 2 sum_{j>=1} (-1)^(j-1) exp(-2 j^2 l^2), clamped to [0, 1]."""
    en = F.sqrt(F.try_divide(n1.cast("double") * n2, n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(-2.0 * j * j * lam * lam))
    return (F.when(lam < 0.1, F.lit(1.0))
            .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series))))


#: Sides up to which the exact p-value is taken, as the original does.
EXACT_ROWS = 10_000


def path_pvalue(d: float, n1: int, n2: int) -> float:
    """P(D >= d) of two samples of one distribution, without ties: the share of lattice paths
    from (0, 0) to (n1, n2) that reach a cell where the two distributions are ``d`` apart.

    With q(i, j) the share of paths to (i, j) that did, the last step of a path to (i, j) comes
    from (i - 1, j) with probability i / (i + j), so q(i, j) = (i q(i - 1, j) + j q(i, j - 1)) / (i + j),
    and 1 in such a cell. All terms are positive: small values keep their digits. One step
    is a diagonal; memory is one diagonal of the smaller side."""
    import numpy as np

    n, m = sorted((n1, n2))
    reach = round(d * n * m)
    if reach <= 0:
        return 1.0
    i = np.arange(n + 1)
    q = np.zeros(n + 1)
    for t in range(1, n + m + 1):
        j = t - i
        q[1:] = (i[1:] * q[:-1] + j[1:] * q[1:]) / t
        q[np.abs(i * m - j * n) >= reach] = 1.0
        q[(j < 0) | (j > m)] = 0.0
    return float(q[n])


def with_exact_pvalue(table: DataFrame, rows: int = EXACT_ROWS) -> DataFrame:
    """``table`` (with d, n_ref, n_prod: a row per tested variable) and ``p_exact``, null where a side has
    more than ``rows`` rows or none. A variable is a task's work: its two sides are bounded."""
    schema = StructType([*table.schema.fields, StructField("p_exact", DoubleType())])

    def run(batches):
        for pdf in batches:
            ok = (pdf[["n_ref", "n_prod"]].max(axis=1) <= rows) & (pdf[["n_ref", "n_prod"]].min(axis=1) > 0) & pdf["d"].notna()
            pdf["p_exact"] = [path_pvalue(d, int(a), int(b)) if k else None for k, d, a, b in zip(ok, pdf["d"], pdf["n_ref"], pdf["n_prod"])]
            yield pdf

    return table.repartition("variable").mapInPandas(run, schema)


def reference_snapshot(reference: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K2: the reference side of every later test, computed and stored once: how often
    each value of each column occurs, (variable, value, c_ref). Reports that are given
    the snapshot do not read the reference again."""
    return cut_lineage(unpivot_numeric(reference, cols).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("c_ref")))


def _counts(reference: DataFrame, production: DataFrame) -> DataFrame:
    """(variable, value, c_ref, c_prod) of a snapshot and long production rows. One
    shuffle; it is read three times (range, bucket offsets, CDF walk), so it is written."""
    if "vkey" in reference.columns:
        return cut_lineage(stored_counts(reference, production))
    zero = F.lit(0).cast("long")
    both = reference.select("variable", "value", "c_ref", zero.alias("c_prod")).unionByName(
        production.select("variable", "value", zero.alias("c_ref"), F.lit(1).cast("long").alias("c_prod")))
    return cut_lineage(both.groupBy("variable", "value").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_prod").alias("c_prod")))


def value_key(value) -> Column:
    """A value as text, by which stored snapshots are bucketed: two doubles have the same one
    only if they are equal. (The planner wraps a join key of type double, which hides
    bucketing by it.)"""
    return (F.col(value) + F.lit(0.0)).cast("string")         # -0.0 is 0.0


def stored_counts(reference: DataFrame, production: DataFrame) -> DataFrame:
    """The counts of a stored snapshot (bucketed by variable and ``vkey``) and of long production
    rows: only the production counts are shuffled."""
    seen = production.withColumn("vkey", value_key("value")).groupBy("variable", "vkey").agg(
        (F.first("value") + F.lit(0.0)).alias("__v"), F.count(F.lit(1)).alias("c_prod"))
    both = reference.select("variable", "vkey", "value", "c_ref").join(seen, ["variable", "vkey"], "full")
    zero = F.lit(0).cast("long")
    return both.select("variable", F.coalesce("value", "__v").alias("value"), F.coalesce("c_ref", zero).alias("c_ref"),
                       F.coalesce("c_prod", zero).alias("c_prod"))


def _ks(counts: DataFrame) -> DataFrame:
    """(variable, d, n_ref, n_prod, mean_ref, mean_prod) of a counts table."""
    sides = materialize_small(counts.groupBy("variable").agg(
        F.sum("c_ref").alias("n_ref"), F.sum("c_prod").alias("n_prod"),
        F.try_divide(F.sum(F.col("value") * F.col("c_ref")), F.sum("c_ref")).alias("mean_ref"),
        F.try_divide(F.sum(F.col("value") * F.col("c_prod")), F.sum("c_prod")).alias("mean_prod")))
    cum = running_totals(counts, ["variable"], "value", ["c_ref", "c_prod"])
    cum = cum.join(F.broadcast(sides), "variable")   # one row per column: proven bound
    gap = F.abs(F.try_divide(F.col("cum_c_ref"), F.col("n_ref")) - F.try_divide(F.col("cum_c_prod"), F.col("n_prod")))
    d = cum.groupBy("variable").agg(F.max(gap).alias("d"))
    return sides.join(d, "variable", "left")


def ks_table(reference: DataFrame, production: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K1 core: (variable, d, n_ref, n_prod, mean_ref, mean_prod) for ``cols``
    present on both sides, nulls/NaN dropped per column. ``reference`` may be a
    :func:`reference_snapshot`, or a stored one (:mod:`riskframe.sources.snapshots`)."""
    if set(reference.columns) - {"vkey"} != {"variable", "value", "c_ref"}:
        reference = unpivot_numeric(reference, cols).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("c_ref"))
    return _ks(_counts(reference.where(F.col("variable").isin(list(cols))), unpivot_numeric(production, cols)))


def _report(t: DataFrame, threshold: float, digits: int | None, min_rows: int, keys: Sequence[str] = (), exact: bool = False) -> DataFrame:
    t = t.where((F.col("n_prod") >= min_rows) & (F.col("n_ref") >= 1))
    p = kolmogorov_pvalue(F.col("d"), F.col("n_ref"), F.col("n_prod"))
    if exact:
        t = with_exact_pvalue(t)
        p = F.coalesce("p_exact", p)
    rnd = (lambda c: F.bround(c, digits)) if digits is not None else (lambda c: c)
    return t.select(*keys, "variable", rnd(F.col("d")).alias("ks_statistic"), rnd(p).alias("p_value"),
                    (p < threshold).alias("drift_detectado"), rnd(F.col("mean_ref")).alias("media_referencia"),
                    rnd(F.col("mean_prod")).alias("media_produccion"))


def ks_report(reference: DataFrame, production: DataFrame, cols: Sequence[str] | None = None,
              threshold: float = DRIFT_P, digits: int | None = 4, min_rows: int = 2, exact: bool = False) -> DataFrame:
    """K1: per numeric column common to both sides: KS statistic, p-value, drift
    flag (p < threshold, on the unrounded p), both means; rounded to ``digits``. With ``exact`` the
    p-value of sides of at most ``EXACT_ROWS`` rows is the exact one, as in the original; the
    default is the asymptotic series for all sizes, which stays in the JVM.

    Columns with fewer than ``min_rows`` production values are skipped, so a batch of
    fewer rows gives an empty report; with no common column the report is empty too."""
    spark = reference.sparkSession
    if cols is None and "c_ref" in reference.columns:           # a snapshot: a name per column of the reference
        names = {r["variable"] for r in reference.select("variable").distinct().collect()}
        cols = [c for c in common_columns(production, production, "numeric") if c in names]
    elif cols is None:
        cols = common_columns(reference, production, "numeric")
    elif "c_ref" in reference.columns:
        cols = [c for c in cols if c in production.columns]
    else:
        cols = [c for c in cols if c in reference.columns and c in production.columns]
    if not cols:
        return local_frame(spark, [], REPORT_SCHEMA)
    return _report(ks_table(reference, production, cols), threshold, digits, min_rows, exact=exact)


def period_counts(events: DataFrame, cols: Sequence[str], ts: str = "ts", period: str = "7 days") -> DataFrame:
    """How often each value of each column occurs in each tumbling ``period``:
    (period_start, variable, value, c_prod). One aggregate, combined map-side; over a
    stream with a watermark it is append-mode state that holds a period until it is over."""
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), value(c).alias("value")) for c in cols])
    if events.schema[ts].dataType.simpleString() != "timestamp":     # a new column would lose a stream's watermark
        events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    long = events.select(F.col(ts).alias("__ts"), F.explode(pairs).alias("p")).where("p.value IS NOT NULL")
    counts = long.groupBy(F.window("__ts", period).alias("w"), F.col("p.variable").alias("variable"), F.col("p.value").alias("value"))
    return counts.agg(F.count(F.lit(1)).alias("c_prod")).select(F.col("w.start").alias("period_start"), "variable", "value", "c_prod")


def report_of_periods(snapshot: DataFrame, counts: DataFrame, threshold: float = DRIFT_P, digits: int = 4, min_rows: int = 2) -> DataFrame:
    """The drift report of every period of :func:`period_counts` against one
    :func:`reference_snapshot`.

    Between two values of a period its distribution stands still and the reference's only
    grows, so the largest gap lies at a period's own value, or just below one. The
    reference's distribution is therefore walked once, whatever the number of periods, over
    its values and those of all periods; a period joins it at its own values."""
    counts = cut_lineage(counts.where(F.col("variable").isNotNull()))
    snapshot = snapshot.join(F.broadcast(counts.select("variable").distinct()), "variable", "left_semi")     # a row per column
    zero = F.lit(0).cast("long")
    steps = snapshot.select("variable", "value", "c_ref").unionByName(counts.select("variable", "value", zero.alias("c_ref")))
    walked = running_totals(cut_lineage(steps.groupBy("variable", "value").agg(F.sum("c_ref").alias("c_ref"))), ["variable"], "value", ["c_ref"])
    key = ["period_start", "variable"]
    own = running_totals(counts, key, "value", ["c_prod"])
    ref = materialize_small(snapshot.groupBy("variable").agg(F.sum("c_ref").alias("n_ref"), F.try_divide(
        F.sum(F.col("value") * F.col("c_ref")), F.sum("c_ref")).alias("mean_ref")))
    prod = materialize_small(counts.groupBy(*key).agg(F.sum("c_prod").alias("n_prod"), F.try_divide(
        F.sum(F.col("value") * F.col("c_prod")), F.sum("c_prod")).alias("mean_prod")))
    at = own.join(walked, ["variable", "value"]).join(prod, key).join(F.broadcast(ref), "variable")     # ref: a row per column
    here = F.abs(F.col("cum_c_ref") / F.col("n_ref") - F.col("cum_c_prod") / F.col("n_prod"))
    below = F.abs((F.col("cum_c_ref") - F.col("c_ref")) / F.col("n_ref") - (F.col("cum_c_prod") - F.col("c_prod")) / F.col("n_prod"))
    d = at.groupBy(*key).agg(F.max(F.greatest(here, below)).alias("d"))
    return _report(prod.join(d, key).join(F.broadcast(ref), "variable"), threshold, digits, min_rows, ["period_start"])


def drift_by_period(reference: DataFrame, events: DataFrame, cols: Sequence[str], ts: str = "ts", period: str = "7 days",
                    threshold: float = DRIFT_P, digits: int = 4, min_rows: int = 2) -> DataFrame:
    """K9: the report of every tumbling ``period`` of ``events`` against one reference, rows or a
    :func:`reference_snapshot`: (period_start, variable, ks_statistic, ...)."""
    snap = reference if "c_ref" in reference.columns else reference_snapshot(reference, cols)
    return report_of_periods(snap, period_counts(events, cols, ts, period), threshold, digits, min_rows)


def drifted_variables(report: DataFrame) -> DataFrame:
    """K3: the variables flagged as drifted."""
    return report.where(F.col("drift_detectado")).select("variable")


def drift_status(report: DataFrame) -> DataFrame:
    """K3: overall status: any drift, number drifted, number tested."""
    return report.agg(F.coalesce(F.bool_or("drift_detectado"), F.lit(False)).alias("hay_drift"),
                      F.sum(F.col("drift_detectado").cast("int")).cast("long").alias("n_drift"),
                      F.count(F.lit(1)).alias("n_variables"))


def top_by_statistic(report: DataFrame, k: int = 10) -> DataFrame:
    """K4: top-k variables by KS statistic (ties by name)."""
    return report.orderBy(F.desc("ks_statistic"), "variable").limit(k)


def top_mean_shift(report: DataFrame, k: int = 8) -> DataFrame:
    """K5: top-k variables by absolute mean difference."""
    diff = F.abs(F.col("media_produccion") - F.col("media_referencia"))
    return report.select("variable", diff.alias("mean_diff")).orderBy(F.desc("mean_diff"), "variable").limit(k)


def check_batch(reference: DataFrame, batch: DataFrame, threshold: float = DRIFT_P, min_rows: int = 2) -> DataFrame:
    """K8: on-demand drift check of a batch with schema/size guards: returns the
    report (empty when the batch is too small or shares no numeric column)."""
    return ks_report(reference, batch, None, threshold, min_rows=min_rows)


STATUS = {"small": "Muestra insuficiente para análisis de drift (mínimo 2 registros).",
          "schema": "No se encontraron columnas numéricas en común. Verifique el esquema de los datos enviados.",
          "drift": "Drift detectado", "none": "Sin drift significativo"}


def batch_status(reference: DataFrame, batch: DataFrame, threshold: float = DRIFT_P, min_rows: int = 2) -> DataFrame:
    """K8: one row (status, hay_drift, n_variables) for a batch. Too small a batch is
    told first, then a batch without common numeric columns, then the verdict."""
    numeric = common_columns(batch, batch, "numeric")
    value = lambda c: F.col(c).cast("double")             # noqa: E731
    seen = batch.agg(F.count(F.lit(1)).alias("n"), *[
        F.count(F.when(~F.isnan(value(c)), value(c))).alias(f"n{i}") for i, c in enumerate(numeric)]).first()
    enough = [c for i, c in enumerate(numeric) if seen[f"n{i}"] >= min_rows]
    rows = F.lit(seen["n"])
    # a column of fewer values is in no report, so the reference is only walked for the others
    report = check_batch(reference, batch.select(*enough), threshold, min_rows) if enough else local_frame(
        reference.sparkSession, [], REPORT_SCHEMA)
    one = report.agg(F.count(F.lit(1)).alias("n_variables"), F.coalesce(F.bool_or("drift_detectado"), F.lit(False)).alias("hay_drift"))
    status = (F.when(rows < min_rows, STATUS["small"]).when(F.col("n_variables") == 0, STATUS["schema"])
              .when(F.col("hay_drift"), STATUS["drift"]).otherwise(STATUS["none"]))
    return one.select(status.alias("status"), "hay_drift", "n_variables")
