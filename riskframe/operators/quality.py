"""Null handling and data-quality profiling (Q1-Q8).

Every per-column report is ONE aggregate pass over the table (conditional sums
for all columns at once), unpivoted to long (variable, ...) rows; never a loop
of one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.projection import columns_of_type
from riskframe.operators.ranking import attach, quantile_row, unpivot_numeric

_FLOATS = (T.FloatType, T.DoubleType)


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    dt = df.schema[name].dataType
    return c.isNull() | F.isnan(c) if isinstance(dt, _FLOATS) else c.isNull()


def _per_column(df: DataFrame, cols: Sequence[str], agg_of, name: str) -> DataFrame:
    one = df.agg(*[agg_of(c).cast("long").alias(f"c{i}") for i, c in enumerate(cols)])
    packed = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"c{i}").alias(name)) for i, c in enumerate(cols)])
    return one.select(F.inline(packed))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None, only_positive: bool = False) -> DataFrame:
    """Q1: (variable, n_null); NaN counts as missing."""
    cols = list(cols) if cols is not None else df.columns
    out = _per_column(df, cols, lambda c: F.sum(F.when(_missing(df, c), 1).otherwise(0)), "n_null")
    return out.where(F.col("n_null") > 0) if only_positive else out


def null_pct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q2: (variable, n_null, n_rows, pct_null), highest share first."""
    cols = list(cols) if cols is not None else df.columns
    aggs = [F.sum(F.when(_missing(df, c), 1).otherwise(0)).cast("long").alias(f"c{i}") for i, c in enumerate(cols)]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    packed = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"c{i}").alias("n_null")) for i, c in enumerate(cols)])
    return (one.select("n_rows", F.inline(packed))
            .select("variable", "n_null", "n_rows",
                    (F.col("n_null") * 100.0 / F.nullif(F.col("n_rows"), F.lit(0))).alias("pct_null"))
            .orderBy(F.desc("pct_null"), "variable"))


def high_null_columns(df: DataFrame, threshold: float = 0.15, cols: Sequence[str] | None = None) -> DataFrame:
    """Q3: columns whose null share exceeds ``threshold`` (the drop candidates)."""
    return null_pct(df, cols).where(F.col("pct_null") > threshold * 100)


def zero_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q4: (variable, n_zero) for numeric columns."""
    cols = list(cols) if cols is not None else columns_of_type(df, "numeric")
    return _per_column(df, cols, lambda c: F.sum(F.when(F.col(c) == 0, 1).otherwise(0)), "n_zero")


# The disguised-null markers scanned by the original profiling step.
SENTINEL_STRINGS = ("", " ", "NA", "N/A", "n/a", "na", "NULL", "null", "None", "none",
                    "-", "--", "?", "unknown", "Unknown")
SENTINEL_NUMBERS = (-1, -999, -9999, 99999)


def sentinel_scan(df: DataFrame, cols: Sequence[str] | None = None,
                  strings: Sequence[str] = SENTINEL_STRINGS, numbers: Sequence[float] = SENTINEL_NUMBERS,
                  only_hits: bool = True) -> DataFrame:
    """Q5: disguised nulls. Strings are compared with string markers and numbers
    with numeric markers. (variable, n_hits, hits) where ``hits`` is the sorted set
    of matched values as strings (bounded by the marker list)."""
    cols = list(cols) if cols is not None else df.columns
    nums = set(columns_of_type(df, "numeric"))
    strs = set(columns_of_type(df, "string"))
    aggs, used = [], []
    for i, c in enumerate(cols):
        if c in nums:
            hit = F.col(c).isin(*numbers)
        elif c in strs:
            hit = F.col(c).isin(*strings)
        else:
            continue
        aggs += [F.sum(F.when(hit, 1).otherwise(0)).cast("long").alias(f"n{i}"),
                 F.array_sort(F.collect_set(F.when(hit, F.col(c).cast("string")))).alias(f"h{i}")]
        used.append((i, c))
    if not used:
        return df.sparkSession.createDataFrame([], "variable string, n_hits long, hits array<string>")  # empty
    one = df.agg(*aggs)
    packed = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"n{i}").alias("n_hits"),
                                F.col(f"h{i}").alias("hits")) for i, c in used])
    out = one.select(F.inline(packed))
    return out.where(F.col("n_hits") > 0) if only_hits else out


def distinct_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q6: (variable, value as string) distinct pairs, nulls kept as NULL values.
    One Expand + one distinct aggregate for all columns."""
    cols = list(cols) if cols is not None else df.columns
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return wide.unpivot([], cols, "variable", "value").distinct()


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Q6 summary: (variable, n_distinct) excluding nulls; ``approx`` uses HyperLogLog++."""
    cols = list(cols) if cols is not None else df.columns
    fn = F.approx_count_distinct if approx else F.count_distinct
    return _per_column(df, cols, lambda c: fn(F.col(c)), "n_distinct")


def value_counts(df: DataFrame, cols: Sequence[str], dropna: bool = True, normalize: bool = False) -> DataFrame:
    """Q7: (variable, value, count[, share]) for one or more columns.

    ``share`` divides by the per-variable total, attached by a join on the tiny
    per-variable totals table rather than a window over all distinct values."""
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "variable", "value")
    if dropna:
        long = long.where(F.col("value").isNotNull())
    counts = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return counts
    totals = counts.groupBy("variable").agg(F.sum("count").alias("__total"))
    return (attach(counts, totals, ["variable"], broadcast=True)
            .withColumn("share", F.col("count") / F.col("__total")).drop("__total"))


def fit_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q8 fit: exact medians (pandas ``median``) of the present columns, one row.
    Not ``ml.Imputer``: its median is approximate."""
    present = [c for c in cols if c in df.columns]
    return quantile_row(df, present, 0.5)


def apply_fill(df: DataFrame, fills: DataFrame) -> DataFrame:
    """Q8 transform: fill nulls (and NaN) with the learnt values (a one-row frame,
    attached as one scalar subquery)."""
    names = [c for c in fills.columns if c in df.columns]
    if not names:
        return df
    packed = fills.select(F.struct(*names).alias("s")).scalar()
    out = []
    for c in df.columns:
        if c in names:
            v = F.col(c)
            if isinstance(df.schema[c].dataType, _FLOATS):
                v = F.when(~F.isnan(v), v)
            out.append(F.coalesce(v, packed[c].cast(df.schema[c].dataType)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def impute_median(df: DataFrame, cols: Sequence[str], fit_df: DataFrame | None = None) -> DataFrame:
    """Q8: learn medians on ``fit_df`` (default: ``df`` itself) and fill ``df``."""
    return apply_fill(df, fit_medians(fit_df if fit_df is not None else df, cols))


def long_values(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    return unpivot_numeric(df, cols, ids)
