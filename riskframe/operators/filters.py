"""Filters and predicates (F1-F8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.exprs import whitelist as _whitelist_expr
from riskframe.operators.ranking import quantile_row


def keep_in_range_or_null(bounds: Mapping[str, tuple[float, float]]) -> Column:
    """Predicate of F1: every bounded column is inside ``[lo, hi]`` or NULL.
    Pushed to parquet as ``Or(And(>=, <=), IsNull)``."""
    cond = F.lit(True)
    for c, (lo, hi) in bounds.items():
        cond = cond & (F.col(c).between(lo, hi) | F.col(c).isNull())
    return cond


def range_filter_keep_null(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """F1: inclusive range filter that keeps nulls (age 18-100, score 150-950)."""
    present = {c: b for c, b in bounds.items() if c in df.columns}
    return df.where(keep_in_range_or_null(present)) if present else df


def range_filter_report(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """F1 removed-row count: (n_before, n_after, n_removed) in one aggregate pass."""
    keep = keep_in_range_or_null({c: b for c, b in bounds.items() if c in df.columns})
    return df.agg(F.count(F.lit(1)).alias("n_before"),
                  F.sum(F.when(keep, 1).otherwise(0)).cast("long").alias("n_after")
                  ).withColumn("n_removed", F.col("n_before") - F.col("n_after"))


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """drop rows with any null (NaN counts as missing, as in pandas)."""
    cols = list(cols) if cols is not None else df.columns
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    cond = F.lit(True)
    for c in cols:
        ok = F.col(c).isNotNull()
        if c in floats:
            ok = ok & ~F.isnan(c)
        cond = cond & ok
    return df.where(cond)


def clip_tail(df: DataFrame, cols: Sequence[str], q: float = 0.99) -> DataFrame:
    """keep rows where every listed column is at or below its exact ``q``
    quantile (nulls dropped, as pandas' ``data[data <= p99]``). The
    quantiles come from one bucketed selection plan and are attached as a
    scalar subquery."""
    cuts = quantile_row(df, cols, q, prefix="__cut_")
    packed = cuts.select(F.struct(*cuts.columns).alias("s")).scalar()
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) <= packed[f"__cut_{c}"])
    return df.where(cond)


def clip_tail_report(df: DataFrame, cols: Sequence[str], q: float = 0.99) -> DataFrame:
    """F4 for several columns, each on its own: (variable, n_kept, max_kept) of the rows at
    or below the column's exact ``q`` quantile. One quantile plan for all columns and one
    aggregate pass."""
    from riskframe.operators.ranking import quantile_values

    cuts = quantile_values(df, cols, q)
    kept = {c: F.col(c) <= F.lit(cuts[c]) for c in cols}
    one = df.agg(*[x for c in cols for x in (F.count(F.when(kept[c], 1)).alias(f"n_{c}"), F.max(F.when(kept[c], F.col(c))).alias(f"m_{c}"))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"n_{c}").alias("n_kept"),
                                                  F.col(f"m_{c}").cast("double").alias("max_kept")) for c in cols])))


def is_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """membership filter."""
    return df.where(F.col(col).isin(*values))


# (rule name, column, lower bound or None, upper bound or None, inclusive)
Rule = tuple[str, str, float | None, float | None]


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """domain rules -> (rule, variable, n_checked, n_violations, n_null, pct_violations).

    A rule is ``(name, column, lo, hi)``; ``lo``/``hi`` are inclusive bounds, and
    ``hi=None`` with ``lo`` given means ``> lo`` when the name ends in ``_positive``.
    All rules are conditional sums in one aggregate pass, then unpivoted.
    """
    aggs, names = [], []
    for i, (name, col, lo, hi) in enumerate(rules):
        c = F.col(col)
        if name.endswith("_positive"):
            ok = c > lo
        else:
            ok = F.lit(True)
            if lo is not None:
                ok = ok & (c >= lo)
            if hi is not None:
                ok = ok & (c <= hi)
        aggs += [F.sum(F.when(c.isNotNull() & ~ok, 1).otherwise(0)).cast("long").alias(f"v{i}"),
                 F.sum(F.when(c.isNull(), 1).otherwise(0)).cast("long").alias(f"n{i}")]
        names.append((name, col))
    aggs.append(F.count(F.lit(1)).alias("rows"))
    one = df.agg(*aggs)
    packed = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(c).alias("variable"),
                                F.col(f"v{i}").alias("n_violations"), F.col(f"n{i}").alias("n_null"))
                       for i, (n, c) in enumerate(names)])
    return (one.select("rows", F.inline(packed))
            .select("rule", "variable", (F.col("rows") - F.col("n_null")).alias("n_checked"),
                    "n_violations", "n_null",
                    (F.col("n_violations") * 100.0 / F.nullif(F.col("rows") - F.col("n_null"), F.lit(0)))
                    .alias("pct_violations")))


def enforce_schema(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """align a batch to ``schema``.

    Missing required columns raise (a request-shape error). Values are cast with
    ``try_cast``; rows where a non-nullable field is null or failed to cast go
    to the rejected frame with a ``reject_reason``; the accepted frame has
    exactly the schema's columns and types.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing required fields: {missing}")
    casted = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields],
                       *[F.col(f.name).alias(f"__raw_{f.name}") for f in schema.fields])
    reasons = [F.when(F.col(f.name).isNull(),
                      F.concat(F.lit(f"{f.name}: "), F.when(F.col(f"__raw_{f.name}").isNull(), F.lit("required"))
                               .otherwise(F.lit("bad type"))))
               for f in schema.fields if not f.nullable]
    reason = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    tagged = casted.withColumn("reject_reason", F.nullif(reason, F.lit("")))
    accepted = tagged.where(F.col("reject_reason").isNull()).select(*[f.name for f in schema.fields])
    rejected = tagged.where(F.col("reject_reason").isNotNull()).select(
        *[F.col(f"__raw_{f.name}").alias(f.name) for f in schema.fields], "reject_reason")
    return accepted, rejected


def whitelist_column(df: DataFrame, col: str, allowed: Sequence, out: str | None = None) -> DataFrame:
    """F8: any value outside the allowed domain becomes NULL (no UDF)."""
    return df.withColumn(out or col, _whitelist_expr(col, allowed))
