"""Projections (P1-P10): schema-level selection, casts, labels, rounding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.exprs import label_map as _label_map_expr
from riskframe.functions.exprs import ordinal as _ordinal_expr
from riskframe.operators.ranking import local_frame, unpivot_numeric

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns, ignoring names that are absent."""
    return df.drop(*[c for c in cols if c in df.columns])


def columns_of_type(df: DataFrame, kind: str = "numeric", exclude: Sequence[str] = ()) -> list[str]:
    """Column names by kind: ``numeric``, ``string``, ``boolean``, ``temporal``."""
    def ok(dt):
        if kind == "numeric":
            return isinstance(dt, _NUMERIC)
        if kind == "string":
            return isinstance(dt, T.StringType)
        if kind == "boolean":
            return isinstance(dt, T.BooleanType)
        if kind == "temporal":
            return isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType))
        raise ValueError(kind)
    return [f.name for f in df.schema.fields if ok(f.dataType) and f.name not in set(exclude)]


def select_type(df: DataFrame, kind: str = "numeric", exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*columns_of_type(df, kind, exclude))


def cast_columns(df: DataFrame, types: Mapping[str, str], lenient: bool = False) -> DataFrame:
    """Cast columns; ``lenient`` uses ``try_cast`` so dirty values become NULL."""
    out = []
    for c in df.columns:
        if c in types:
            out.append((F.col(c).try_cast(types[c]) if lenient else F.col(c).cast(types[c])).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def with_ordinal(df: DataFrame, col: str, levels: Sequence[str], out: str | None = None) -> DataFrame:
    """Ordered category -> 1-based rank (unknown/null -> NULL)."""
    return df.withColumn(out or f"{col}_rank", _ordinal_expr(col, levels))


def features_and_target(df: DataFrame, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """P5: features + target stay in one DataFrame (no X/y split in Spark);
    returns the columns with the target last."""
    feats = [c for c in df.columns if c != target and c not in keep]
    return df.select(*keep, *feats, target)


def common_columns(a: DataFrame, b: DataFrame, kind: str | None = None) -> list[str]:
    """Columns of ``a`` (optionally of one kind) also present in ``b``, in ``a``'s order."""
    names = columns_of_type(a, kind) if kind else a.columns
    other = set(b.columns)
    return [c for c in names if c in other]


def head(df: DataFrame, n: int = 5, by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows; with ``by`` a deterministic top-n (TakeOrderedAndProject)."""
    return (df.orderBy(*by) if by else df).limit(n)


def table_info(df: DataFrame) -> DataFrame:
    """``df.info()``: (position, column, dtype, non_null) in one aggregate pass."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    long = counts.unpivot([], [f"c{i}" for i in range(len(fields))], "pos", "non_null")
    meta = local_frame(df.sparkSession, [(f"c{i}", i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)],
                       "pos string, position int, column string, dtype string")
    return meta.join(F.broadcast(long), "pos").select("position", "column", "dtype",
                                                       F.col("non_null").cast("long").alias("non_null"))


def map_labels(df: DataFrame, col: str, mapping: Mapping, out: str | None = None, default=None) -> DataFrame:
    """Map codes to labels (e.g. 1 -> 'Paga a tiempo', 0 -> 'Mora')."""
    return df.withColumn(out or col, _label_map_expr(col, mapping, default))


def round_columns(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 4,
                  half_even: bool = True) -> DataFrame:
    """Round doubles; ``half_even`` matches Python/numpy rounding (``bround``)."""
    cols = set(cols if cols is not None else columns_of_type(df, "numeric"))
    fn = F.bround if half_even else F.round
    return df.select(*[fn(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P10: rename pivot / aggregate columns."""
    return df.withColumnsRenamed(dict(mapping))


def long_numeric(df: DataFrame, cols: Sequence[str] | None = None, ids: Sequence[str] = ()) -> DataFrame:
    """Long (ids..., variable, value) view of numeric columns; used by the profilers."""
    cols = list(cols) if cols is not None else columns_of_type(df, "numeric", exclude=ids)
    return unpivot_numeric(df, cols, ids)
