"""Exact ranks, running totals and quantiles without single-task windows.

A window ``PARTITION BY class ORDER BY x`` puts a whole class (or, with no
partition, the whole table) into one task, and an exact ``percentile`` buffers
every distinct value of a group in one final task. Both break when one class
or one column holds a third of 100 TB. Everything here takes one path instead,
whatever the size:

1. a fixed ``asinh`` grid splits the order key of each group into order-preserving
   coarse buckets (NULL first and NaN last, as a window sorts them); one aggregate
   gives the count and range of each;
2. a coarse bucket is split, on its own range, into as many fine buckets as its
   count asks for (``ROWS_PER_BUCKET`` rows each);
3. counts per (group, bucket) become exclusive offsets (a window over that small
   table);
4. the per-row window runs only inside (group, bucket), and the bucket's offset is
   added.

Quantiles only look at the buckets that hold the wanted ranks, and there they
first collapse rows to (value, count), so a value repeated a billion times is
one row.

Count tables are computed once and written to the shared checkpoint folder, like an
estimator's ``fit``: their size is then known to the planner, which broadcasts the
small ones, and every final plan has a single reference of the input (a DataFrame
referenced twice is planned, and scanned, twice).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.exprs import col_of

# Rows that a fine bucket, and so a window task, is meant to hold.
ROWS_PER_BUCKET = 100_000
# Coarse buckets per unit of asinh(x): independent of the data, so no bounds pass.
L1_RES = 64

_TMP = "__rf_"


def local_frame(spark, rows, schema) -> DataFrame:
    """A DataFrame over driver-side rows as a true ``LocalRelation`` (via Arrow):
    the planner knows its size, so joins with it broadcast without a job.
    ``schema`` is a StructType or a DDL string; rows are tuples."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    st = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    names = st.fieldNames()
    arrow_schema = to_arrow_schema(st)
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    tbl = pa.Table.from_arrays([pa.array(list(c), type=arrow_schema.field(i).type) for i, c in enumerate(cols)],
                               schema=arrow_schema)
    return spark.createDataFrame(tbl, schema=st)


def materialize_small(df: DataFrame) -> DataFrame:
    """Compute a fitted table once: written to the shared checkpoint folder and read
    back, so that its size is known and the input is not planned again."""
    from riskframe.session import cut_lineage

    return cut_lineage(df)


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str] = (), broadcast: bool = False,
           how: str = "inner") -> DataFrame:
    """Attach per-group statistics to every row of ``df``.

    With no keys, ``stats`` is one row: it becomes a scalar subquery (one value,
    computed once, shipped with the plan), never a cross join. With keys it is an
    equi-join with null-safe key equality; ``broadcast`` is only set by callers
    whose ``stats`` has a proven size bound, otherwise AQE picks the strategy on
    the measured size.
    """
    keys = list(keys)
    value_cols = [c for c in stats.columns if c not in keys]
    if not keys:
        packed = stats.select(F.struct(*value_cols).alias("s")).scalar()
        return df.select("*", *[packed[c].alias(c) for c in value_cols])
    renamed = {k: f"{_TMP}k_{i}" for i, k in enumerate(keys)}
    right = stats.select(*[F.col(k).alias(v) for k, v in renamed.items()], *value_cols)
    if broadcast:
        right = F.broadcast(right)
    cond = [df[k].eqNullSafe(right[v]) for k, v in renamed.items()]
    return df.join(right, cond, how).drop(*renamed.values())


def attach_values(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Attach already-computed scalars (a fitted state) as literal columns."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in values.items()])


def _coarse(x: Column) -> Column:
    """Order-preserving coarse bucket, never null: NULL first, then -inf, finite values
    by ``asinh``, +inf, NaN last. ``asinh`` is odd here and finite for every double: it is
    taken of the size, where it is ``log(2x)`` to the last bit above 1e8 (Spark's own sums
    ``x`` and ``sqrt(x * x + 1)``, which cancels below zero and overflows above 1e154)."""
    inf = float("inf")
    size = F.abs(x)
    grid = F.when(size < 1e8, F.asinh(size)).otherwise(F.log(size) + math.log(2.0)) * L1_RES
    return (F.when(x.isNull(), F.lit(-(1 << 40))).when(F.isnan(x), F.lit(1 << 40))
            .when(x == inf, F.lit(1 << 39)).when(x == -inf, F.lit(-(1 << 39)))
            .otherwise(F.floor(F.when(x < 0, -grid).otherwise(grid)))).cast("long")


def _level1(df: DataFrame, keys: Sequence[str], lead, sums: dict[str, Column],
            known_range: tuple[float, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """One aggregate pass: per (group, coarse bucket) the row count ``__n1``, the range of
    ``lead`` and ``sums``, with exclusive offsets ``<sum>_off1``. A key with a known range
    (a hash) is one coarse bucket. Returns (rows with ``__x`` and ``__b1``, the table)."""
    rows = df.withColumn("__x", col_of(lead).cast("double"))
    if known_range is None:
        rows = rows.withColumn("__b1", _coarse(F.col("__x")))
        lo, hi = F.min("__x"), F.max("__x")
    else:
        rows = rows.withColumn("__b1", F.when(F.col("__x").isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long"))
        lo, hi = F.lit(float(known_range[0])), F.lit(float(known_range[1]))
    lvl = materialize_small(rows.groupBy(*keys, "__b1").agg(
        F.count(F.lit(1)).alias("__n1"), lo.alias("__lo1"), hi.alias("__hi1"),
        *[agg.alias(name) for name, agg in sums.items()]))
    w = Window.partitionBy(*keys).orderBy("__b1").rowsBetween(Window.unboundedPreceding, -1)
    return rows, lvl.select("*", *[F.coalesce(F.sum(n).over(w), F.lit(0)).alias(f"{n}_off1") for n in sums])


def _level2(rows: DataFrame, lvl: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the coarse bucket's columns and the fine bucket ``__b2``: as many equal parts
    of the coarse bucket's range as its row count asks for."""
    j = attach(rows, lvl, list(keys) + ["__b1"])
    x, lo, hi = F.col("__x"), F.col("__lo1"), F.col("__hi1")
    parts = F.ceil(F.col("__n1") / ROWS_PER_BUCKET)
    fine = F.when((hi > lo) & (hi - lo < float("inf")) & ~F.isnan(x),
                  F.least(F.floor((x - lo) / (hi - lo) * parts), parts - 1)).otherwise(F.lit(0))
    return j.withColumn("__b2", F.coalesce(fine, F.lit(0)).cast("long"))


def _buckets(df: DataFrame, keys: Sequence[str], lead, sums: dict[str, Column],
             known_range: tuple[float, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with ``__b1``, ``__b2``; table of ``sums`` per (group, bucket) with exclusive
    offsets ``<sum>_off``)."""
    rows, lvl = _level1(df, keys, lead, {}, known_range)
    fine = _level2(rows, lvl, keys).drop("__n1", "__lo1", "__hi1", "__x")
    b = [*keys, "__b1", "__b2"]
    table = materialize_small(fine.groupBy(*b).agg(*[agg.alias(name) for name, agg in sums.items()]))
    w = Window.partitionBy(*keys).orderBy("__b1", "__b2").rowsBetween(Window.unboundedPreceding, -1)
    return fine, table.select("*", *[F.coalesce(F.sum(n).over(w), F.lit(0)).alias(f"{n}_off") for n in sums])


def with_row_rank(df: DataFrame, partition_by: Sequence[str], order_by: Sequence, rank_col: str = "row_rank",
                  known_range: tuple[float, float] | None = None) -> DataFrame:
    """Add the exact 0-based ``row_number() - 1`` over ``(PARTITION BY partition_by
    ORDER BY order_by)``. The first ``order_by`` column must be numeric and
    ascending; the rest break ties."""
    keys = list(partition_by)
    order = [col_of(c) for c in order_by]
    n = f"{_TMP}n"
    rows, table = _buckets(df, keys, order[0], {n: F.count(F.lit(1))}, known_range)
    local = rows.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys, "__b1", "__b2").orderBy(*order)) - 1)
    joined = attach(local, table.drop(n), [*keys, "__b1", "__b2"])
    return joined.withColumn(rank_col, (F.col(rank_col) + F.col(f"{n}_off")).cast("long")).drop("__b1", "__b2", f"{n}_off")


def rank_below(df: DataFrame, partition_by: Sequence[str], order_by: Sequence, cuts,
               out: str = "cut_idx", known_range: tuple[float, float] | None = None) -> DataFrame:
    """For every row, the smallest ``cut_idx`` whose ``k`` exceeds the row's exact
    0-based rank in ``(PARTITION BY partition_by ORDER BY order_by)``; NULL when
    the rank is at or above every cut. ``cuts`` is a small table
    (partition_by..., cut_idx int, k long), or a function that builds it from the
    exact group sizes (a (partition_by..., n) table): the sizes come out of the
    bucket counts, so sizing the cuts costs no extra pass.

    This answers "is the row among the first k" without ranking every row:
    bucket counts are aggregated map-side, rows in buckets wholly below or above
    every cut are decided by a lookup of their bucket, and only rows in the few
    buckets that straddle a cut are windowed. A split, a sample or 50 shuffle
    splits of a 100 TB table therefore window only the boundary buckets.
    """
    g = f"{_TMP}g"
    keys = list(partition_by) or [g]          # the whole table is one group
    if not partition_by:
        df = df.withColumn(g, F.lit(0))
    order = [col_of(c) for c in order_by]
    n, off = f"{_TMP}n", f"{_TMP}n_off"
    b = [*keys, "__b1", "__b2"]
    bucketed, table = _buckets(df, keys, order[0], {n: F.count(F.lit(1))}, known_range)
    if callable(cuts):
        sizes = table.groupBy(*keys).agg(F.sum(n).alias("n"))
        cuts = cuts(sizes.drop(g) if not partition_by else sizes)
    if not partition_by:
        cuts = cuts.withColumn(g, F.lit(0))
    bk = attach(table, cuts, keys)
    full = F.col(off) + F.col(n) <= F.col("k")
    partial = (F.col(off) < F.col("k")) & (F.col("k") < F.col(off) + F.col(n))
    per_bucket = materialize_small(bk.groupBy(*b).agg(
        F.min(F.when(full, F.col("cut_idx"))).alias(f"{_TMP}full"),
        F.filter(F.collect_list(F.when(partial, F.struct(F.col("cut_idx"), (F.col("k") - F.col(off)).alias("lk")))),
                 lambda x: x.isNotNull()).alias(f"{_TMP}part")))
    rows = attach(bucketed, per_bucket, b, how="left")
    straddle = F.coalesce(F.size(f"{_TMP}part"), F.lit(0)) > 0
    clear = rows.where(~straddle).withColumn(out, F.col(f"{_TMP}full"))
    lr = f"{_TMP}lr"
    edge = rows.where(straddle).withColumn(lr, F.row_number().over(Window.partitionBy(*b).orderBy(*order)) - 1)
    hit = F.filter(f"{_TMP}part", lambda c: F.col(lr) < c["lk"])
    edge = edge.withColumn(out, F.least(F.col(f"{_TMP}full"),
                                        F.array_min(F.transform(hit, lambda c: c["cut_idx"])))).drop(lr)
    res = clear.unionByName(edge).drop("__b1", "__b2", f"{_TMP}full", f"{_TMP}part")
    return res.drop(g) if not partition_by else res


def running_totals(df: DataFrame, partition_by: Sequence[str], order_col: str, sum_cols: Sequence[str],
                   prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``sum_cols`` within each group in ``order_col``
    order (``order_col`` is expected to be unique within the group, e.g. after a
    ``groupBy(score)``). Rows are windowed only inside (group, bucket); what lies
    before comes from the small offset table. Rows without an order are left out."""
    keys = list(partition_by)
    sums = {f"{_TMP}s{i}": F.sum(c) for i, c in enumerate(sum_cols)}
    rows, table = _buckets(df.where(F.col(order_col).isNotNull()), keys, order_col, sums)
    w = Window.partitionBy(*keys, "__b1", "__b2").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select("*", *[F.sum(c).over(w).alias(f"{_TMP}l{i}") for i, c in enumerate(sum_cols)])
    joined = attach(local, table.drop(*sums), [*keys, "__b1", "__b2"])
    out = joined.select("*", *[(F.col(f"{_TMP}l{i}") + F.col(f"{_TMP}s{i}_off")).alias(f"{prefix}{c}")
                               for i, c in enumerate(sum_cols)])
    return out.drop("__b1", "__b2", *[f"{n}_off" for n in sums], *[f"{_TMP}l{i}" for i in range(len(sum_cols))])


def unpivot_numeric(df: DataFrame, value_cols: Sequence[str], id_cols: Sequence[str] = (),
                    var: str = "variable", val: str = "value", drop_missing: bool = True) -> DataFrame:
    """Long format (ids..., variable, value double) in one narrow Expand; NaN -> NULL."""
    ids = list(id_cols)
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in value_cols])
    long = wide.unpivot(ids, list(value_cols), var, val)
    long = long.withColumn(val, F.when(~F.isnan(val), F.col(val)))
    return long.where(F.col(val).isNotNull()) if drop_missing else long


def exact_quantiles(long: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas ``quantile``, Spark
    ``percentile``, DuckDB ``quantile_cont``) of ``value`` per group of ``keys``.

    Returns (keys..., q double, quantile double, n long). Nulls must already be
    removed. One aggregate pass locates the coarse bucket of every wanted rank;
    the final plan reads only those buckets, collapses their rows to (value,
    count) -- a value repeated a billion times is one row -- and walks them in
    fine buckets, so neither a hot value nor a narrow band is one task.
    """
    keys = list(keys)
    cnt = f"{_TMP}c"
    rows, lvl = _level1(long, keys, value, {cnt: F.count(F.lit(1))})
    sizes = lvl.groupBy(*keys).agg(F.sum(cnt).alias("n"))
    q_arr = F.array(*[F.lit(float(q)) for q in qs])
    targets = (sizes.select(*keys, "n", F.explode(q_arr).alias("q"))
               .withColumn("pos", (F.col("n") - 1) * F.col("q"))
               .withColumn("r_lo", F.floor("pos").cast("long"))
               .withColumn("r_hi", F.ceil("pos").cast("long"))
               .withColumn("frac", F.col("pos") - F.col("r_lo")))
    ranks = targets.select(*keys, "q", F.explode(F.array_distinct(F.array("r_lo", "r_hi"))).alias("r"))
    off1 = F.col(f"{cnt}_off1")
    located = (attach(ranks, lvl, keys)
               .where((F.col("r") >= off1) & (F.col("r") < off1 + F.col(cnt)))
               .select(*keys, "q", "r", "__b1"))
    needed = materialize_small(located)
    hit = _semi(rows, needed.select(*keys, "__b1").distinct(), keys + ["__b1"])
    r2 = _level2(hit, lvl.drop(cnt), keys)
    dv = r2.groupBy(*keys, "__b1", f"{cnt}_off1", "__b2", value).agg(F.count(F.lit(1)).alias("c"))
    sub = dv.groupBy(*keys, "__b1", "__b2").agg(F.sum("c").alias("sc"))
    w_sub = Window.partitionBy(*keys, "__b1").orderBy("__b2").rowsBetween(Window.unboundedPreceding, -1)
    sub = sub.select(*keys, "__b1", "__b2", F.coalesce(F.sum("sc").over(w_sub), F.lit(0)).alias("off2"))
    w = Window.partitionBy(*keys, "__b1", "__b2").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    dv = attach(dv.withColumn("hi_r", F.sum("c").over(w)), sub, keys + ["__b1", "__b2"])
    base = F.col(f"{cnt}_off1") + F.col("off2")
    dv = dv.withColumn("lo_abs", base + F.col("hi_r") - F.col("c")).withColumn("hi_abs", base + F.col("hi_r"))
    picked = attach(dv, needed, keys + ["__b1"]).where(
        (F.col("r") >= F.col("lo_abs")) & (F.col("r") < F.col("hi_abs")))
    vals = picked.groupBy(*keys, "q").agg(F.map_from_entries(F.collect_list(F.struct("r", value))).alias("m"))
    res = attach(targets, vals, keys + ["q"])
    lo_v, hi_v = F.element_at("m", F.col("r_lo")), F.element_at("m", F.col("r_hi"))
    return res.select(*keys, "q", (lo_v + (hi_v - lo_v) * F.col("frac")).alias("quantile"), "n")


def _semi(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose (non-null) keys appear in ``small``."""
    return df.join(small, list(keys), "left_semi")


def quantile_table(df: DataFrame, cols: Sequence[str], qs: Sequence[float], group_by: Sequence[str] = ()) -> DataFrame:
    """Long table (group..., variable, q, quantile, n) for several columns in one plan."""
    long = unpivot_numeric(df, cols, group_by)
    return exact_quantiles(long, list(group_by) + ["variable"], "value", qs)


def quantile_values(df: DataFrame, cols: Sequence[str], q: float) -> dict:
    """Fit-style: the exact ``q`` quantile of each column as Python floats
    (None for an all-null column)."""
    t = quantile_table(df, cols, [q]).select("variable", "quantile").collect()
    got = {r["variable"]: r["quantile"] for r in t}
    return {c: got.get(c) for c in cols}


def quantile_row(df: DataFrame, cols: Sequence[str], q: float, prefix: str = "") -> DataFrame:
    """One-row DataFrame ``{prefix}{col}`` = exact quantile ``q`` of each column,
    computed now (a fitted state) and held as a local relation."""
    vals = quantile_values(df, cols, q)
    schema = ", ".join(f"`{prefix}{c}` double" for c in cols)
    return local_frame(df.sparkSession, [tuple(vals[c] for c in cols)], schema)
