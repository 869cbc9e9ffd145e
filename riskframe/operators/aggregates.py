"""Descriptive aggregations.

Multi-column statistics are computed from one long (variable, value) Expand so
that a single shuffle by ``variable`` (plus the bucketed quantile selection)
serves every column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.projection import columns_of_type
from riskframe.operators.ranking import attach, exact_quantiles, local_frame, unpivot_numeric


def _keys_present(keys: Sequence[str]) -> F.Column:
    """All group keys non-null (pandas ``groupby`` drops null keys)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def pairwise_corr(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(var_a, var_b, corr): Pearson r of each pair over the rows where both are
    present (pandas' pairwise-complete ``corr``).

    A task keeps per pair the count, both means, both sums of squared deviations and the
    co-moment over the rows where both are present, each Arrow batch centred by the pair's own
    means, and adds batches by the merge formula for centred moments. It emits one row per pair;
    the rows of the tasks are merged by the same formula in the JVM. A mean is kept as an
    offset from a value of the pair, which keeps the digits that a large mean would lose. No sum of large
    squares is ever taken, so nothing cancels, wherever the values of a pair lie, and no pass
    for means comes first. A column that is constant over a pair's rows (its least and largest
    value there are equal) gives NaN, as in pandas (Spark's ``corr`` raises under
    ANSI there), and so does one with an infinite value there."""
    import numpy as np
    import pandas as pd

    names = sorted({c for p in pairs for c in p})
    idx = {c: i for i, c in enumerate(names)}
    wide = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    pi = np.array([idx[a] for a, _ in pairs], dtype=int)
    pj = np.array([idx[b] for _, b in pairs], dtype=int)
    of_j = {int(j): np.flatnonzero(pj == j) for j in np.unique(pj)}

    def centred(values, there, n, base):
        """(mean, deviations) of the offsets from ``base`` per column over the rows ``there``,
        the mean's own rounding taken out."""
        off = np.where(there, values - base, 0.0)
        mean = off.sum(axis=0) / n
        dev = np.where(there, off - mean, 0.0)
        rest = dev.sum(axis=0) / n
        return mean + rest, np.where(there, dev - rest, 0.0)

    def moments(batches):
        n, bx, by, mx, my, vx, vy, cxy = (np.zeros(len(pi)) for _ in range(8))
        lx, ly = np.full(len(pi), np.inf), np.full(len(pi), np.inf)
        hx, hy = -lx, -ly
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            if not len(x):
                continue
            m = ~np.isnan(x)
            for j, at in of_j.items():
                both = m[:, pi[at]] & m[:, j:j + 1]
                a, b = x[:, pi[at]], np.broadcast_to(x[:, j:j + 1], both.shape)
                new = both.sum(axis=0)
                fresh, first = (n[at] == 0) & (new > 0), both.argmax(axis=0)
                for base, v in ((bx, a), (by, b)):
                    base[at[fresh]] = v[first[fresh], np.flatnonzero(fresh)]
                with np.errstate(invalid="ignore"):
                    (ma, da), (mb, db) = (centred(v, both, np.maximum(new, 1), base[at]) for v, base in ((a, bx), (b, by)))
                    total = np.maximum(n[at] + new, 1)
                    dx, dy, w = ma - mx[at], mb - my[at], n[at] * new / total
                    vx[at] += (da * da).sum(axis=0) + dx * dx * w
                    vy[at] += (db * db).sum(axis=0) + dy * dy * w
                    cxy[at] += (da * db).sum(axis=0) + dx * dy * w
                    mx[at] += dx * new / total
                    my[at] += dy * new / total
                n[at] += new
                for low, high, v in ((lx, hx, a), (ly, hy, b)):
                    low[at] = np.minimum(low[at], np.where(both, v, np.inf).min(axis=0))
                    high[at] = np.maximum(high[at], np.where(both, v, -np.inf).max(axis=0))
        yield pd.DataFrame({"p": np.arange(len(pi)), "n": n, "bx": bx, "by": by, "mx": mx, "my": my, "vx": vx, "vy": vy, "cxy": cxy,
                            "lx": lx, "hx": hx, "ly": ly, "hy": hy})

    fields = ("n", "bx", "by", "mx", "my", "vx", "vy", "cxy")
    parts = wide.mapInPandas(moments, "p long, n double, bx double, by double, mx double, my double, vx double, vy double, cxy double, "
                             "lx double, hx double, ly double, hy double")

    def merge(a, b):
        total = F.greatest(a["n"] + b["n"], F.lit(1.0))
        base = {c: F.when(a["n"] == 0, b[c]).otherwise(a[c]) for c in ("bx", "by")}
        dx, dy = ((b[f"b{v}"] - base[f"b{v}"]) + (b[f"m{v}"] - a[f"m{v}"]) for v in "xy")
        w = a["n"] * b["n"] / total
        return F.struct((a["n"] + b["n"]).alias("n"), *[base[c].alias(c) for c in base], (a["mx"] + dx * b["n"] / total).alias("mx"),
                        (a["my"] + dy * b["n"] / total).alias("my"), (a["vx"] + b["vx"] + dx * dx * w).alias("vx"),
                        (a["vy"] + b["vy"] + dy * dy * w).alias("vy"), (a["cxy"] + b["cxy"] + dx * dy * w).alias("cxy"))

    # a pair has one row per task, merged in a fixed order
    g = parts.groupBy("p").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("tasks"),
                               *[F.min(c).alias(c) for c in ("lx", "ly")], *[F.max(c).alias(c) for c in ("hx", "hy")])
    g = g.withColumn("t", F.aggregate("tasks", F.struct(*[F.lit(0.0).alias(c) for c in fields]), merge))
    n, vx, vy, cxy = (F.col(f"t.{c}") for c in ("n", "vx", "vy", "cxy"))
    odd = F.isnan(vx) | F.isnan(vy) | F.isnan(cxy) | (vx <= 0) | (vy <= 0)
    r = (F.when(n < 2, F.lit(None).cast("double"))
         .when((F.col("lx") >= F.col("hx")) | (F.col("ly") >= F.col("hy")) | odd, F.lit(float("nan")))
         .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cxy / F.sqrt(vx * vy)))))
    names_tbl = local_frame(df.sparkSession, [(k, a, b) for k, (a, b) in enumerate(pairs)],
                            "p long, var_a string, var_b string")
    return names_tbl.join(g.select("p", r.alias("corr")), "p", "left").select("var_a", "var_b", "corr")


def _event(target: str, event) -> F.Column:
    return F.when(F.col(target) == event, 1.0).otherwise(0.0)


# ---------------------------------------------------------------- describe

def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None, group_by: Sequence[str] = ()) -> DataFrame:
    """A1 / A3: count, mean, std (sample), min, 25%, 50%, 75%, max per numeric
    column (and per group). Exact quantiles; not ``df.summary`` (approximate)."""
    keys = list(group_by)
    cols = list(cols) if cols is not None else columns_of_type(df, "numeric", exclude=keys)
    long = unpivot_numeric(df, cols, keys)
    if keys:
        long = long.where(_keys_present(keys))
    gk = keys + ["variable"]
    moments = long.groupBy(*gk).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    qs = exact_quantiles(long, gk, "value", [0.25, 0.5, 0.75])
    qwide = qs.groupBy(*gk).agg(*[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(n)
                                  for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return attach(moments, qwide, gk).select(*gk, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_by(df: DataFrame, key: str | Sequence[str], col: str) -> DataFrame:
    """A3: grouped describe of one column (``df.groupby(key)[col].describe()``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return describe_numeric(df, [col], keys).drop("variable")


def describe_categorical(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: count, unique, top, freq per string/categorical column.

    Ties for ``top`` go to the greatest value (deterministic)."""
    cols = list(cols) if cols is not None else columns_of_type(df, "string")
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = wide.unpivot([], cols, "variable", "value").where(F.col("value").isNotNull())
    vc = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct(F.col("n"), F.col("value")))
    return vc.groupBy("variable").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        best.getField("value").alias("top"), best.getField("n").alias("freq"))


def quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], group_by: Sequence[str] = (),
              approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """A4: (group..., variable, q, quantile). Exact by default (bucketed selection);
    ``approx`` uses ``percentile_approx`` (one pass, bounded memory)."""
    keys = list(group_by)
    long = unpivot_numeric(df, cols, keys)
    if not approx:
        return exact_quantiles(long, keys + ["variable"], "value", qs).drop("n")
    arr = F.percentile_approx("value", list(qs), accuracy)
    return (long.groupBy(*keys, "variable").agg(arr.alias("vals"))
            .select(*keys, "variable", F.posexplode("vals").alias("i", "quantile"))
            .select(*keys, "variable", F.element_at(F.array(*[F.lit(float(q)) for q in qs]),
                                                    F.col("i") + 1).alias("q"), "quantile"))


# ---------------------------------------------------------------- correlation

def corr_with(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """A5: Pearson correlation of each numeric column with ``target`` (pairwise complete)."""
    cols = list(cols) if cols is not None else columns_of_type(df, "numeric", exclude=[target])
    return pairwise_corr(df, [(c, target) for c in cols]).select(F.col("var_a").alias("variable"), "corr")


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Full Pearson matrix as (var_a, var_b, corr), pairwise complete, from the
    n(n+1)/2 distinct pairs in one pass; mirrored cells are a projection."""
    cols = list(cols) if cols is not None else columns_of_type(df, "numeric")
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i, len(cols))]
    half = pairwise_corr(df, pairs)
    a, b, r = F.col("var_a"), F.col("var_b"), F.col("corr")
    cells = F.when(a == b, F.array(F.struct(a.alias("var_a"), b.alias("var_b"), r.alias("corr")))).otherwise(
        F.array(F.struct(a.alias("var_a"), b.alias("var_b"), r.alias("corr")),
                F.struct(b.alias("var_a"), a.alias("var_b"), r.alias("corr"))))
    return half.select(F.inline(cells))


def redundant_pairs(df: DataFrame, cols: Sequence[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """Unordered pairs with |r| >= threshold (a before b in column order)."""
    cols = list(cols) if cols is not None else columns_of_type(df, "numeric")
    order = {c: i for i, c in enumerate(cols)}
    m = corr_matrix(df, cols)
    pos = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    return m.where((pos[F.col("var_a")] < pos[F.col("var_b")]) & (F.abs("corr") >= threshold))


def leakage_candidates(df: DataFrame, target: str, cols: Sequence[str] | None = None,
                       threshold: float = 0.9) -> DataFrame:
    """Columns whose |corr with target| exceeds ``threshold``."""
    return corr_with(df, target, cols).where(F.abs("corr") > threshold)


# ---------------------------------------------------------------- event rates

def count_pivot(df: DataFrame, key: str, target: str, levels: Sequence = (0, 1), prefix: str = "n_") -> DataFrame:
    """Counts by (key, target) with the target levels as columns (missing -> NULL)."""
    p = df.where(F.col(key).isNotNull()).groupBy(key).pivot(target, list(levels)).agg(F.count(F.lit(1)))
    return p.select(key, *[F.col(f"`{v}`").cast("long").alias(f"{prefix}{v}") for v in levels])


def event_rate(df: DataFrame, keys: Sequence[str], target: str, event=0) -> DataFrame:
    """Share of ``target == event`` x100 with counts; no keys = overall.
    Null keys are dropped, as pandas ``groupby`` does."""
    keys = list(keys)
    src = df.where(_keys_present(keys)) if keys else df
    return src.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(_event(target, event)).cast("long").alias("n_event"),
        (F.avg(_event(target, event)) * 100).alias("rate"))


def event_rate_pivot(df: DataFrame, row_key: str, col_key: str, col_levels: Sequence, target: str,
                     event=0) -> DataFrame:
    """A10: event rate x100 by two keys, the second unstacked over ``col_levels``
    (an absent cell is NULL, pandas' NaN)."""
    src = df.where(F.col(row_key).isNotNull())
    return src.groupBy(row_key).pivot(col_key, list(col_levels)).agg(F.avg(_event(target, event)) * 100)


def crosstab(df: DataFrame, a: str, b: str, b_levels: Sequence, prefix: str = "") -> DataFrame:
    """Absolute crosstab; zero-filled like ``pd.crosstab``; null a/b dropped."""
    p = (df.where(F.col(a).isNotNull()).groupBy(a).pivot(b, list(b_levels)).agg(F.count(F.lit(1))).na.fill(0))
    return p.select(a, *[F.col(f"`{v}`").cast("long").alias(f"{prefix}{v}") for v in b_levels])


def crosstab_pct(df: DataFrame, a: str, b: str, b_levels: Sequence, prefix: str = "pct_") -> DataFrame:
    """Row-percent crosstab: each cell / its row total x100 (same-row
    arithmetic on the pivot, no window)."""
    ct = crosstab(df, a, b, b_levels, prefix="__n_")
    total = sum((F.col(f"__n_{v}") for v in b_levels), F.lit(0))
    return ct.select(a, *[(F.col(f"__n_{v}") * 100.0 / total).alias(f"{prefix}{v}") for v in b_levels])


# ---------------------------------------------------------------- histograms and boxes

def histogram(df: DataFrame, cols: Sequence[str], bins: int = 40, by: str | None = None,
              fill_empty: bool = True) -> DataFrame:
    """Equal-width histogram(s) with numpy edges: ``bins`` bins between
    the column min and max, the max falling in the last bin.

    (variable, [by,] bin, bin_lo, bin_hi, count). The per-variable min/max table
    has one row per column (proven bound), so it is broadcast. Empty bins are
    filled from a generated grid of ``bins`` rows per variable (and class)."""
    ids = [by] if by else []
    long = unpivot_numeric(df, cols, ids)
    if by:
        long = long.where(F.col(by).isNotNull())
    rng = long.groupBy("variable").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    with_rng = attach(long, rng, ["variable"], broadcast=True)
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(bins // 2)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    counts = with_rng.groupBy("variable", *ids, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    if fill_empty:
        base = long.select("variable", *ids).distinct() if by else rng.select("variable")
        grid = base.select("variable", *ids, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        counts = grid.join(counts, ["variable", *ids, "bin"], "left").na.fill(0, ["count"])
    counts = attach(counts, rng, ["variable"], broadcast=True)
    # numpy edges: lo + i * (hi - lo) / bins; a constant column spans (v - 0.5, v + 0.5)
    flat = F.col("hi") == F.col("lo")
    edge = lambda i: F.when(flat, F.col("lo") - 0.5 + i / bins).otherwise(
        F.col("lo") + i * (F.col("hi") - F.col("lo")) / bins)
    return counts.select("variable", *ids, "bin", edge(F.col("bin")).alias("bin_lo"),
                         edge(F.col("bin") + 1).alias("bin_hi"), F.col("count").cast("long"))


def box_stats(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), whisker: float = 1.5) -> DataFrame:
    """Box-plot numbers per (keys, variable): q1, median, q3, whiskers at
    ``whisker`` x IQR (furthest data point inside the fence) and outlier count."""
    keys = list(keys)
    long = unpivot_numeric(df, cols, keys)
    if keys:
        long = long.where(_keys_present(keys))
    gk = keys + ["variable"]
    qs = exact_quantiles(long, gk, "value", [0.25, 0.5, 0.75])
    qw = qs.groupBy(*gk).agg(*[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(n)
                               for q, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    qw = (qw.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("fence_lo", F.col("q1") - whisker * F.col("iqr"))
          .withColumn("fence_hi", F.col("q3") + whisker * F.col("iqr")))
    v = F.col("value")
    inside = (v >= F.col("fence_lo")) & (v <= F.col("fence_hi"))
    # one row per (class, variable): proven bound
    stats = attach(long, qw.select(*gk, "fence_lo", "fence_hi"), gk, broadcast=True).groupBy(*gk).agg(
        F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("long").alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return attach(qw, stats, gk).select(*gk, "n", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi",
                                        "n_outliers")


# ---------------------------------------------------------------- class balance

def class_ratio(df: DataFrame, target: str, majority=1, minority=0) -> DataFrame:
    """(n_majority, n_minority, ratio = majority / minority rounded to 2)."""
    one = df.agg(F.sum(F.when(F.col(target) == majority, 1).otherwise(0)).cast("long").alias("n_majority"),
                 F.sum(F.when(F.col(target) == minority, 1).otherwise(0)).cast("long").alias("n_minority"))
    return one.withColumn("ratio", F.round(F.try_divide(F.col("n_majority"), F.col("n_minority")), 2))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """A18 table: balanced weight n / (k * n_c) per class (one row per class)."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n_c"))
    tot = counts.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))
    return attach(counts, tot).select(target, "n_c", (F.col("n") / (F.col("k") * F.col("n_c"))).alias("weight"))


def add_class_weight(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """Attach the balanced class weight to every row (join on the class; the
    weight table has one row per class value)."""
    w = class_weights(df, target).select(target, F.col("weight").alias(out))
    return attach(df, w, [target], broadcast=True)


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))
