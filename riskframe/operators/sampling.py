"""Splits, folds, samples and resampling.

Every split is decided by an exact rank in a seeded pseudo-random order
(``order`` column, default xxhash64 of the key and seed). Ranks come from
:func:`riskframe.operators.ranking.with_row_rank`, so a class holding most of
the rows is still spread over many tasks. Sizes are exact, membership is
repeatable, and nothing is sampled approximately.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.exprs import col_of, hash_order, md5_order
from riskframe.operators.ranking import attach, materialize_small, rank_below, with_row_rank

HASH_RANGE = (-9.223372036854776e18, 9.223372036854776e18)
MD5_RANGE = (0.0, 4294967296.0)


def _order(df: DataFrame, key: str, seed: int, order: Column | str | None, name: str) -> tuple[DataFrame, tuple | None]:
    if order is None:
        return df.withColumn(name, hash_order(key, seed)), HASH_RANGE
    if isinstance(order, str) and order == "md5":
        return df.withColumn(name, md5_order(key, seed)), MD5_RANGE
    return df.withColumn(name, col_of(order)), None


def stratified_split(df: DataFrame, target: str, key: str, test_size: float = 0.2, seed: int = 42,
                     order: Column | str | None = None, out: str = "split") -> DataFrame:
    """Exact stratified train/test split. In each class the ``round(n_c *
    test_size)`` rows first in the seeded order are ``test``; the rest ``train``.
    Decided by :func:`rank_below`: only rows in the one boundary bucket of each
    class are windowed; the rest of the table is never shuffled."""
    o = "__ord"
    df, rng = _order(df, key, seed, order, o)
    def cuts(sizes):       # per class: the first round(n_c * test_size) rows
        return sizes.select(target, F.lit(0).alias("cut_idx"), F.round(F.col("n") * test_size).cast("long").alias("k"))
    flagged = rank_below(df, [target], [o, key], cuts, "__c", rng)
    return flagged.withColumn(out, F.when(F.col("__c") == 0, "test").otherwise("train")).drop(o, "__c")


def sample_n(df: DataFrame, key: str, frac: float = 0.1, floor: int = 50, seed: int = 42,
             order: Column | str | None = None) -> DataFrame:
    """R2: fixed-size random sample of ``max(floor, int(n * frac))`` rows, capped
    at ``n`` (the original fails when the table is smaller than the floor)."""
    o = "__ord"
    df, rng = _order(df, key, seed, order, o)
    def cuts(sizes):       # m = min(n, max(floor, int(n * frac)))
        m = F.least(F.col("n"), F.greatest(F.lit(floor).cast("long"), F.floor(F.col("n") * frac).cast("long")))
        return sizes.select(F.lit(0).alias("cut_idx"), m.cast("long").alias("k"))
    return rank_below(df, [], [o, key], cuts, "__c", rng).where(F.col("__c") == 0).drop(o, "__c")


def kfold(df: DataFrame, order_by: Sequence[str], k: int = 10, out: str = "fold") -> DataFrame:
    """Contiguous, unshuffled k folds in ``order_by`` order; the first
    ``n % k`` folds get one extra row (sklearn ``KFold``). Fold ``i`` holds the
    ranks below the cumulative size of folds 0..i, so the fold is a
    :func:`rank_below` cut index (no global window, no full shuffle)."""
    def cuts(sizes):       # cumulative fold sizes: the first n % k folds get q + 1 rows
        n_, q, rem = F.col("n"), F.floor(F.col("n") / k), F.col("n") % k
        return sizes.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cut_idx"), n_, q, rem).select(
            "cut_idx", ((F.col("cut_idx") + 1) * q + F.least(F.col("cut_idx") + 1, rem)).cast("long").alias("k"))
    return rank_below(df, [], list(order_by), cuts, out).withColumn(out, F.col(out).cast("int"))


def stratified_kfold(df: DataFrame, target: str, key: str, k: int = 5, seed: int = 42,
                     order: Column | str | None = None, out: str = "fold") -> DataFrame:
    """Shuffled stratified k folds. Row ``r`` of class ``c`` (seeded order)
    goes to fold ``(start_c + r) % k`` where ``start_c`` counts the rows of the
    smaller classes: the per-fold class counts equal sklearn's allocation."""
    o = "__ord"
    df, rng = _order(df, key, seed, order, o)
    ranked = with_row_rank(df, [target], [o, key], "__r", rng)
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.withColumn(
        "__start", F.coalesce(F.sum("__n").over(Window.orderBy(target).rowsBetween(Window.unboundedPreceding, -1)),
                              F.lit(0))).drop("__n")   # one row per class: a tiny window
    out_df = attach(ranked, starts, [target], broadcast=True)   # one row per class: proven bound
    return out_df.withColumn(out, F.pmod(F.col("__start") + F.col("__r"), F.lit(k)).cast("int")).drop(
        o, "__r", "__start")


@dataclass(frozen=True)
class _SplitOrder:
    """The order values of a row in the splits: ``lead`` is what they share (made once per row),
    ``value(lead, split)`` the value in a split, ``number(value)`` its place in ``span`` and
    ``bound(x)`` the smallest value at or above the number ``x``."""

    lead: Column
    value: Callable[[Column, Column], Column]
    number: Callable[[Column], Column]
    bound: Callable[[float], object]
    span: tuple[float, float]


def _split_order(key: str, seed: int, order: str) -> _SplitOrder:
    if order == "md5":         # the eight hex digits themselves: they sort as the number of md5_order does
        return _SplitOrder(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))),
                           lambda lead, split: F.substring(F.md5(F.concat_ws("|", lead, split.cast("string"))), 1, 8),
                           lambda v: F.conv(v, 16, 10).cast("long"), lambda x: f"{min(max(math.ceil(x), 0), 2 ** 32 - 1):08x}", MD5_RANGE)
    return _SplitOrder(F.col(key), lambda lead, split: F.xxhash64(lead, F.lit(seed), split.cast("int")), lambda v: v,
                       lambda x: min(max(math.ceil(x), -2 ** 63), 2 ** 63 - 1), HASH_RANGE)


def _split_ids(n_splits: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n_splits - 1))


#: Half the width of the range that a rank is looked for in, in standard deviations of its place.
RANK_SIGMAS = 6.0


def _near_ranks(ranks: Sequence[int], n: int, order: _SplitOrder) -> list:
    """Ascending order values: between the 1st and the 2nd, the 3rd and the 4th, ... the ranks
    are expected, as far as order values are spread evenly."""
    lo, hi = order.span
    spans = []
    for k in sorted(ranks):
        u = (k + 0.5) / n
        half = RANK_SIGMAS * math.sqrt(u * (1 - u) / n) + 2.0 / n
        if spans and u - half <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], u + half)
        else:
            spans.append([u - half, u + half])
    return [order.bound(lo + x * (hi - lo)) for span in spans for x in span]


def split_bounds(df: DataFrame, key: str, n_splits: int, order: _SplitOrder, ranks: Sequence[int], n: int) -> DataFrame:
    """Per split (``__s``) the order value ``__o<i>`` and the key ``__k<i>`` of the row at the
    i-th of ``ranks`` (0-based, below ``n``): ``n_splits * len(ranks)`` values, whatever the
    size of the table.

    One pass: rows between the ranges of :func:`_near_ranks` are only counted, those inside (some
    multiples of ``sqrt(n)`` a split) come out with their order value and are walked. If a
    rank lies in no range, as many rows of one key can bring about, it is looked for in buckets."""
    rows = df.select(key, order.lead.alias("__lead")).select(key, "__lead", F.explode(_split_ids(n_splits)).alias("__s")).select(
        key, "__s", order.value(F.col("__lead"), F.col("__s")).alias("__o"))
    edges = _near_ranks(ranks, n, order)
    place = F.lit(0)
    for e in edges:
        place = place + (F.col("__o") >= F.lit(e)).cast("int")
    inside = F.col("__p") % 2 == 1
    seen = rows.withColumn("__p", place).select("__s", "__p", F.when(inside, F.col("__o")).alias("__o"),
                                                F.when(inside, F.col(key)).alias(key))
    table = materialize_small(seen.groupBy("__s", "__p", "__o", key).agg(F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy("__s").orderBy("__p", "__o", key).rowsBetween(Window.unboundedPreceding, -1)
    walked = table.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    holds = lambda k: (F.col("__off") <= k) & (k < F.col("__off") + F.col("__n"))       # noqa: E731
    found = materialize_small(walked.groupBy("__s").agg(
        *[e for i, k in enumerate(ranks) for e in (F.max(F.when(holds(k), F.col("__o"))).alias(f"__o{i}"),
                                                   F.first(F.when(holds(k), F.struct(key)), ignorenulls=True)[key].alias(f"__k{i}"))]))
    missed = F.lit(False)
    for i in range(len(ranks)):
        missed = missed | F.col(f"__o{i}").isNull()
    return found if found.where(missed).isEmpty() else _bounds_by_buckets(rows, key, order, ranks, n)


def _bounds_by_buckets(rows: DataFrame, key: str, order: _SplitOrder, ranks: Sequence[int], n: int) -> DataFrame:
    """:func:`split_bounds` for order values of any spread, of ``rows`` (key, ``__s``, ``__o``).

    One aggregate counts rows per (split, bucket) in about ``sqrt(n)`` equal buckets of the
    known range; only the buckets that hold a wanted rank are read again and windowed, each
    of about ``sqrt(n)`` rows. Buckets and window tasks so grow alike."""
    parts = math.isqrt(n) + 1
    lo, hi = order.span
    place = F.floor((order.number(F.col("__o")).cast("double") - lo) / (hi - lo) * parts)
    rows = rows.withColumn("__b", F.least(place, F.lit(parts - 1)).cast("long"))
    table = materialize_small(rows.groupBy("__s", "__b").agg(F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)   # buckets, not rows
    off = table.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    holds = F.filter(F.array(*[F.lit(k).cast("long") for k in ranks]),
                     lambda k: (k >= F.col("__off")) & (k < F.col("__off") + F.col("__n")))
    wanted = off.select(F.col("__s").alias("__s2"), F.col("__b").alias("__b2"), "__off", holds.alias("__ks")).where(
        F.size("__ks") > 0)
    # at most splits x ranks buckets hold a wanted rank: a proven bound
    near = rows.join(F.broadcast(wanted), (F.col("__s") == F.col("__s2")) & (F.col("__b") == F.col("__b2")))
    pos = F.row_number().over(Window.partitionBy("__s", "__b").orderBy("__o", key)) - 1 + F.col("__off")
    found = near.withColumn("__r", pos.cast("long")).where(F.array_contains("__ks", F.col("__r")))
    at = lambda k, c: F.first(F.when(F.col("__r") == k, F.col(c)), ignorenulls=True)
    return materialize_small(found.groupBy("__s").agg(
        *[e for i, k in enumerate(ranks) for e in (at(k, "__o").alias(f"__o{i}"), at(k, key).alias(f"__k{i}"))]))


def _passed(o: Column, key: Column, bound, n_bounds: int) -> Column:
    """How many bounds the row (order value ``o``, ``key``) has reached; a null key comes first."""
    total = F.lit(0)
    for i in range(n_bounds):
        bo, bk = bound(f"__o{i}"), bound(f"__k{i}")
        total = total + ((o > bo) | ((o == bo) & F.coalesce(key >= bk, bk.isNull()))).cast("int")
    return total


def _split_cuts(df, key, n_splits, test_size, seed, order, fractions):
    """(order, bounds per split, number of bounds, training sizes) of the splits of ``df``."""
    n = df.count()
    n_test = math.ceil(n * test_size)
    sizes = train_size_grid(n - n_test, fractions)
    ranks = [k for k in [n_test, *[n_test + m for m in sizes]] if k < n]     # a rank of n has no row
    by = _split_order(key, seed, order)
    bounds = split_bounds(df, key, n_splits, by, ranks, n) if ranks else None
    return by, bounds, len(ranks), sizes


def split_members(df: DataFrame, key: str, n_splits: int = 50, test_size: float = 0.2, seed: int = 123,
                  order: str = "md5", train_fractions: Sequence[float] = (), out: str = "member") -> DataFrame:
    """R5 and R6 without a row per split: ``out`` is an array with one number per split, 0
    for a test row and ``i + 1`` for a training row whose smallest nested training subset is
    ``i`` (``len(train_size_grid)`` or more: in no subset).

    A row compares its own order values with the bounds of :func:`split_bounds`, one row of
    ``n_splits`` structs: rows are neither expanded nor shuffled."""
    by, bounds, m, _ = _split_cuts(df, key, n_splits, test_size, seed, order, train_fractions)
    if bounds is None:
        return df.withColumn(out, F.transform(_split_ids(n_splits), lambda s: F.lit(0)))
    one = bounds.agg(F.array_sort(F.collect_list(F.struct("__s", *[c for c in bounds.columns if c != "__s"]))).alias("b"))
    packed = attach(df.withColumn("__lead", by.lead), one.withColumnRenamed("b", "__bounds"))
    orders = F.transform(_split_ids(n_splits), lambda s: by.value(F.col("__lead"), s))
    return packed.withColumn(out, F.zip_with(
        orders, "__bounds", lambda o, b: _passed(o, F.col(key), lambda c: b[c], m))).drop("__bounds", "__lead")


def shuffle_splits(df: DataFrame, key: str, n_splits: int = 50, test_size: float = 0.2, seed: int = 123,
                   order: str = "md5", train_fractions: Sequence[float] | None = None) -> DataFrame:
    """R5 (+ R6): ``n_splits`` independent random train/test splits (sklearn
    ``ShuffleSplit``: ``ceil(test_size * n)`` test rows). One row per (split,
    input row) with ``role``; with ``train_fractions``, ``size_idx`` is the
    smallest nested training subset holding the row (the first
    ``int(frac * n_train)`` training rows of that split's permutation).

    The split ids are generated in each task; a row compares its order value with the
    bounds of its split (:func:`split_bounds`, a row per split), so the expanded rows are
    never shuffled."""
    fracs = list(train_fractions or [])
    by, bounds, m, sizes = _split_cuts(df, key, n_splits, test_size, seed, order, fracs)
    ex = df.withColumn("__lead", by.lead).withColumn("split_id", F.explode(_split_ids(n_splits)))
    if bounds is None:
        flagged = ex.withColumn("__c", F.lit(0))
    else:
        cuts = F.broadcast(bounds.withColumnRenamed("__s", "split_id"))        # a row per split: proven bound
        flagged = ex.withColumn("__o", by.value(F.col("__lead"), F.col("split_id"))).join(cuts, "split_id").withColumn(
            "__c", _passed(F.col("__o"), F.col(key), F.col, m))
    out = flagged.select(*df.columns, "split_id", F.when(F.col("__c") == 0, "test").otherwise("train").alias("role"), "__c")
    if fracs:
        out = out.withColumn("size_idx", F.when(F.col("__c").between(1, len(sizes)), F.col("__c") - 1))
    return out.drop("__c")


def train_size_grid(n_train: int, fractions: Sequence[float]) -> list[int]:
    """R6 sizes: ``int(frac * n_train)`` per fraction, de-duplicated (sklearn)."""
    sizes = sorted({int(f * n_train) for f in fractions})
    return [s for s in sizes if s > 0]


#: Points of a cell: least, and most where they can be told apart; cells wanted between the two.
KNN_CELL, KNN_CELL_MOST, KNN_CELLS = 2_000, 50_000, 64
#: Points a cell that the splits of the cells are learnt from; queries that a task compares with a cell at once.
KNN_SAMPLE, KNN_ASKED = 32, 200_000
#: Points of a block inside a task, and points that give a block of queries its first bounds.
KNN_BLOCK, KNN_FIRST = 256, 1_024
#: Room for rounding where a least distance is held against a bound.
KNN_ROOM = 1 + 1e-9
#: Pairs of a query and a point whose distances are held at once.
KNN_PAIRS = 2_000_000


def nearest_of_block(queries, names, x, keys, k: int, within):
    """:func:`_nearest` with the name of the query in place of its number."""
    who, nb, d = _nearest(queries, names, x, keys, k, within)
    return names[who], nb, d


def _nearest(queries, names, x, keys, k: int, within):
    """The k points nearest to each query, among the points ``x`` (named ``keys``), as arrays (number
    of the query, point key, distance); a point of the query's own name is left out, and ties go to
    the smaller key. Points farther from a query than its ``within`` may be left out.

    A matrix product gives all squared distances but for rounding. What they rule out, with
    room for that rounding, is dropped; the few points left are measured term by term, so
    distances and ties are those of the plain formula."""
    import numpy as np

    by_key = np.argsort(keys, kind="stable")
    x, keys = x[by_key], keys[by_key]
    rows, nbs, ds = [np.zeros(0, dtype=np.int64)], [keys[:0]], [np.zeros(0)]
    with np.errstate(over="ignore", invalid="ignore"):
        there = np.isfinite(x).all(axis=1)
        mid = x[there].mean(axis=0) if there.any() else np.zeros(x.shape[1])
        centred = x - mid
        size = (centred ** 2).sum(axis=1)
        right = np.column_stack([centred, size, np.ones(len(x))]).T.copy()
        largest = np.max(size[there], initial=0.0)
        step = max(1, KNN_PAIRS // max(1, len(x)))
        for lo in range(0, len(queries), step):
            q, name = queries[lo:lo + step], names[lo:lo + step]
            qc = q - mid
            qq = (qc ** 2).sum(axis=1)
            near = np.column_stack([-2.0 * qc, np.ones(len(q)), qq]) @ right
            room = 1e-13 * (x.shape[1] + 4) * (qq + largest)     # far above the rounding of either formula
            limit = within[lo:lo + step] ** 2 * (1 + 1e-9) + room
            open_ = ~(limit < np.inf)                            # without a bound: that of the k nearest here
            if open_.any() and k < len(x):
                some = near[open_]
                some[name[open_][:, None] == keys[None, :]] = np.inf
                some[np.isnan(some)] = np.inf
                limit[open_] = np.partition(some, k - 1, axis=1)[:, k - 1] + 2 * room[open_]
            i, j = np.nonzero(~(near > limit[:, None]))          # what is not a number is measured too
            for at in range(0, len(i), KNN_PAIRS):
                a, b = i[at:at + KNN_PAIRS], j[at:at + KNN_PAIRS]
                d = np.sqrt(((q[a] - x[b]) ** 2).sum(axis=1))
                ok = np.isfinite(d) & (name[a] != keys[b])
                a, b, d = a[ok], b[ok], d[ok]
                take = np.lexsort((b, d, a))                     # points are in key order
                a, b, d = a[take], b[take], d[take]
                place = np.arange(len(a)) - np.searchsorted(a, a, side="left")
                first = place < k
                rows.append(lo + a[first])
                nbs.append(keys[b[first]])
                ds.append(d[first])
    return np.concatenate(rows), np.concatenate(nbs), np.concatenate(ds)


def _halve(x):
    """A split ``(feature, cut)`` of points, left up to the cut, at the median of the feature that varies
    most; None if all points are the same."""
    import numpy as np

    with np.errstate(over="ignore", invalid="ignore"):
        spread = np.nan_to_num(x.var(axis=0), nan=np.inf)
    for j in np.argsort(-spread, kind="stable").tolist():
        v = x[:, j]
        low, high = v.min(), v.max()
        if low < high:
            at = np.partition(v, (len(v) - 1) // 2)[(len(v) - 1) // 2]
            return j, float(at if at < high else v[v < high].max())
    return None


def _blocks(x, most: int) -> list:
    """Places of points near each other, at most ``most`` in a block unless they are all the same."""
    import numpy as np

    out, todo = [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        cut = _halve(x[at]) if len(at) > most else None
        if cut is None:
            out.extend(at[i:i + most] for i in range(0, len(at), most))
            continue
        left = x[at, cut[0]] <= cut[1]
        todo += [at[~left], at[left]]
    return out


def _cell_tree(x, cells: int) -> list:
    """Splits ``(feature, cut, left, right)`` of about so many cells of as many points each; a place below
    zero is the cell ``-1 - place``."""
    tree, n = [], 0

    def grow(part, wanted):
        nonlocal n
        cut = _halve(part) if wanted > 1 and len(part) > 1 else None
        if cut is None:
            n += 1
            return -n
        tree.append(None)
        place, left = len(tree) - 1, part[:, cut[0]] <= cut[1]
        tree[place] = (*cut, grow(part[left], wanted - wanted // 2), grow(part[~left], wanted // 2))
        return place

    grow(x, cells)
    return tree


def _cell_of(x, tree: list):
    """The cell of each point."""
    import numpy as np

    out, todo = np.zeros(len(x), dtype=np.int32), [(0, np.arange(len(x)))] if tree else []
    while todo:
        place, at = todo.pop()
        if place < 0:
            out[at] = -1 - place
        elif len(at):
            j, cut, low, high = tree[place]
            left = x[at, j] <= cut
            todo += [(low, at[left]), (high, at[~left])]
    return out


def _to_boxes(x, low, high):
    """(points, boxes) least distance of each point to each box, a feature at a time."""
    import numpy as np

    total = np.zeros((len(x), len(low)))
    with np.errstate(over="ignore", invalid="ignore"):
        for j in range(x.shape[1]):
            v = x[:, j, None]
            total += np.maximum(np.maximum(low[None, :, j] - v, v - high[None, :, j]), 0.0) ** 2
    return np.sqrt(total)


def nearest_by_blocks(queries, names, x, keys, k: int, within):
    """:func:`nearest_of_block` for many queries and points: both are parted into blocks of near ones; a
    block of queries gets bounds from the nearest blocks of points and then sees those alone whose
    box is within the bound of one of its queries. Rows that are not finite have and are no neighbours."""
    import numpy as np

    asked, there = np.isfinite(queries).all(axis=1), np.isfinite(x).all(axis=1)
    queries, names, within, x, keys = queries[asked], names[asked], within[asked], x[there], keys[there]
    if len(x) <= 2 * KNN_FIRST or not len(queries):
        return nearest_of_block(queries, names, x, keys, k, within)
    # of points that are the same the smallest keys alone can be among the k nearest
    same = np.unique(np.ascontiguousarray(x).view(f"V{x.itemsize * x.shape[1]}").ravel(), return_inverse=True)[1].ravel()
    order = np.lexsort((keys, same))
    place = np.arange(len(x)) - np.searchsorted(same[order], same[order], side="left")
    order = order[place < k + int(np.unique(keys, return_counts=True)[1].max())]
    x, keys = x[order], keys[order]
    parts = _blocks(x, KNN_BLOCK)
    low, high = (np.stack([f(x[p], axis=0) for p in parts]) for f in (np.min, np.max))
    size = np.array([len(p) for p in parts])
    found = []
    for at in _blocks(queries, KNN_BLOCK):
        q, name, bound = queries[at], names[at], within[at]
        away = _to_boxes(q, low, high)
        order = np.argsort(away.min(axis=0), kind="stable")
        upto = int(np.searchsorted(np.cumsum(size[order]), KNN_FIRST)) + 1
        some = np.concatenate([parts[b] for b in order[:upto]])
        who, nb, d = _nearest(q, name, x[some], keys[some], k, bound)
        far = np.full(len(q), -np.inf)
        np.maximum.at(far, who, d)
        bound = np.where(np.bincount(who, minlength=len(q)) >= k, np.minimum(bound, far), bound)
        rest = order[upto:]
        rest = rest[(away[:, rest] <= bound[:, None] * KNN_ROOM).any(axis=0)]
        if len(rest):
            some = np.concatenate([parts[b] for b in rest])
            who, nb, d = (np.concatenate(v) for v in zip((who, nb, d), _nearest(q, name, x[some], keys[some], k, bound)))
            take = np.lexsort((nb, d, who))
            who, nb, d = who[take], nb[take], d[take]
            best = np.arange(len(who)) - np.searchsorted(who, who, side="left") < k
            who, nb, d = who[best], nb[best], d[best]
        found.append((name[who], nb, d))
    return tuple(np.concatenate(v) for v in zip(*found))


def _matrix(column, width: int):
    """The rows of an Arrow list column, whole or in chunks, as a matrix; nulls are NaN."""
    import numpy as np
    import pyarrow as pa

    held = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return held.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), width)


def _numbers(column):
    """An Arrow column of whole numbers; with nulls, as doubles with NaN."""
    return column.to_numpy() if not hasattr(column, "combine_chunks") and not column.null_count else column.to_pandas().to_numpy()


def _deal(keys, parts):
    """A number below ``parts`` for each key, the same wherever it is made."""
    import numpy as np

    with np.errstate(invalid="ignore"):
        h = np.nan_to_num(keys).astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % parts.astype(np.uint64)).astype(np.int32)


def exact_knn(points: DataFrame, key: str, features: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """Exact k nearest neighbours (Euclidean) of every point among the others:
    (key, nb_rank 0..k-1, nb_key), ties broken by the neighbour key.

    Points are dealt to cells by a tree of splits, learnt from ``KNN_SAMPLE`` points a cell (first in seeded
    order); a cell holds about ``KNN_CELL`` to ``KNN_CELL_MOST`` points, and one that grows far beyond (points
    that are the same) is dealt to several. A first grouped pass finds each point's k best inside
    its cell, which bounds how far its neighbours can be. A second pass sends the point only to
    cells whose box is within that bound, ``KNN_ASKED`` points to a task, and a window partitioned by point merges
    what the cells return. No pair is a row; inside a task :func:`nearest_by_blocks` compares. The driver
    holds two numbers a feature and cell and the sample."""
    import numpy as np
    import pyarrow as pa

    from riskframe.session import cut_lineage

    feats, width = list(features), len(features)
    pts = cut_lineage(points.select(F.col(key).cast("long").alias(key), F.array(*[F.col(c).cast("double") for c in feats]).alias("x")))
    n = pts.count()
    size = min(KNN_CELL_MOST, max(KNN_CELL, n // KNN_CELLS))
    tree: list = []
    if n > size:
        wanted = math.ceil(n / size)
        some = pts.orderBy(md5_order(key, seed), key).limit(wanted * KNN_SAMPLE).select("x").collect()
        x = np.array([r["x"] for r in some], dtype=float)
        tree = _cell_tree(x[np.isfinite(x).all(axis=1)], wanted)

    def lists(x):
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(x.ravel()))

    def longs(v):
        return pa.array(v, pa.int64(), from_pandas=True)

    def assign(batches):
        for b in batches:
            x = _matrix(b.column("x"), width)
            there = np.isfinite(x).all(axis=1)         # others have and are no neighbours
            b, x = b.filter(pa.array(there)), x[there]
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("x"), pa.array(_cell_of(x, tree))], names=[key, "x", "cell"])

    point = f"`{key}` long, x array<double>, cell int"
    cells = cut_lineage(pts.mapInArrow(assign, point))
    ends = [f(F.get("x", F.lit(j))).alias(f"{side}{j}") for side, f in (("low", F.min), ("high", F.max)) for j in range(width)]
    held = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *ends).orderBy("cell").collect()      # a row per cell
    # a cell far above its size goes on as several of the same box
    parts = np.array([math.ceil(r["n"] / (2 * size)) for r in held], dtype=np.int64)
    first = np.zeros(max((r["cell"] for r in held), default=-1) + 1, dtype=np.int64)
    own_parts = np.ones(len(first), dtype=np.int64)
    for r, at, p in zip(held, np.cumsum(parts) - parts, parts):
        first[r["cell"]], own_parts[r["cell"]] = at, p
    low, high = (np.repeat(np.array([[r[f"{side}{j}"] for j in range(width)] for r in held], dtype=float).reshape(len(held), width), parts, axis=0)
                 for side in ("low", "high"))

    def cell_of(b):
        cell = b.column("cell").to_numpy()
        return (first[cell] + _deal(_numbers(b.column(key)), own_parts[cell])).astype(np.int32)

    def parted(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("x"), pa.array(cell_of(b))], names=[key, "x", "cell"])

    if (parts > 1).any():
        cells = cells.mapInArrow(parted, point)

    def best(q, held, within):
        rows, nbs, d = nearest_by_blocks(_matrix(q.column("x"), width), _numbers(q.column(key)), _matrix(held.column("x"), width),
                                         _numbers(held.column(key)), k, within)
        return pa.table([longs(rows), longs(nbs), pa.array(d)], names=[key, "nb_key", "d"])

    def inside(table):
        return best(table, table, np.full(len(table), np.inf))

    schema = f"`{key}` long, nb_key long, d double"
    own = cut_lineage(cells.groupBy("cell").applyInArrow(inside, schema))
    if len(low) < 2:
        return _ranked(own, key, k)
    bound = own.groupBy(key).agg(F.when(F.count(F.lit(1)) >= k, F.max("d")).alias("bound"))
    bounded = cells.join(bound, key, "left").select(key, "x", "cell", F.coalesce("bound", F.lit(math.inf)).alias("bound"))

    def route(batches, asked_parts):
        for b in batches:
            if b.num_rows:
                within, keys = b.column("bound").to_numpy(), _numbers(b.column(key))
                go = _to_boxes(_matrix(b.column("x"), width), low, high) <= within[:, None] * KNN_ROOM
                go[np.arange(len(go)), b.column("cell").to_numpy()] = False
                i, c = np.nonzero(go)
                at = pa.array(i)
                yield pa.RecordBatch.from_arrays([b.column(key).take(at), b.column("x").take(at), pa.array(within[i]), pa.array(c.astype(np.int32)),
                                                  pa.array(_deal(keys[i], asked_parts[c]))], names=[key, "x", "bound", "cell", "part"])

    query = f"`{key}` long, x array<double>, bound double, cell int, part int"
    asked_parts = np.ones(len(low), dtype=np.int64)
    if n > KNN_ASKED:
        bounded = cut_lineage(bounded)
        one = asked_parts.copy()
        for r in bounded.mapInArrow(lambda batches: route(batches, one), query).groupBy("cell").count().collect():
            asked_parts[r["cell"]] = math.ceil(r["count"] / KNN_ASKED)
    asked = bounded.mapInArrow(lambda batches: route(batches, asked_parts), query)

    def repeated(batches):
        for b in batches:
            times = asked_parts[b.column("cell").to_numpy()]
            at = np.repeat(np.arange(b.num_rows), times)
            part = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            b = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (key, "x", "cell")), pa.array(part.astype(np.int32))], names=[key, "x", "cell", "part"])

    def outside(q, held):
        if not len(q) or not len(held):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names=[key, "nb_key", "d"])
        return best(q, held, q.column("bound").to_numpy())

    more = asked.groupBy("cell", "part").cogroup(cells.mapInArrow(repeated, point + ", part int").groupBy("cell", "part")).applyInArrow(outside, schema)
    return _ranked(own.unionByName(more), key, k)


def _ranked(found: DataFrame, key: str, k: int) -> DataFrame:
    """The first k of what was found for each key."""
    w = Window.partitionBy(key).orderBy("d", "nb_key")     # at most k rows per point and cell asked
    return (found.withColumn("nb_rank", F.row_number().over(w) - 1).where(F.col("nb_rank") < k)
            .select(key, F.col("nb_rank").cast("int"), "nb_key"))


def smote(df: DataFrame, target: str, features: Sequence[str], key: str, minority=0, k: int = 3,
          seed: int = 42) -> DataFrame:
    """SMOTE oversampling of the minority class to parity, from every minority row.

    Synthetic row ``j`` (0..need-1) comes from the minority row at position
    ``j % n_min`` (key order), copy ``j // n_min``; it is x + u * (nb - x) where
    ``nb`` is one of x's ``k`` exact nearest minority neighbours and ``u`` in
    [0, 1), both chosen by ``xxhash64(key, copy, seed)``. Neighbours come from
    :func:`exact_knn`; each minority row meets its ``k`` neighbours in joins, and a copy is made
    where the two stand together, so synthetic rows are not shuffled."""
    feats = list(features)
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).collect()   # one row per class
    by_class = {r[target]: r["n"] for r in counts}
    n_min = by_class.get(minority, 0)
    n_max = max(by_class.values()) if by_class else 0
    need = n_max - n_min
    if need <= 0 or n_min < 2:
        return df.withColumn("synthetic", F.lit(False))
    from riskframe.session import cut_lineage

    mino = cut_lineage(df.where(F.col(target) == minority).select(key, *feats))
    kk = min(k, n_min - 1)
    nn = exact_knn(mino, key, feats, kk, seed)
    copies = (need + n_min - 1) // n_min
    x = mino.select(key, *[F.col(c).cast("double").alias(f"__x_{c}") for c in feats])
    nb = mino.select(F.col(key).alias("nb_key"), *[F.col(c).cast("double").alias(f"__n_{c}") for c in feats])
    pairs = with_row_rank(mino.select(key), [], [key], "__pos").join(nn, key).join(x, key).join(nb, "nb_key")
    def chance(copy):
        return F.xxhash64(F.col(key), copy, F.lit(seed))
    of_pair = F.filter(F.sequence(F.lit(0), F.lit(copies - 1)), lambda copy: (
        (copy * n_min + F.col("__pos") < need) & (F.pmod(chance(copy), F.lit(kk)).cast("int") == F.col("nb_rank"))))
    gen = pairs.withColumn("__copy", F.explode(of_pair))
    gen = gen.withColumn("__u", F.pmod(F.shiftright(chance(F.col("__copy")), 11), F.lit(1 << 40)).cast("double") / float(1 << 40))
    out_schema = df.schema
    cols = []
    for f in out_schema.fields:
        if f.name in feats:
            v = F.col(f"__x_{f.name}") + F.col("__u") * (F.col(f"__n_{f.name}") - F.col(f"__x_{f.name}"))
            cols.append(v.cast(f.dataType).alias(f.name))
        elif f.name == target:
            cols.append(F.lit(minority).cast(f.dataType).alias(f.name))
        elif f.name == key:
            cols.append(F.col(key))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    synth = gen.select(*cols)
    return df.withColumn("synthetic", F.lit(False)).unionByName(synth.withColumn("synthetic", F.lit(True)))
