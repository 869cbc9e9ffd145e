"""Column-expression building blocks. All return JVM-side ``Column``s (no UDFs),
so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "nan_to_null", "right_closed_cut", "cut_index", "safe_ratio", "plain_ratio",
    "ordinal", "label_map", "whitelist", "positive_flag", "hash_order", "md5_order",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """Missing = NaN in pandas; Spark orders NaN above every number and
    ``NaN = NaN`` is true, so NaN is mapped to NULL at the source."""
    c = col_of(c)
    return F.when(~F.isnan(c), c)


def right_closed_cut(c, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """``pd.cut`` semantics: bins ``(e0, e1], (e1, e2], ...``; anything outside
    (including exactly ``e0``) and null map to NULL. ``labels`` default to the
    bin index. ``edges`` may contain Columns (e.g. a broadcast column max)."""
    c = col_of(c)
    labels = list(labels) if labels is not None else list(range(len(edges) - 1))
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = (c > lo) & (c <= hi)
        expr = F.when(cond, F.lit(labels[i])) if expr is None else expr.when(cond, F.lit(labels[i]))
    return expr


def cut_index(c, edges: Sequence[float]) -> Column:
    """0-based bin index of :func:`right_closed_cut` (the label order, D8)."""
    return right_closed_cut(c, edges, list(range(len(edges) - 1)))


def safe_ratio(num, den) -> Column:
    """``num / den`` with a zero or null denominator giving 0 (guarded)."""
    return F.coalesce(F.try_divide(col_of(num), F.nullif(col_of(den), F.lit(0))), F.lit(0.0))


def plain_ratio(num, den) -> Column:
    """D3: unguarded ratio; pandas gives inf on x/0, ANSI Spark would raise, we give NULL."""
    return F.try_divide(col_of(num), col_of(den))


def ordinal(c, levels: Sequence[str]) -> Column:
    """Rank of an ordered category (1-based); unknown or null -> NULL."""
    pos = F.array_position(F.array(*[F.lit(v) for v in levels]), col_of(c))
    return F.when(pos > 0, pos.cast("int"))


def label_map(c, mapping: Mapping, default=None) -> Column:
    """Map codes to labels with a CASE expression; unmapped -> ``default``."""
    c = col_of(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def whitelist(c, allowed: Sequence) -> Column:
    """F8: keep a value only if it is in the allowed domain, else NULL."""
    c = col_of(c)
    return F.when(c.isin(*allowed), c)


def positive_flag(c) -> Column:
    """``(c > 0)`` as 0/1 with null comparing as false (pandas ``NaN > 0`` is False)."""
    return F.coalesce(col_of(c) > 0, F.lit(False)).cast("int")


def hash_order(key, seed: int) -> Column:
    """Default seeded pseudo-random order: 64-bit xxhash of (key, seed)."""
    return F.xxhash64(col_of(key), F.lit(seed))


def md5_order(key, seed: int, salt=None) -> Column:
    """Portable seeded order usable from any SQL engine: the first eight hex digits of
    ``md5('key|seed[|salt]')`` as a number below 2^32. Every bit of the seed and the salt
    changes the whole order, and keys of any size or type work. Callers break ties by
    the key."""
    parts = [col_of(key).cast("string"), F.lit(str(seed))] + ([col_of(salt).cast("string")] if salt is not None else [])
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")
