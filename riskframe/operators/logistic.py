"""Many logistic regressions over nested subsets of one table, fitted together (V9 for a model).

A learning curve fits one model for each (split, training size): 250 fits of the same rows.
Here a Newton step of *all* fits is one pass: every task adds up, for each fit, the loss,
the gradient and the Gram sums of its rows (numpy over Arrow batches), the sums of the tasks
are merged in two levels, and one small group per fit solves for the next coefficients.
What a task holds and what travels are ``fits * features ** 2`` numbers, whatever the number
of rows; a row is never copied for a split.

Each fit has its own feature pipeline, as in the original: numeric columns are scaled by the
mean and population deviation of the fit's own training rows (a missing value scores at the
mean, a constant column is only centred) and categorical levels are full-rank one-hot. Level
lists come from all rows: a level that a subset lacks has a zero gradient and keeps the
coefficient zero, which is what ignoring it means.

The objective is the original's: the weighted log-loss summed over the rows, plus half the
squared coefficients (L2, C = 1) without the intercept; balanced weights ``n / (2 n_c)``.

Defined cases: a subset with a single class has no fit and predicts that class for every
row; rows whose target is neither 0 nor 1 are left out of fits and scores; a split without
held-out rows of ``pos_label`` has recall 0, as in the original.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.encoding import collect_levels, fit_levels
from riskframe.operators.ranking import local_frame
from riskframe.operators.sampling import split_members, train_size_grid

#: A fit is done when no score equation is off by more than this times its number of rows.
TOLERANCE = 1e-10
#: The one fit that all others start from needs no more than this.
START_TOLERANCE = 1e-7
MAX_STEPS = 60

_SUMS = "fit int, part int, sums array<double>"


def encode_rows(df: DataFrame, numeric: Sequence[str], levels: dict[str, list[str]], target: str) -> DataFrame:
    """(y tinyint, x array<double>, member): numeric values (missing as NaN), then the one-hot columns."""
    nums = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in numeric]
    hot = [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0))
           for c, lv in levels.items() for v in lv]
    return df.where(F.col(target).isin(0, 1)).select(
        F.col(target).cast("byte").alias("y"), F.array(*nums, *hot).alias("x"),
        F.transform("member", lambda m: m.cast("byte")).alias("member"))


def _arrays(batch):
    """(y, x, member) of an Arrow batch as numpy arrays, without a Python object per row."""
    n = batch.num_rows
    y = batch.column("y").to_numpy(zero_copy_only=False)
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    member = batch.column("member").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    return y, x, member


def _design(x, n_num, mean, scale):
    """Rows as a fit sees them: intercept, scaled numeric values (missing as 0), one-hot."""
    z = np.empty((len(x), x.shape[1] + 1))
    z[:, 0] = 1.0
    z[:, 1:n_num + 1] = np.nan_to_num((x[:, :n_num] - mean) / scale, nan=0.0)
    z[:, n_num + 1:] = x[:, n_num:]
    return z


def _per_task(rows: DataFrame, n_fits: int, width: int, add, choose, only: Sequence[int] | None = None) -> DataFrame:
    """One row per (task, fit): ``add(fit, y, x)`` summed over the batches of the task.
    ``choose(member, fit)`` gives the rows of the fit; fits not among ``only`` stay zero. The last
    number is the seconds spent."""
    wanted = range(n_fits) if only is None else only

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        acc = np.zeros((n_fits, width + 1))
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            y, x, member = _arrays(batch)
            for f in wanted:
                t0 = time.perf_counter()
                rows_of = choose(member, f)
                got = add(f, y[rows_of], x[rows_of])
                if got is not None:
                    acc[f, :width] += got
                    acc[f, width] += time.perf_counter() - t0
        if seen:
            yield _sum_batch(pa, acc, TaskContext.get().partitionId())

    return rows.mapInArrow(run, _SUMS)


def _sum_batch(pa, acc, part):
    values = pa.ListArray.from_arrays(pa.array(np.arange(0, acc.size + 1, acc.shape[1]), pa.int32()), pa.array(acc.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(acc)), pa.int32()),
                                       pa.array(np.full(len(acc), part), pa.int32()), values], ["fit", "part", "sums"])


def _merge_tasks(partial: DataFrame, n_fits: int) -> DataFrame:
    """First level of the merge: tasks are dealt over a few merging tasks, each of which
    streams through its share and keeps one matrix."""
    n = max(1, min(64, int(partial.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        acc = None
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = batch.column("sums").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            if acc is None:
                acc = np.zeros((n_fits, sums.shape[1]))
            np.add.at(acc, batch.column("fit").to_numpy(), sums)
        if acc is not None:
            yield _sum_batch(pa, acc, TaskContext.get().partitionId())

    return partial.repartition(n, "part").mapInArrow(run, _SUMS)


def _training(size_count: int):
    def choose(member, f):
        m = member[:, f // size_count]
        return (m >= 1) & (m <= f % size_count + 1)
    return choose


def _held_out(size_count: int):
    return lambda member, f: member[:, f // size_count] == 0


def _scales(rows: DataFrame, n_fits: int, choose, n_num: int) -> dict[int, dict]:
    """Per fit: rows of each class and, per numeric column, mean and population deviation.
    Deviations are taken around the mean of the whole table, so that large values with a
    small spread do not cancel."""
    means = rows.select(*[F.avg(F.when(~F.isnan(F.col("x")[j]), F.col("x")[j])).alias(f"m{j}") for j in range(n_num)]).first()
    base = np.array([m or 0.0 for m in means]) if n_num else np.zeros(0)

    def add(f, y, x):
        v = x[:, :n_num] - base
        there = ~np.isnan(v)
        v = np.where(there, v, 0.0)
        return np.concatenate([[np.sum(y == 0), np.sum(y == 1)], there.sum(axis=0), v.sum(axis=0), (v * v).sum(axis=0)])

    merged = _merge_tasks(_per_task(rows, n_fits, 2 + 3 * n_num, add, choose), n_fits)
    out = {}
    for r in merged.groupBy("fit").applyInPandas(_total, "fit int, sums array<double>").collect():   # a row per fit
        s = np.array(r["sums"])
        count, total, squares = s[2:2 + n_num], s[2 + n_num:2 + 2 * n_num], s[2 + 2 * n_num:2 + 3 * n_num]
        safe = np.maximum(count, 1)
        var = np.maximum(squares / safe - (total / safe) ** 2, 0.0)
        dev = np.sqrt(var)
        tiny = dev <= 1e-9 * (np.abs(base) + np.abs(total / safe))      # a constant column is only centred
        out[r["fit"]] = {"n0": s[0], "n1": s[1], "mean": base + total / safe, "scale": np.where(tiny, 1.0, dev),
                         "seconds": s[-1]}
    return out


def _total(group):
    import pandas as pd

    return pd.DataFrame({"fit": [int(group["fit"].iloc[0])], "sums": [np.sum(np.stack(group["sums"].to_list()), axis=0)]})


def _started(fits: dict[int, dict], pilot: dict, n_num: int) -> None:
    """Coefficients to start from: those of ``pilot``, turned to each fit's own scaling."""
    for fit in fits.values():
        if not fit["done"]:
            beta = pilot["beta"].copy()
            beta[0] += np.sum(beta[1:n_num + 1] * (fit["mean"] - pilot["mean"]) / pilot["scale"])
            beta[1:n_num + 1] *= fit["scale"] / pilot["scale"]
            fit["beta"] = beta
            fit["seconds"] += pilot["seconds"] / len(fits)


def fit_logistic_grid(rows: DataFrame, n_splits: int, sizes: int, n_num: int, width: int) -> dict[int, dict]:
    """Newton steps for all ``n_splits * sizes`` fits at once over ``rows`` of
    :func:`encode_rows` (``width`` features, the first ``n_num`` numeric).

    One fit of all rows comes first, and the others start from it: they are near it, so that
    they need few steps, each of which costs as much as ``n_splits * sizes`` of its own.

    Per fit: ``beta`` (intercept first), ``mean``, ``scale``, ``n0``, ``n1``, ``score`` (the
    largest score equation at ``beta``), ``steps``, ``seconds`` (task seconds) and
    ``done``. A step that raises the loss is halved. Raises if a fit is not done after
    ``MAX_STEPS`` passes."""
    every = lambda member, f: np.ones(len(member), dtype=bool)       # noqa: E731
    pilot = _newton(rows, _new_fits(_scales(rows, 1, every, n_num), width), every, n_num, width, START_TOLERANCE, strict=False)
    fits = _new_fits(_scales(rows, n_splits * sizes, _training(sizes), n_num), width)
    if 0 in pilot and pilot[0]["done"] and np.isfinite(pilot[0]["beta"]).all():
        _started(fits, pilot[0], n_num)
    return _newton(rows, fits, _training(sizes), n_num, width, TOLERANCE)


def _new_fits(scales: dict[int, dict], width: int) -> dict[int, dict]:
    for fit in scales.values():
        one_class = not fit["n0"] or not fit["n1"]
        fit.update(beta=np.zeros(width + 1), at=None, loss=math.inf, score=0.0, steps=0, done=one_class)
        if one_class:
            fit["beta"][0] = math.inf if fit["n1"] else -math.inf
    return scales


def _newton(rows: DataFrame, fits: dict[int, dict], choose, n_num: int, width: int, tolerance: float, strict: bool = True) -> dict[int, dict]:
    """Steps until no fit has a score equation off by more than ``tolerance`` times its rows."""
    n_fits, d = len(fits), width + 1
    upper = np.triu_indices(d)
    for _ in range(MAX_STEPS):
        todo = {f: fit for f, fit in fits.items() if not fit["done"]}
        if not todo:
            break
        state = {f: {k: fit[k] for k in ("beta", "at", "loss", "mean", "scale", "n0", "n1")} for f, fit in todo.items()}

        def add(f, y, x):
            s = state[f]
            if not len(y):
                return None
            z = _design(x, n_num, s["mean"], s["scale"])
            eta = z @ s["beta"]
            n = s["n0"] + s["n1"]
            w = np.where(y == 1, n / (2 * s["n1"]), n / (2 * s["n0"]))
            p = 1.0 / (1.0 + np.exp(-np.clip(eta, -700, 700)))
            loss = np.sum(w * (np.logaddexp(0.0, eta) - y * eta))
            gram = z.T @ (z * (w * p * (1 - p))[:, None])
            return np.concatenate([[loss], z.T @ (w * (y - p)), gram[upper]])

        def solve(group):
            import pandas as pd

            f = int(group["fit"].iloc[0])
            s, sums = state[f], np.sum(np.stack(group["sums"].to_list()), axis=0)
            beta, penalised = s["beta"], np.r_[0.0, np.ones(d - 1)]
            loss = sums[0] + 0.5 * np.sum((penalised * beta) ** 2)
            if s["at"] is not None and loss > s["loss"] * (1 + 1e-12):
                half = (beta + s["at"]) / 2            # the step went too far
                return pd.DataFrame({"fit": [f], "at": [s["at"]], "beta": [half], "loss": [s["loss"]],
                                     "score": [math.inf], "seconds": [sums[-1]]})
            gradient = sums[1:1 + d] - penalised * beta
            gram = np.zeros((d, d))
            gram[upper] = sums[1 + d:-1]
            gram = gram + np.triu(gram, 1).T + np.diag(penalised)
            step = np.linalg.lstsq(gram, gradient, rcond=None)[0]
            return pd.DataFrame({"fit": [f], "at": [beta], "beta": [beta + step], "loss": [loss],
                                 "score": [float(np.max(np.abs(gradient)))], "seconds": [sums[-1]]})

        sums = _merge_tasks(_per_task(rows, n_fits, 1 + d + len(upper[0]), add, choose, sorted(todo)), n_fits)
        live = sums.where(F.col("fit").isin(list(todo)))
        schema = "fit int, at array<double>, beta array<double>, loss double, score double, seconds double"
        for r in live.groupBy("fit").applyInPandas(solve, schema).collect():       # a row per fit
            fit = fits[r["fit"]]
            done = r["score"] <= tolerance * (fit["n0"] + fit["n1"])
            fit.update(at=np.array(r["at"]), beta=np.array(r["at"] if done else r["beta"]), loss=r["loss"],
                       score=r["score"], steps=fit["steps"] + 1, seconds=fit["seconds"] + r["seconds"], done=done)
    unfinished = [f for f, fit in fits.items() if not fit["done"]]
    if unfinished and strict:
        raise ArithmeticError(f"{len(unfinished)} fits do not meet their score equations after {MAX_STEPS} steps")
    return fits


def logistic_learning_curve(train: DataFrame, key: str, target: str, numeric: Sequence[str], categorical: Sequence[str],
                            n_splits: int = 50, test_size: float = 0.2, seed: int = 123,
                            fractions: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0), pos_label: int = 0,
                            order: str = "md5") -> DataFrame:
    """V9 for the logistic candidate: one row per (split, training size) with
    ``train_size``, ``n_train_pos`` and ``n_test_pos`` (rows of ``pos_label``), ``train_recall``, ``test_recall``,
    ``score_equation`` (the largest one at the fitted coefficients), ``steps``,
    ``fit_time`` and ``score_time`` (task seconds of this fit, over all tasks and passes)."""
    from riskframe.session import cut_lineage

    spark = train.sparkSession
    n = train.count()
    grid = train_size_grid(n - math.ceil(n * test_size), fractions)
    schema = ("split_id int, train_size long, n_train_pos long, n_test_pos long, train_recall double, test_recall double, "
              "score_equation double, steps int, fit_time double, score_time double")
    if not grid:
        return local_frame(spark, [], schema)
    levels = collect_levels(fit_levels(train, categorical)) if categorical else {}
    members = split_members(train.select(key, target, *numeric, *categorical), key, n_splits, test_size, seed, order, fractions)
    rows = cut_lineage(encode_rows(members, numeric, levels, target))
    n_num, sizes = len(numeric), len(grid)
    width = n_num + sum(map(len, levels.values()))
    fits = fit_logistic_grid(rows, n_splits, sizes, n_num, width)
    state = {f: (fit["beta"], fit["mean"], fit["scale"]) for f, fit in fits.items()}

    def hits(f, y, x):
        beta, mean, scale = state[f]
        pos = y == pos_label
        if not pos.any():
            return np.zeros(2)
        if math.isinf(beta[0]):
            likelier = np.full(int(pos.sum()), beta[0] > 0)
        else:
            likelier = _design(x[pos], n_num, mean, scale) @ beta > 0
        return np.array([np.sum(likelier == (pos_label == 1)), pos.sum()], dtype=float)

    got = {}
    for part, choose in (("train", _training(sizes)), ("test", _held_out(sizes))):
        sums = _merge_tasks(_per_task(rows, len(fits), 2, hits, choose), len(fits))
        for r in sums.groupBy("fit").applyInPandas(_total, "fit int, sums array<double>").collect():   # a row per fit
            got[r["fit"], part] = r["sums"]
    out = []
    for f in sorted(fits):
        tr, te = got[f, "train"], got[f, "test"]
        out.append((f // sizes, grid[f % sizes], int(tr[1]), int(te[1]), tr[0] / tr[1] if tr[1] else 0.0,
                    te[0] / te[1] if te[1] else 0.0, float(fits[f]["score"]), int(fits[f]["steps"]),
                    float(fits[f]["seconds"]), float(tr[2] + te[2])))
    return local_frame(spark, out, schema)
