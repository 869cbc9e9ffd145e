"""Evaluation (V1-V15): confusion counts, metrics, curves, fold summaries,
selection and stability.

Input is a scored DataFrame (label, prediction[, score][, fold/candidate]).
Metrics are conditional sums in one grouped aggregate followed by arithmetic on
the (tiny) count rows; curves group by distinct score and take running totals
with the bucketed helper, so a fold or model is never one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.ranking import attach, running_totals
from riskframe.plans.presets import SELECTION_WEIGHTS, STABILITY_STD


def _div(a: Column, b: Column) -> Column:
    """``zero_division=0``: a 0 (or null) denominator gives 0."""
    return F.coalesce(F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0))), F.lit(0.0))


# ------------------------------------------------------------------ registry

def _precision(tp, fp, fn, tn, beta):
    return _div(tp, tp + fp)


def _recall(tp, fp, fn, tn, beta):
    return _div(tp, tp + fn)


def _specificity(tp, fp, fn, tn, beta):
    return _div(tn, tn + fp)


def _f1(tp, fp, fn, tn, beta):
    return _div(2 * tp, 2 * tp + fp + fn)


def _fbeta(tp, fp, fn, tn, beta):
    b2 = beta * beta
    return _div((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp)


def _accuracy(tp, fp, fn, tn, beta):
    return _div(tp + tn, tp + fp + fn + tn)


def _balanced_accuracy(tp, fp, fn, tn, beta):
    # sklearn: mean recall over the classes present in y_true
    present = (F.when(tp + fn > 0, 1).otherwise(0) + F.when(tn + fp > 0, 1).otherwise(0))
    return _div(_div(tp, tp + fn) + _div(tn, tn + fp), present)


METRICS = {
    "accuracy": _accuracy, "balanced_accuracy": _balanced_accuracy, "precision": _precision,
    "recall": _recall, "specificity": _specificity, "f1": _f1, "fbeta": _fbeta,
}


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction", pos_label=1,
                     group_by: Sequence[str] = ()) -> DataFrame:
    """(group..., tp, fp, fn, tn, n) for ``pos_label``; one aggregate."""
    y, p = F.col(label) == pos_label, F.col(prediction) == pos_label
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    return df.groupBy(*group_by).agg(cnt(y & p).alias("tp"), cnt(~y & p).alias("fp"), cnt(y & ~p).alias("fn"),
                                      cnt(~y & ~p).alias("tn"), F.count(F.lit(1)).alias("n"))


def metrics_from_counts(counts: DataFrame, names: Sequence[str] = ("accuracy", "balanced_accuracy", "precision",
                                                                    "recall", "f1", "fbeta"),
                        beta: float = 2.0) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select("*", *[METRICS[m](tp, fp, fn, tn, beta).alias(m) for m in names],
                         (tp + fp).alias("n_pred_pos"))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", pos_label=1,
                   beta: float = 2.0, group_by: Sequence[str] = ()) -> DataFrame:
    """V2 / V7: accuracy, balanced accuracy, precision, recall, F1, F-beta and the
    predicted-positive count (``casos_mora_pred`` for pos_label 0), per group."""
    return metrics_from_counts(confusion_counts(df, label, prediction, pos_label, group_by), beta=beta)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     labels: Sequence = (0, 1), group_by: Sequence[str] = ()) -> DataFrame:
    """V1: the full labels x labels grid (zeros included) as (actual, predicted, count)."""
    cells = [(a, b) for a in labels for b in labels]
    one = df.groupBy(*group_by).agg(*[
        F.sum(F.when((F.col(label) == a) & (F.col(prediction) == b), 1).otherwise(0)).cast("long").alias(f"c{i}")
        for i, (a, b) in enumerate(cells)])
    packed = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{i}").alias("count"))
                       for i, (a, b) in enumerate(cells)])
    return one.select(*group_by, F.inline(packed))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          labels: Sequence = (0, 1), group_by: Sequence[str] = ()) -> DataFrame:
    """V4: per-class precision/recall/F1/support plus accuracy, macro and weighted
    averages, as rows (class, precision, recall, f1, support). One pass: the
    labels x labels confusion counts, then arithmetic on that tiny table."""
    keys = list(group_by)
    cm = confusion_matrix(df, label, prediction, labels, keys)
    c = F.col("count")
    per_class = []
    for lab in labels:
        per_class.append(cm.groupBy(*keys).agg(
            F.sum(F.when((F.col("actual") == lab) & (F.col("predicted") == lab), c).otherwise(0)).alias("tp"),
            F.sum(F.when((F.col("actual") != lab) & (F.col("predicted") == lab), c).otherwise(0)).alias("fp"),
            F.sum(F.when((F.col("actual") == lab) & (F.col("predicted") != lab), c).otherwise(0)).alias("fn"),
            F.sum(F.when(F.col("actual") == F.col("predicted"), c).otherwise(0)).alias("hits"),
            F.sum(c).alias("n")).select(*keys, F.lit(str(lab)).alias("class"), "tp", "fp", "fn", "hits", "n"))
    per = per_class[0]
    for extra in per_class[1:]:
        per = per.unionByName(extra)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    per = per.select(*keys, "class", _div(tp, tp + fp).alias("precision"), _div(tp, tp + fn).alias("recall"),
                     _div(2 * tp, 2 * tp + fp + fn).alias("f1"), (tp + fn).alias("support"),
                     _div(F.col("hits"), F.col("n")).alias("accuracy"))
    agg = per.groupBy(*keys).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("sup"), F.first("accuracy").alias("acc"))
    tail = agg.select(*keys, F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1"), F.col("sup").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("sup").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                 F.col("wf").alias("f1"), F.col("sup").alias("support")))))
    return per.select(*keys, "class", "precision", "recall", "f1", "support").unionByName(tail)


# ------------------------------------------------------------------ ranking metrics

def _score_table(df: DataFrame, label: str, score: str, pos_label, group_by: Sequence[str]) -> DataFrame:
    is_pos = F.col(label) == pos_label
    return (df.where(F.col(score).isNotNull()).groupBy(*group_by, score)
            .agg(F.sum(F.when(is_pos, 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(is_pos, 0).otherwise(1)).cast("long").alias("neg")))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", pos_label=1,
            group_by: Sequence[str] = ()) -> DataFrame:
    """V3: ROC-AUC with ties counted half (Mann-Whitney), per group:
    sum over distinct scores of pos * (neg below + neg at / 2) / (P * N)."""
    keys = list(group_by)
    st = _score_table(df, label, score, pos_label, keys)
    cum = running_totals(st, keys, score, ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    return cum.groupBy(*keys).agg(
        (F.sum(F.col("pos") * (below + F.col("neg") * 0.5)) /
         F.nullif(F.sum("pos").cast("double") * F.sum("neg"), F.lit(0.0))).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", pos_label=1,
              group_by: Sequence[str] = ()) -> DataFrame:
    """V5: one point per distinct score (threshold; predict positive if score >=
    threshold): (threshold, fpr, tpr, tp, fp); no intermediate points dropped.
    The (0, 0) start point is the threshold +inf row."""
    keys = list(group_by)
    st = _score_table(df, label, score, pos_label, keys).withColumn("__neg_s", -F.col(score))
    cum = running_totals(st, keys, "__neg_s", ["pos", "neg"])
    tot = st.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    pts = attach(cum, tot, keys, broadcast=bool(keys)).select(   # one row per fold: proven bound
       
        *keys, F.col(score).cast("double").alias("threshold"), F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"), "P", "N")
    start = tot.select(*keys, F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("tp"),
                       F.lit(0).cast("long").alias("fp"), "P", "N")
    allp = pts.unionByName(start)
    return allp.select(*keys, "threshold", _div(F.col("fp"), F.col("N")).alias("fpr"),
                       _div(F.col("tp"), F.col("P")).alias("tpr"), "tp", "fp")


def pr_curve(df: DataFrame, label: str = "label", score: str = "score", pos_label=1,
             group_by: Sequence[str] = ()) -> DataFrame:
    """V6: precision and recall per distinct threshold. ``score`` must rank the
    ``pos_label`` class (the corrected behaviour)."""
    roc = roc_curve(df, label, score, pos_label, group_by).where(F.col("threshold") < float("inf"))
    return roc.select(*group_by, "threshold", _div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      F.col("tpr").alias("recall"))


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score", pos_label=1, steps: int = 100,
                    beta: float = 2.0, group_by: Sequence[str] = ()) -> DataFrame:
    """Metrics at each grid threshold ``t = i / steps`` (predict positive when
    ``score >= t``). Rows are counted once per grid cell and the counts cumulated
    from the top; no row x threshold explosion. The cell is the last threshold that
    the score itself reaches: the product alone can land a step off."""
    keys = list(group_by)
    near = F.floor(F.col(score) * steps)
    cell = (F.when(F.col(score) >= (near + 1) / steps, near + 1)
            .when(F.col(score) < near / steps, near - 1).otherwise(near))
    cell = F.least(F.greatest(cell, F.lit(0)), F.lit(steps)).cast("int")
    is_pos = F.col(label) == pos_label
    cells = (df.where(F.col(score).isNotNull()).groupBy(*keys, cell.alias("cell"))
             .agg(F.sum(F.when(is_pos, 1).otherwise(0)).cast("long").alias("pos"),
                  F.sum(F.when(is_pos, 0).otherwise(1)).cast("long").alias("neg")))
    tot = cells.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    grid = tot.select(*keys, "P", "N", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("i"))
    per_i = grid.join(cells.withColumnRenamed("cell", "i"), [*keys, "i"], "left").na.fill(0, ["pos", "neg"])
    # cumulate from the top over the (steps + 1)-row grid of each group
    w = Window.partitionBy(*keys).orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    full = per_i.select(*keys, "i", "P", "N", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"))
    full = full.withColumn("fn", F.col("P") - F.col("tp")).withColumn("tn", F.col("N") - F.col("fp"))
    m = metrics_from_counts(full, beta=beta)
    return m.select(*keys, (F.col("i") / steps).alias("threshold"), "tp", "fp", "fn", "tn", "accuracy",
                    "precision", "recall", "f1", "fbeta")


def metrics_near_threshold(sweep: DataFrame, target: float = 0.5, group_by: Sequence[str] = ()) -> DataFrame:
    """The sweep row whose threshold is nearest ``target`` (ties: lower threshold)."""
    keys = list(group_by)
    best = F.min_by(F.struct(*[c for c in sweep.columns if c not in keys]),
                    F.struct(F.abs(F.col("threshold") - target), F.col("threshold")))
    return sweep.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


# ------------------------------------------------------------------ folds, selection, stability

def fold_summary(per_fold: DataFrame, metrics: Sequence[str], group_by: Sequence[str] = (),
                 sample_std: bool = False) -> DataFrame:
    """V8: mean and std (population by default, sample with ``sample_std``) of
    each metric over folds: (group..., metric, mean, std, n_folds)."""
    keys = list(group_by)
    long = per_fold.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))
    std = F.stddev_samp if sample_std else F.stddev_pop
    return long.groupBy(*keys, "metric").agg(F.avg("value").alias("mean"), std("value").alias("std"),
                                             F.count(F.lit(1)).alias("n_folds"))


def selection_score(summary: DataFrame, fbeta: str = "test_fbeta", std: str = "cv_fbeta_std",
                    fit_time: str = "cv_fit_time_mean", weights=SELECTION_WEIGHTS) -> DataFrame:
    """0.60 test F-beta + 0.25 / (1 + CV std) + 0.15 / (1 + fit seconds)."""
    return summary.withColumn(
        "selection_score",
        weights["fbeta"] * F.col(fbeta) + weights["stability"] / (1 + F.col(std))
        + weights["speed"] / (1 + F.col(fit_time)))


def rank_candidates(summary: DataFrame, score: str = "selection_score", name: str = "modelo") -> DataFrame:
    """Rank candidates best first (ties by name); ``rank`` 1 is the winner.
    The window has no partition but runs over one row per candidate."""
    w = Window.orderBy(F.desc(score), F.col(name))
    return summary.withColumn("rank", F.row_number().over(w)).orderBy("rank")


def stability_verdict(per_fold: DataFrame, metrics: Sequence[str], group_by: Sequence[str] = (),
                      max_std: float = STABILITY_STD, sample_std: bool = False) -> DataFrame:
    """Per metric ESTABLE / INESTABLE when std < ``max_std``, plus the
    overall verdict (every metric stable) on each row."""
    keys = list(group_by)
    s = fold_summary(per_fold, metrics, keys, sample_std)
    s = s.withColumn("stable", F.coalesce(F.col("std") < max_std, F.lit(False)))
    s = s.withColumn("verdict", F.when(F.col("stable"), "ESTABLE").otherwise("INESTABLE"))
    overall = s.groupBy(*keys).agg(F.bool_and("stable").alias("all_stable"))
    return attach(s, overall, keys)


def compare_metrics(a: DataFrame, b: DataFrame, name_a: str = "local", name_b: str = "other") -> DataFrame:
    """Two (metric, value) tables side by side: full outer join on the
    metric, winner = higher value, ties to ``a``, missing shown as '-'."""
    j = a.select("metric", F.col("value").alias(name_a)).join(
        b.select("metric", F.col("value").alias(name_b)), "metric", "full_outer")
    va, vb = F.col(name_a), F.col(name_b)
    winner = (F.when(va.isNull() | vb.isNull(), F.lit("-"))
              .when(va >= vb, F.lit(name_a)).otherwise(F.lit(name_b)))
    return j.select("metric", va, vb, winner.alias("winner"))


def metrics_long(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Unpivot a one-row metrics table to (metric, value)."""
    return metrics.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                             for m in names])))
