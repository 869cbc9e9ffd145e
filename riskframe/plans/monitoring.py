"""Periodic monitoring cycle (K7): sample -> score -> drift -> report.

The reference snapshot (training rows) is an input DataFrame; callers persist it
or keep it as a stored table (K2) so each cycle does not rebuild it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import drift as K
from riskframe.operators.projection import map_labels
from riskframe.operators.quality import value_counts
from riskframe.operators.rules import rule_classifier
from riskframe.operators.sampling import sample_n
from riskframe.plans.presets import DRIFT_P, LABELS


def monitoring_cycle(reference: DataFrame, candidates: DataFrame, key: str, cols: Sequence[str],
                     model=None, frac: float = 0.1, floor: int = 50, seed: int = 42,
                     threshold: float = DRIFT_P, order="md5") -> dict[str, DataFrame]:
    """Returns ``report`` (drift per variable + sample size + overall flag),
    ``predictions`` (the scored sample) and ``mix`` (labelled prediction counts).
    ``model`` is a fitted PipelineModel; without one the rule classifier scores."""
    sample = sample_n(candidates, key, frac, floor, seed, order=order)
    if model is not None:
        from riskframe.operators.models import batch_score
        scored = batch_score(model, sample, keep=[key])
        pred_col = "prediccion"
    else:
        scored = map_labels(rule_classifier(sample), "prediction", LABELS, out="etiqueta")
        pred_col = "prediction"
    report = K.ks_report(reference, sample, list(cols), threshold)
    n = sample.agg(F.count(F.lit(1))).scalar()
    any_drift = report.agg(F.coalesce(F.bool_or("drift_detectado"), F.lit(False))).scalar()
    report = report.select("*", n.alias("n_muestra"), any_drift.alias("hay_drift"))
    mix = value_counts(scored, ["etiqueta"]).select(F.col("value").alias("etiqueta"), "count")
    return {"report": report, "predictions": scored.select(key, pred_col, "etiqueta"), "mix": mix}
