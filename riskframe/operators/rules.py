"""M1: the rule-based default classifier as ONE ``CASE`` expression.

Every rule writes the event class, so the model is an OR of the rules; the
stated priority only decides which rule is reported in ``rule_hit``. A rule is
skipped when one of its columns is absent; a null comparison is false (pandas
NaN semantics), so a null never fires a rule.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.plans.presets import RULE_THRESHOLDS


def rule_conditions(columns, t: Mapping = RULE_THRESHOLDS) -> list[tuple[int, Column]]:
    """(priority, condition) for the rules whose columns exist; priority 1 is highest."""
    cols = set(columns)
    c = F.col
    rules = [
        (1, ["tiene_mora"], lambda: c("tiene_mora") == 1),
        (2, ["puntaje_datacredito"], lambda: c("puntaje_datacredito") < t["puntaje_muy_bajo"]),
        (3, ["edad_cliente", "ratio_capital_salario"],
         lambda: (c("edad_cliente") < t["edad_joven"]) & (c("ratio_capital_salario") > t["ratio_alto"])),
        (4, ["huella_consulta", "puntaje_datacredito"],
         lambda: (c("huella_consulta") > t["huella_alta"]) & (c("puntaje_datacredito") < t["puntaje_moderado"])),
        (5, ["tipo_laboral", "puntaje_datacredito"],
         lambda: (c("tipo_laboral").cast("string") == "Independiente")
         & (c("puntaje_datacredito") < t["puntaje_independiente"])),
    ]
    return [(p, F.coalesce(make(), F.lit(False))) for p, need, make in rules if cols.issuperset(need)]


def rule_classifier(df: DataFrame, thresholds: Mapping | None = None, out: str = "prediction",
                    event: int = 0, default: int = 1, with_hits: bool = True) -> DataFrame:
    """Predict ``event`` if any rule fires, else ``default``; add ``rule_hit``
    (highest-priority rule fired, 0 = none) and ``rule_count`` (rules fired,
    a coarse risk score for ranking metrics)."""
    t = dict(RULE_THRESHOLDS)
    t.update(thresholds or {})
    conds = rule_conditions(df.columns, t)
    fired = F.lit(False)
    for _, cond in conds:
        fired = fired | cond
    cols = [F.when(fired, F.lit(event)).otherwise(F.lit(default)).cast("int").alias(out)]
    if with_hits:
        hit = F.lit(0)
        for p, cond in reversed(conds):
            hit = F.when(cond, F.lit(p)).otherwise(hit)
        count = sum((cond.cast("int") for _, cond in conds), F.lit(0))
        cols += [hit.cast("int").alias("rule_hit"), count.cast("int").alias("rule_count")]
    return df.select("*", *cols)
