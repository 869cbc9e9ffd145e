"""Run parameters (S10) and the credit-default configuration.

Operators never hard-code these names; they are only the defaults that the
composed jobs pass in.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the original pipeline's for equal results:
# column names, label texts, bin edges, rule thresholds and run parameters.
# ---------------------------------------------------------------------------
TARGET = "Pago_atiempo"
KEY = "loan_id"
EVENT = 0                      # the positive class of the default metrics: 0 = default ("Mora")
LABELS = {1: "Paga a tiempo", 0: "Mora"}

HIGH_NULL_COLUMNS = ["promedio_ingresos_datacredito", "tendencia_ingresos"]
IRRELEVANT_COLUMNS = ["fecha_prestamo", "puntaje", "cuota_pactada", "saldo_principal",
                      "cant_creditosvigentes", "saldo_mora", "saldo_mora_codeudor"]
IMPUTE_COLUMNS = ["saldo_mora", "saldo_total", "saldo_mora_codeudor", "puntaje_datacredito"]
NUMERIC_FEATURES = ["capital_prestado", "plazo_meses", "edad_cliente", "salario_cliente",
                    "total_otros_prestamos", "puntaje_datacredito", "huella_consulta", "saldo_total",
                    "creditos_sectorFinanciero", "creditos_sectorCooperativo", "creditos_sectorReal",
                    "tiene_mora", "ratio_capital_salario"]
CATEGORICAL_FEATURES = ["tipo_credito", "tipo_laboral"]
# complete-case preset (cloud path): these are dropped and rows with nulls removed
COMPLETE_CASE_DROP = ["cant_creditosvigentes", "cuota_pactada", "fecha_prestamo",
                      "puntaje", "promedio_ingresos_datacredito", "tendencia_ingresos", "saldo_principal"]

RANGE_BOUNDS = {"edad_cliente": (18, 100), "puntaje_datacredito": (150, 950)}
TREND_LEVELS = ["Decreciente", "Estable", "Creciente"]          # ordered low -> high
DOMAIN_RULES = [                                                # (rule, column, lo, hi)
    ("age_18_100", "edad_cliente", 18, 100),
    ("score_150_950", "puntaje_datacredito", 150, 950),
    ("salary_positive", "salario_cliente", 0, None),
    ("capital_300k_50m", "capital_prestado", 300_000, 50_000_000),
    ("term_1_90", "plazo_meses", 1, 90),
]

AGE_EDGES = [0, 30, 45, 60, 150]
AGE_LABELS = ["≤30", "31-45", "46-60", ">60"]
SIZE_EDGES = [0, 1_500_000, 3_000_000, float("inf")]
SIZE_LABELS = ["Pequeño", "Mediano", "Grande"]
INQUIRY_EDGES = [0, 3, 6, float("inf")]
INQUIRY_LABELS = ["Baja", "Media", "Alta"]
RATIO_EDGES = [0, 1, 3, 6]                                      # last edge = column max
RATIO_LABELS = ["Bajo (≤1)", "Medio (1-3)", "Alto (3-6)", "Muy alto (>6)"]
QUADRANT_LABELS = {
    (True, True): "Score alto + muchas consultas",
    (True, False): "Score alto + pocas consultas",
    (False, True): "Score bajo + muchas consultas",
    (False, False): "Score bajo + pocas consultas",
}
QUADRANT_DEFAULT = "Otro"
THREE_SECTORS = ("En los 3 sectores", "No en los 3 sectores")

RULE_THRESHOLDS = {"puntaje_muy_bajo": 600.0, "puntaje_moderado": 750.0, "puntaje_independiente": 700.0,
                   "edad_joven": 30, "ratio_alto": 3.0, "huella_alta": 8}
SELECTION_WEIGHTS = {"fbeta": 0.60, "stability": 0.25, "speed": 0.15}
STABILITY_STD = 0.05
DRIFT_P = 0.05


@dataclass(frozen=True)
class RunConfig:
    """Run parameters of the original configuration file."""
    test_size: float = 0.2
    random_state: int = 42
    monitoring_period_days: int = 7
    drift_threshold: float = DRIFT_P
    cv_folds: int = 5
    shuffle_splits: int = 50
    shuffle_seed: int = 123
    train_fractions: tuple = (0.1, 0.325, 0.55, 0.775, 1.0)
    sample_fraction: float = 0.1
    sample_floor: int = 50
    beta: float = 2.0
    extra: dict = field(default_factory=dict)
