"""Batch scoring job (3.2): read -> enforce schema -> PipelineModel -> project -> write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskframe.operators.filters import enforce_schema
from riskframe.operators.models import batch_score

_D = T.DoubleType()
# The 15 required, typed fields of a scoring request (rows arrive feature-engineered).
SCORING_SCHEMA = T.StructType([
    T.StructField("tipo_credito", T.IntegerType(), False),
    T.StructField("capital_prestado", _D, False),
    T.StructField("plazo_meses", _D, False),
    T.StructField("edad_cliente", _D, False),
    T.StructField("tipo_laboral", T.StringType(), False),
    T.StructField("salario_cliente", _D, False),
    T.StructField("total_otros_prestamos", _D, False),
    T.StructField("puntaje_datacredito", _D, False),
    T.StructField("huella_consulta", _D, False),
    T.StructField("saldo_total", _D, False),
    T.StructField("creditos_sectorFinanciero", _D, False),
    T.StructField("creditos_sectorCooperativo", _D, False),
    T.StructField("creditos_sectorReal", _D, False),
    T.StructField("tiene_mora", T.IntegerType(), False),
    T.StructField("ratio_capital_salario", _D, False),
])


def score_batch(model, batch: DataFrame, keep=()) -> tuple[DataFrame, DataFrame]:
    """Validate a batch against :data:`SCORING_SCHEMA` and score the accepted rows.
    Returns (scored, rejected). ``keep`` columns (e.g. a key) are carried along."""
    accepted, rejected = enforce_schema(batch, SCORING_SCHEMA)
    if keep:
        accepted, rejected = enforce_schema(batch, T.StructType(
            list(SCORING_SCHEMA.fields) + [batch.schema[k] for k in keep]))
    return batch_score(model, accepted, keep), rejected
