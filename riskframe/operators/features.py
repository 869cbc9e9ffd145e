"""Feature derivation (D1-D9): flags, ratios, right-closed bands, median
quadrants and the base cleaning pipeline. All single projections over the
input, so they fuse into the scan's whole-stage-codegen span."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import cut_index, plain_ratio, positive_flag, right_closed_cut, safe_ratio
from riskframe.operators.filters import range_filter_keep_null
from riskframe.operators.projection import drop_columns
from riskframe.operators.quality import apply_fill, fit_medians
from riskframe.operators.ranking import quantile_row
from riskframe.plans import presets as P


def add_flag(df: DataFrame, src: str = "saldo_mora", out: str = "tiene_mora") -> DataFrame:
    """Binary flag ``src > 0`` (null -> 0). Skipped if ``src`` is absent."""
    return df.withColumn(out, positive_flag(src)) if src in df.columns else df


def add_ratio(df: DataFrame, num: str = "capital_prestado", den: str = "salario_cliente",
              out: str = "ratio_capital_salario", guarded: bool = True) -> DataFrame:
    """D2 (guarded: zero/null denominator -> 0) or D3 (unguarded: pandas' x/0 =
    +/-inf, 0/0 = NULL). Skipped if a column is absent."""
    if num not in df.columns or den not in df.columns:
        return df
    if guarded:
        return df.withColumn(out, safe_ratio(num, den))
    n, d = F.col(num), F.col(den)
    inf = F.lit(float("inf"))
    unguarded = (F.when(d == 0, F.when(n > 0, inf).when(n < 0, -inf))
                 .otherwise(plain_ratio(n, d)))
    return df.withColumn(out, unguarded)


def add_band(df: DataFrame, col: str, edges: Sequence, labels: Sequence[str], out: str,
             order_out: str | None = None) -> DataFrame:
    """Right-closed band ``(e_i, e_i+1]`` with its label order."""
    df = df.withColumn(out, right_closed_cut(col, edges, labels))
    return df.withColumn(order_out, cut_index(col, edges)) if order_out else df


def add_band_to_max(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str], out: str,
                    order_out: str | None = None) -> DataFrame:
    """Like :func:`add_band` but the last edge is the column's max, attached
    as a scalar subquery (one value)."""
    mx = df.agg(F.max(col).alias("m")).scalar()
    return add_band(df, col, list(edges) + [mx], labels, out, order_out)


def add_quadrant(df: DataFrame, score: str = "puntaje_datacredito", inquiries: str = "huella_consulta",
                 out: str = "grupo_riesgo", labels=None, default: str = P.QUADRANT_DEFAULT) -> DataFrame:
    """Median quadrant (score >= median x inquiries >= median) with a default
    label when either side is null. Medians are exact, one scalar subquery."""
    labels = labels or P.QUADRANT_LABELS
    med = quantile_row(df, [score, inquiries], 0.5, prefix="m_")
    packed = med.select(F.struct(*med.columns).alias("s")).scalar()
    hi_s = F.col(score) >= packed[f"m_{score}"]
    lo_s = F.col(score) < packed[f"m_{score}"]
    hi_i = F.col(inquiries) >= packed[f"m_{inquiries}"]
    lo_i = F.col(inquiries) < packed[f"m_{inquiries}"]
    expr = (F.when(hi_s & hi_i, labels[(True, True)]).when(hi_s & lo_i, labels[(True, False)])
            .when(lo_s & hi_i, labels[(False, True)]).when(lo_s & lo_i, labels[(False, False)])
            .otherwise(default))
    return df.withColumn(out, expr)


def add_all_positive(df: DataFrame, cols: Sequence[str], out: str, labels: tuple[str, str] = P.THREE_SECTORS) -> DataFrame:
    """Label rows where every column is > 0 (null compares false)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.coalesce(F.col(c) > 0, F.lit(False))
    return df.withColumn(out, F.when(cond, labels[0]).otherwise(labels[1]))


def eda_bands(df: DataFrame) -> DataFrame:
    """The EDA's age, loan-size and inquiry bands with their label order."""
    df = add_band(df, "edad_cliente", P.AGE_EDGES, P.AGE_LABELS, "grupo_edad", "grupo_edad_ord")
    df = add_band(df, "capital_prestado", P.SIZE_EDGES, P.SIZE_LABELS, "tamano_credito", "tamano_credito_ord")
    return add_band(df, "huella_consulta", P.INQUIRY_EDGES, P.INQUIRY_LABELS, "huella_cat", "huella_cat_ord")


def base_pipeline(df: DataFrame, fit_df: DataFrame | None = None, medians: DataFrame | None = None,
                  high_null: Sequence[str] = P.HIGH_NULL_COLUMNS, impute: Sequence[str] = P.IMPUTE_COLUMNS,
                  irrelevant: Sequence[str] = P.IRRELEVANT_COLUMNS) -> DataFrame:
    """Drop high-null columns -> median-impute -> derive flag and ratio ->
    drop irrelevant columns. Order matters: a null ``saldo_mora`` is imputed
    before the flag is derived. Medians are learnt on ``fit_df`` (default
    ``df``: the parity ``fit_on='all'`` behaviour) unless given."""
    out = drop_columns(df, high_null)
    if medians is None:
        src = drop_columns(fit_df, high_null) if fit_df is not None else out
        medians = fit_medians(src, impute)
    out = apply_fill(out, medians)
    out = add_ratio(add_flag(out), guarded=True)
    return drop_columns(out, irrelevant)


def clean_loans(loans: DataFrame) -> DataFrame:
    """F1 + D9 over the loan table (the main training path's steps 2-3)."""
    return base_pipeline(range_filter_keep_null(loans, P.RANGE_BOUNDS))


def complete_case(loans: DataFrame) -> DataFrame:
    """The cloud path preset: drop seven columns, then drop incomplete rows."""
    from riskframe.operators.filters import drop_incomplete
    return drop_incomplete(drop_columns(loans, P.COMPLETE_CASE_DROP))


def ratio_segments(df: DataFrame) -> DataFrame:
    """EDA ratio segments: unguarded ratio banded (0,1,3,6,max] (D3 + D5)."""
    df = add_ratio(df, guarded=False)
    return add_band_to_max(df, "ratio_capital_salario", P.RATIO_EDGES, P.RATIO_LABELS, "segmento_ratio",
                           "segmento_ratio_ord")


def fit_medians_on(df: DataFrame, cols: Sequence[str] = P.IMPUTE_COLUMNS) -> DataFrame:
    return fit_medians(df, cols)


__all__ = ["add_flag", "add_ratio", "add_band", "add_band_to_max", "add_quadrant", "add_all_positive",
           "eda_bands", "base_pipeline", "clean_loans", "complete_case", "ratio_segments", "quantile_row"]
