"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver's tables (or data Spark derives
from them). Their DuckDB oracles live in :mod:`riskframe.plans.oracle_sql`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.operators import aggregates as A
from riskframe.operators import features as D
from riskframe.operators.filters import range_filter_keep_null
from riskframe.plans import presets as P
from riskframe.sources.loans import loan_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Intermediates shared by several steps of ONE query (the checkpointed loan table
# and split). Cleared when a registered query starts, so every query is computed
# from the driver tables and no query reuses another's work.
_SHARED: dict = {}


def register(name: str):
    def deco(fn):
        def run(spark, sf_dir):
            _SHARED.clear()
            return fn(spark, sf_dir)
        run.__doc__, run.__name__ = fn.__doc__, fn.__name__
        QUERIES[name] = run
        return fn
    return deco


def _shared(key, build):
    from riskframe.session import generation

    key = (generation(SparkSession.active()), key)
    if key not in _SHARED:
        _SHARED[key] = build()
    return _SHARED[key]


def loans_base(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """The loan table for multi-pass queries: derived once from the driver tables
    and written to the checkpoint folder, so fit steps (medians, quantiles) and the
    final pass read it instead of re-running the three-table join each time."""
    from riskframe.session import cut_lineage

    if not materialize:
        return loan_table(spark, sf_dir)
    return _shared(("loans", sf_dir), lambda: cut_lineage(loan_table(spark, sf_dir)))


def filtered_loans(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    return range_filter_keep_null(loans_base(spark, sf_dir, materialize), P.RANGE_BOUNDS)


def clean_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(("clean", sf_dir), lambda: D.base_pipeline(filtered_loans(spark, sf_dir)))


@register("eda_default_rate_age_x_size")
def q_age_x_size(spark, sf_dir):
    """Flagship: default rate (%) by age band x loan-size band over the cleaned loans (A10)."""
    df = D.add_band(filtered_loans(spark, sf_dir, materialize=False), "edad_cliente", P.AGE_EDGES, P.AGE_LABELS,
                    "grupo_edad")
    df = D.add_band(df, "capital_prestado", P.SIZE_EDGES, P.SIZE_LABELS, "tamano_credito")
    return A.event_rate_pivot(df, "grupo_edad", "tamano_credito", P.SIZE_LABELS, P.TARGET, P.EVENT)


# =========================================================================== shared inputs

from pyspark.sql import functions as F  # noqa: E402

from riskframe.operators import filters as FL  # noqa: E402
from riskframe.operators import projection as PR  # noqa: E402
from riskframe.operators import quality as Q  # noqa: E402

LOAN_COLUMNS = ["loan_id", "tipo_credito", "fecha_prestamo", "capital_prestado", "plazo_meses", "cuota_pactada",
                "edad_cliente", "tipo_laboral", "salario_cliente", "puntaje", "puntaje_datacredito",
                "promedio_ingresos_datacredito", "tendencia_ingresos", "huella_consulta", "total_otros_prestamos",
                "cant_creditosvigentes", "creditos_sectorFinanciero", "creditos_sectorCooperativo",
                "creditos_sectorReal", "saldo_total", "saldo_principal", "saldo_mora", "saldo_mora_codeudor",
                "Pago_atiempo"]
RAW_NUMERIC = ["capital_prestado", "plazo_meses", "cuota_pactada", "edad_cliente", "salario_cliente", "puntaje",
               "puntaje_datacredito", "promedio_ingresos_datacredito", "huella_consulta", "total_otros_prestamos",
               "cant_creditosvigentes", "creditos_sectorFinanciero", "creditos_sectorCooperativo",
               "creditos_sectorReal", "saldo_total", "saldo_principal", "saldo_mora", "saldo_mora_codeudor"]


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def eda_frame(spark, sf_dir, materialize: bool = True):
    """The EDA's working frame: raw loans, trend whitelisted, flag on raw balances.
    Single-pass queries pass ``materialize=False`` (nothing to reuse)."""
    df = FL.whitelist_column(loans_base(spark, sf_dir, materialize), "tendencia_ingresos", P.TREND_LEVELS)
    return D.add_flag(df)


# =========================================================================== sources / projections

@register("s_loan_table")
def q_loan_table(spark, sf_dir):
    """The 23-column loan table read and derived from the driver tables."""
    return loan_table(spark, sf_dir)


@register("p_table_info")
def q_table_info(spark, sf_dir):
    """Column position, Spark type and non-null count of the loan table."""
    return PR.table_info(loan_table(spark, sf_dir)).drop("dtype")


@register("p_head")
def q_head(spark, sf_dir):
    """First five loans by key (a top-k report)."""
    return PR.head(loan_table(spark, sf_dir).select("loan_id", "tipo_credito", "capital_prestado", "Pago_atiempo"),
                   5, by=["loan_id"])


@register("p_trend_ordinal")
def q_trend_ordinal(spark, sf_dir):
    """F8 + P4: whitelist the ordered trend (junk -> NULL) and rank it."""
    df = PR.with_ordinal(FL.whitelist_column(loan_table(spark, sf_dir), "tendencia_ingresos", P.TREND_LEVELS),
                         "tendencia_ingresos", P.TREND_LEVELS, "tendencia_rank")
    return df.groupBy("tendencia_ingresos", "tendencia_rank").agg(F.count(F.lit(1)).alias("n"))


@register("p_label_map")
def q_label_map(spark, sf_dir):
    """Map the target codes to labels and count them."""
    df = PR.map_labels(loan_table(spark, sf_dir), "Pago_atiempo", P.LABELS, out="etiqueta")
    return df.groupBy("etiqueta").agg(F.count(F.lit(1)).alias("n"))


@register("p_cast_columns")
def q_cast_columns(spark, sf_dir):
    """Int -> double casts and a lenient cast of the dirty trend column."""
    df = PR.cast_columns(loan_table(spark, sf_dir), {"salario_cliente": "double", "plazo_meses": "double",
                                                     "tendencia_ingresos": "int"}, lenient=True)
    return df.agg(F.sum("plazo_meses").alias("sum_plazo"), F.count("tendencia_ingresos").alias("n_numeric_trend"),
                  F.max("tendencia_ingresos").alias("max_numeric_trend"))


# =========================================================================== filters

@register("f_range_filter_report")
def q_range_filter_report(spark, sf_dir):
    """rows before/after the null-keeping range filter."""
    return FL.range_filter_report(loan_table(spark, sf_dir), P.RANGE_BOUNDS)


@register("f_range_filtered_rows")
def q_range_filtered_rows(spark, sf_dir):
    """F1: the filtered rows themselves (key, age, score)."""
    return filtered_loans(spark, sf_dir, materialize=False).select("loan_id", "edad_cliente", "puntaje_datacredito")


@register("f_complete_case")
def q_complete_case(spark, sf_dir):
    """F2 + P1: the complete-case preset (drop seven columns, drop incomplete rows)."""
    return D.complete_case(loan_table(spark, sf_dir)).drop("fecha_prestamo")


@register("f_arrears_rows")
def q_arrears_rows(spark, sf_dir):
    """threshold filter (loans with an arrears balance)."""
    return loan_table(spark, sf_dir).where(F.col("saldo_mora") > 0).select("loan_id", "saldo_mora",
                                                                          "puntaje_datacredito")


@register("f_clip_tail_p99")
def q_clip_tail(spark, sf_dir):
    """keep rows at or below each column's exact p99 (one column at a time)."""
    from riskframe.session import cut_lineage

    cols = ["salario_cliente", "total_otros_prestamos", "saldo_total", "saldo_mora"]
    return _round_cols(FL.clip_tail_report(cut_lineage(loan_table(spark, sf_dir).select(*cols)), cols, 0.99), ["max_kept"])


@register("f_defaulters_by_type")
def q_defaulters_by_type(spark, sf_dir):
    """membership filter (defaulted loans of the main credit types)."""
    df = FL.is_in(FL.is_in(loan_table(spark, sf_dir), "Pago_atiempo", [0]), "tipo_credito", [1, 2, 3])
    return df.groupBy("tipo_credito").agg(F.count(F.lit(1)).alias("n"))


@register("f_domain_rules")
def q_domain_rules(spark, sf_dir):
    """domain-rule violation counts."""
    return FL.check_rules(loan_table(spark, sf_dir), P.DOMAIN_RULES).withColumn(
        "pct_violations", r6("pct_violations"))


@register("f_enforce_schema")
def q_enforce_schema(spark, sf_dir):
    """enforce the scoring schema on the loans; accepted vs rejected rows."""
    from riskframe.plans.scoring import SCORING_SCHEMA

    acc, rej = FL.enforce_schema(D.base_pipeline(filtered_loans(spark, sf_dir)).drop("Pago_atiempo")
                                 .withColumn("edad_cliente", F.col("edad_cliente").cast("double")), SCORING_SCHEMA)
    return (acc.agg(F.count(F.lit(1)).alias("n")).select(F.lit("accepted").alias("status"), "n")
            .unionByName(rej.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected").alias("status"), "n")))


# =========================================================================== quality

@register("q_null_counts")
def q_null_counts(spark, sf_dir):
    """Q1: null count for every column of the loan table."""
    return Q.null_counts(loan_table(spark, sf_dir))


@register("q_null_pct")
def q_null_pct(spark, sf_dir):
    """Q2: null share per column, highest first."""
    return Q.null_pct(loan_table(spark, sf_dir)).withColumn("pct_null", r6("pct_null"))


@register("q_high_null_columns")
def q_high_null(spark, sf_dir):
    """Q3: columns with more than 15% nulls (after whitelisting the trend)."""
    df = FL.whitelist_column(loan_table(spark, sf_dir), "tendencia_ingresos", P.TREND_LEVELS)
    return Q.high_null_columns(df, 0.15).withColumn("pct_null", r6("pct_null"))


@register("q_zero_counts")
def q_zero_counts(spark, sf_dir):
    """Q4: zero count per numeric column."""
    return Q.zero_counts(loan_table(spark, sf_dir), RAW_NUMERIC)


@register("q_sentinel_scan")
def q_sentinel_scan(spark, sf_dir):
    """Q5: disguised-null markers per column (all columns reported)."""
    cols = [c for c in LOAN_COLUMNS if c != "fecha_prestamo"]
    out = Q.sentinel_scan(loan_table(spark, sf_dir), cols, only_hits=False)
    return out.select("variable", "n_hits", F.array_join("hits", ",").alias("hits"))


@register("q_distinct_values")
def q_distinct_values(spark, sf_dir):
    """Q6: distinct values of the discrete columns."""
    cols = ["tipo_credito", "tipo_laboral", "tendencia_ingresos", "plazo_meses", "huella_consulta", "Pago_atiempo"]
    return Q.distinct_values(loan_table(spark, sf_dir), cols)


@register("q_distinct_counts")
def q_distinct_counts(spark, sf_dir):
    """Q6: number of distinct non-null values per column."""
    return Q.distinct_counts(loan_table(spark, sf_dir), [c for c in LOAN_COLUMNS if c != "fecha_prestamo"])


@register("q_value_counts")
def q_value_counts(spark, sf_dir):
    """Q7: value counts with shares of the categorical columns (nulls kept)."""
    df = FL.whitelist_column(loan_table(spark, sf_dir), "tendencia_ingresos", P.TREND_LEVELS)
    out = Q.value_counts(df, ["tipo_credito", "tipo_laboral", "tendencia_ingresos", "Pago_atiempo"],
                         dropna=False, normalize=True)
    return out.withColumn("share", r6("share"))


@register("q_fit_medians")
def q_fit_medians(spark, sf_dir):
    """Q8 fit: exact medians of the four imputed columns on the filtered loans."""
    return Q.fit_medians(filtered_loans(spark, sf_dir), P.IMPUTE_COLUMNS)


@register("d_base_pipeline")
def q_base_pipeline(spark, sf_dir):
    """Q8 + D1 + D2 + D9 + P1: filter, drop, impute, derive, drop."""
    return clean_loans(spark, sf_dir).withColumn("ratio_capital_salario", r6("ratio_capital_salario"))


# =========================================================================== aggregates

def _round_cols(df, cols):
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("a_describe_numeric")
def q_describe_numeric(spark, sf_dir):
    """A1: describe every numeric feature of the cleaned loans (exact quantiles)."""
    out = A.describe_numeric(clean_loans(spark, sf_dir), P.NUMERIC_FEATURES)
    return _round_cols(out, ["mean", "std", "p25", "p50", "p75"])


@register("a_describe_categorical")
def q_describe_categorical(spark, sf_dir):
    """A2: count / unique / top / freq of the categorical columns."""
    df = eda_frame(spark, sf_dir, materialize=False).withColumn("tipo_credito", F.col("tipo_credito").cast("string"))
    return A.describe_categorical(df, ["tipo_credito", "tipo_laboral", "tendencia_ingresos"])


@register("a_describe_by")
def q_describe_by(spark, sf_dir):
    """A3: score distribution by arrears flag (computed on raw balances)."""
    out = A.describe_by(eda_frame(spark, sf_dir), "tiene_mora", "puntaje_datacredito")
    return _round_cols(out, ["mean", "std", "p25", "p50", "p75"])


@register("a_quantiles")
def q_quantiles(spark, sf_dir):
    """A4: exact quantiles of money columns."""
    out = A.quantiles(clean_loans(spark, sf_dir), ["capital_prestado", "salario_cliente", "saldo_total"],
                      [0.01, 0.1, 0.5, 0.9, 0.99])
    return _round_cols(out, ["quantile"])


@register("a_quantiles_approx")
def q_quantiles_approx(spark, sf_dir):
    """A4 at-scale option: one-pass ``percentile_approx`` (no exact oracle)."""
    return A.quantiles(clean_loans(spark, sf_dir), ["capital_prestado", "salario_cliente", "saldo_total"],
                       [0.01, 0.1, 0.5, 0.9, 0.99], approx=True)


@register("a_corr_with_target")
def q_corr_with_target(spark, sf_dir):
    """A5: Pearson correlation of each raw numeric column with the target."""
    return _round_cols(A.corr_with(loan_table(spark, sf_dir), P.TARGET, RAW_NUMERIC), ["corr"])


@register("a_corr_matrix")
def q_corr_matrix(spark, sf_dir):
    """Pairwise-complete correlation matrix of the cleaned numeric features."""
    return _round_cols(A.corr_matrix(clean_loans(spark, sf_dir), P.NUMERIC_FEATURES), ["corr"])


@register("a_redundant_pairs")
def q_redundant_pairs(spark, sf_dir):
    """Raw column pairs with |r| >= 0.7."""
    return _round_cols(A.redundant_pairs(loan_table(spark, sf_dir), RAW_NUMERIC, 0.7), ["corr"])


@register("a_leakage")
def q_leakage(spark, sf_dir):
    """Columns with |corr with target| > 0.9 (leakage)."""
    return _round_cols(A.leakage_candidates(loan_table(spark, sf_dir), P.TARGET, RAW_NUMERIC, 0.9), ["corr"])


@register("a_count_pivot_quadrant")
def q_count_pivot(spark, sf_dir):
    """A8 + D6: counts by median quadrant x target."""
    return A.count_pivot(D.add_quadrant(eda_frame(spark, sf_dir)), "grupo_riesgo", P.TARGET, [0, 1])


@register("a_rate_by_job")
def q_rate_by_job(spark, sf_dir):
    """Default rate by employment type."""
    return _round_cols(A.event_rate(eda_frame(spark, sf_dir, materialize=False), ["tipo_laboral"], P.TARGET, P.EVENT), ["rate"])


@register("a_rate_job_x_inquiry")
def q_rate_job_inquiry(spark, sf_dir):
    """A10: default rate by employment type x inquiry band."""
    df = D.add_band(eda_frame(spark, sf_dir, materialize=False), "huella_consulta", P.INQUIRY_EDGES, P.INQUIRY_LABELS, "huella_cat")
    out = A.event_rate_pivot(df, "tipo_laboral", "huella_cat", P.INQUIRY_LABELS, P.TARGET, P.EVENT)
    return _round_cols(out, P.INQUIRY_LABELS)


@register("a_rate_age_x_job")
def q_rate_age_job(spark, sf_dir):
    """A10: default rate by age band x employment type."""
    df = D.add_band(eda_frame(spark, sf_dir, materialize=False), "edad_cliente", P.AGE_EDGES, P.AGE_LABELS, "grupo_edad")
    out = A.event_rate_pivot(df, "grupo_edad", "tipo_laboral", ["Empleado", "Independiente"], P.TARGET, P.EVENT)
    return _round_cols(out, ["Empleado", "Independiente"])


@register("a_overall_rate")
def q_overall_rate(spark, sf_dir):
    """Overall default rate."""
    return _round_cols(A.event_rate(loan_table(spark, sf_dir), [], P.TARGET, P.EVENT), ["rate"])


@register("a_crosstab")
def q_crosstab(spark, sf_dir):
    """Credit type x target, absolute."""
    return A.crosstab(loan_table(spark, sf_dir), "tipo_credito", P.TARGET, [0, 1], prefix="y_")


@register("a_crosstab_pct")
def q_crosstab_pct(spark, sf_dir):
    """Credit type x target, row percent."""
    out = A.crosstab_pct(loan_table(spark, sf_dir), "tipo_credito", P.TARGET, [0, 1], prefix="pct_")
    return _round_cols(out, ["pct_0", "pct_1"])


@register("a_histogram")
def q_histogram(spark, sf_dir):
    """40-bin equal-width histograms of every cleaned numeric feature."""
    return A.histogram(clean_loans(spark, sf_dir), P.NUMERIC_FEATURES, 40)


@register("a_histogram_by_class")
def q_histogram_by_class(spark, sf_dir):
    """50-bin histograms split by target."""
    out = A.histogram(clean_loans(spark, sf_dir), ["capital_prestado", "edad_cliente", "puntaje_datacredito"], 50,
                      by=P.TARGET)
    return _round_cols(out, ["bin_lo", "bin_hi"])


@register("a_box_stats")
def q_box_stats(spark, sf_dir):
    """Box-plot numbers of every cleaned feature by target."""
    out = A.box_stats(clean_loans(spark, sf_dir), P.NUMERIC_FEATURES, [P.TARGET])
    return _round_cols(out, ["q1", "median", "q3", "iqr"])


@register("a_class_ratio")
def q_class_ratio(spark, sf_dir):
    """Majority / minority ratio."""
    return A.class_ratio(clean_loans(spark, sf_dir), P.TARGET)


@register("a_class_weights")
def q_class_weights(spark, sf_dir):
    """Balanced class weights."""
    return _round_cols(A.class_weights(clean_loans(spark, sf_dir), P.TARGET), ["weight"])


@register("a_shape")
def q_shape(spark, sf_dir):
    """Rows x columns of the cleaned table."""
    return A.shape(clean_loans(spark, sf_dir))


# =========================================================================== features

@register("d_age_bands")
def q_age_bands(spark, sf_dir):
    """D4 + D8 + A9: default rate per age band, with the band order."""
    df = D.add_band(eda_frame(spark, sf_dir, materialize=False), "edad_cliente", P.AGE_EDGES, P.AGE_LABELS, "grupo_edad", "grupo_edad_ord")
    return _round_cols(A.event_rate(df, ["grupo_edad", "grupo_edad_ord"], P.TARGET, P.EVENT), ["rate"])


@register("d_ratio_segments")
def q_ratio_segments(spark, sf_dir):
    """D3 + D5 + A9: default rate by capital/salary segment, last edge = column max."""
    df = D.ratio_segments(eda_frame(spark, sf_dir))
    return _round_cols(A.event_rate(df, ["segmento_ratio", "segmento_ratio_ord"], P.TARGET, P.EVENT), ["rate"])


@register("d_quadrant_rates")
def q_quadrant_rates(spark, sf_dir):
    """D6 + A9: default rate by median quadrant (score x inquiries)."""
    df = D.add_quadrant(eda_frame(spark, sf_dir))
    return _round_cols(A.event_rate(df, ["grupo_riesgo"], P.TARGET, P.EVENT), ["rate"])


@register("d_three_sectors")
def q_three_sectors(spark, sf_dir):
    """D7 + A9: default rate of clients with credits in all three sectors."""
    df = D.add_all_positive(eda_frame(spark, sf_dir, materialize=False), ["creditos_sectorFinanciero", "creditos_sectorCooperativo",
                                                        "creditos_sectorReal"], "en_3_sectores")
    return _round_cols(A.event_rate(df, ["en_3_sectores"], P.TARGET, P.EVENT), ["rate"])


# =========================================================================== splits

from riskframe.operators import drift as K  # noqa: E402
from riskframe.operators import evaluation as V  # noqa: E402
from riskframe.operators import sampling as R  # noqa: E402
from riskframe.operators.rules import rule_classifier  # noqa: E402

SEED = 42
STRICT = {"puntaje_muy_bajo": 650.0, "puntaje_moderado": 800.0, "puntaje_independiente": 750.0,
          "edad_joven": 35, "ratio_alto": 2.0, "huella_alta": 6}
LENIENT = {"puntaje_muy_bajo": 550.0, "puntaje_moderado": 700.0, "puntaje_independiente": 650.0,
           "edad_joven": 25, "ratio_alto": 4.0, "huella_alta": 10}


def split_loans(spark, sf_dir):
    """R1 over the cleaned loans with the portable seeded order. The split table is
    read by several later steps, so its lineage is cut once (reliable checkpoint)."""
    from riskframe.session import cut_lineage

    return _shared(("split", sf_dir), lambda: cut_lineage(
        R.stratified_split(clean_loans(spark, sf_dir), P.TARGET, P.KEY, 0.2, SEED, order="md5")))


def train_rows(spark, sf_dir):
    return split_loans(spark, sf_dir).where(F.col("split") == "train").drop("split")


def test_rows(spark, sf_dir):
    return split_loans(spark, sf_dir).where(F.col("split") == "test").drop("split")


@register("r_stratified_split")
def q_stratified_split(spark, sf_dir):
    """Exact stratified 80/20 split."""
    return split_loans(spark, sf_dir).select(P.KEY, P.TARGET, "split")


@register("r_sample_n")
def q_sample_n(spark, sf_dir):
    """R2: production sample max(50, 10%) of the test rows."""
    return R.sample_n(test_rows(spark, sf_dir), P.KEY, 0.1, 50, SEED, order="md5").select(P.KEY)


@register("r_kfold")
def q_kfold(spark, sf_dir):
    """10 contiguous unshuffled folds of the training rows."""
    return R.kfold(train_rows(spark, sf_dir), [P.KEY], 10).select(P.KEY, "fold")


@register("r_stratified_kfold")
def q_stratified_kfold(spark, sf_dir):
    """Shuffled stratified 5 folds of the training rows."""
    return R.stratified_kfold(train_rows(spark, sf_dir), P.TARGET, P.KEY, 5, SEED, order="md5").select(
        P.KEY, P.TARGET, "fold")


FRACTIONS = (0.1, 0.325, 0.55, 0.775, 1.0)


def _shuffle(spark, sf_dir, prepare=lambda rows: rows):
    rows = train_rows(spark, sf_dir).select(P.KEY, P.TARGET, *P.NUMERIC_FEATURES, "tipo_laboral")
    return R.shuffle_splits(prepare(rows), P.KEY, 50, 0.2, 123, order="md5", train_fractions=FRACTIONS)


@register("r_shuffle_splits")
def q_shuffle_splits(spark, sf_dir):
    """50 random 80/20 splits (seed 123): size and key checksum per split and role."""
    return _shuffle(spark, sf_dir).groupBy("split_id", "role").agg(
        F.count(F.lit(1)).alias("n"), F.sum(P.KEY).alias("key_sum"))


def _sizes(spark, sf_dir):
    n = train_rows(spark, sf_dir).count()
    n_train = n - int(-(-n * 0.2 // 1))   # n - ceil(0.2 n)
    return R.train_size_grid(n_train, FRACTIONS)


@register("r_train_sizes")
def q_train_sizes(spark, sf_dir):
    """Nested training subsets (10% .. 100%) of every split."""
    tr = _shuffle(spark, sf_dir).where(F.col("size_idx").isNotNull())
    per = tr.groupBy("split_id", "size_idx").agg(F.count(F.lit(1)).alias("n"), F.sum(P.KEY).alias("key_sum"))
    w = W.partitionBy("split_id").orderBy("size_idx").rowsBetween(W.unboundedPreceding, 0)   # <= 5 rows per split
    return per.select("split_id", "size_idx", F.sum("n").over(w).alias("n"), F.sum("key_sum").over(w).alias("key_sum"))


@register("r_smote")
def q_smote(spark, sf_dir):
    """SMOTE on the encoded training rows (no SQL oracle: rows only)."""
    from riskframe.operators.encoding import fit_preprocessor

    train = train_rows(spark, sf_dir)
    prep, names = fit_preprocessor(train, P.NUMERIC_FEATURES, P.CATEGORICAL_FEATURES)
    enc = prep.transform(train).select(P.KEY, P.TARGET, *names)
    return R.smote(enc, P.TARGET, names, P.KEY, minority=0, k=3, seed=SEED)


# =========================================================================== rule model and evaluation

from pyspark.sql import Window as W  # noqa: E402


def scored_test(spark, sf_dir, thresholds=None):
    return rule_classifier(test_rows(spark, sf_dir), thresholds)


@register("m_rule_predictions")
def q_rule_predictions(spark, sf_dir):
    """M1: rule classifier over the cleaned loans."""
    return rule_classifier(clean_loans(spark, sf_dir)).select(P.KEY, "prediction", "rule_hit", "rule_count")


@register("v_confusion_matrix")
def q_confusion(spark, sf_dir):
    """V1: confusion matrix of the rule model on the test rows."""
    return V.confusion_matrix(scored_test(spark, sf_dir), P.TARGET, "prediction", [0, 1])


METRIC_COLS = ["accuracy", "balanced_accuracy", "precision", "recall", "f1", "fbeta"]


@register("v_binary_metrics")
def q_binary_metrics(spark, sf_dir):
    """V2: metrics of the rule model for the default class (pos_label 0)."""
    return _round_cols(V.binary_metrics(scored_test(spark, sf_dir), P.TARGET, "prediction", 0, 2.0), METRIC_COLS)


@register("v_roc_auc")
def q_roc_auc(spark, sf_dir):
    """V3: ROC-AUC with ties: rules fired (for default) and bureau score (for paying)."""
    t = scored_test(spark, sf_dir)
    a = V.roc_auc(t, P.TARGET, "rule_count", 0).select(F.lit("rule_count").alias("score"), "roc_auc")
    b = V.roc_auc(t, P.TARGET, "puntaje_datacredito", 1).select(F.lit("puntaje_datacredito").alias("score"), "roc_auc")
    return _round_cols(a.unionByName(b), ["roc_auc"])


@register("v_classification_report")
def q_classification_report(spark, sf_dir):
    """V4: per-class precision/recall/F1/support with averages."""
    return _round_cols(V.classification_report(scored_test(spark, sf_dir), P.TARGET, "prediction", [0, 1]),
                       ["precision", "recall", "f1"])


@register("v_roc_curve")
def q_roc_curve(spark, sf_dir):
    """V5: ROC points of the bureau score for the paying class."""
    return _round_cols(V.roc_curve(scored_test(spark, sf_dir), P.TARGET, "puntaje_datacredito", 1), ["fpr", "tpr"])


@register("v_pr_curve")
def q_pr_curve(spark, sf_dir):
    """V6: precision-recall points of the rules-fired count for the default class."""
    return _round_cols(V.pr_curve(scored_test(spark, sf_dir), P.TARGET, "rule_count", 0), ["precision", "recall"])


def _fold_counts(df, fold_col, pos_label):
    """Per-fold held-out counts and the complementary training counts (total - fold)."""
    c = V.confusion_counts(df, P.TARGET, "prediction", pos_label, [fold_col])
    tot = c.agg(*[F.sum(x).alias(f"t_{x}") for x in ("tp", "fp", "fn", "tn", "n")])
    both = attach(c, tot)
    test = both.select(fold_col, F.lit("test").alias("part"), "tp", "fp", "fn", "tn")
    train = both.select(fold_col, F.lit("train").alias("part"),
                        *[(F.col(f"t_{x}") - F.col(x)).alias(x) for x in ("tp", "fp", "fn", "tn")])
    return test.unionByName(train)


from riskframe.operators.ranking import attach, local_frame, materialize_small  # noqa: E402


@register("v_cv_metrics")
def q_cv_metrics(spark, sf_dir):
    """V7: 10-fold (contiguous) metrics of the rule model, held-out and training part."""
    folds = R.kfold(rule_classifier(train_rows(spark, sf_dir)), [P.KEY], 10)
    m = V.metrics_from_counts(_fold_counts(folds, "fold", 0), ["accuracy", "precision", "recall", "f1"])
    return _round_cols(m.select("fold", "part", "accuracy", "precision", "recall", "f1"),
                       ["accuracy", "precision", "recall", "f1"])


@register("v_fold_summary")
def q_fold_summary(spark, sf_dir):
    """V8: train mean, CV mean and CV sample std of each metric over the 10 folds."""
    folds = R.kfold(rule_classifier(train_rows(spark, sf_dir)), [P.KEY], 10)
    m = V.metrics_from_counts(_fold_counts(folds, "fold", 0), ["accuracy", "precision", "recall", "f1"])
    s = V.fold_summary(m, ["accuracy", "precision", "recall", "f1"], ["part"], sample_std=True)
    out = s.groupBy("metric").agg(F.max(F.when(F.col("part") == "train", F.col("mean"))).alias("train_score"),
                                  F.max(F.when(F.col("part") == "test", F.col("mean"))).alias("cv_mean"),
                                  F.max(F.when(F.col("part") == "test", F.col("std"))).alias("cv_std"))
    return _round_cols(out, ["train_score", "cv_mean", "cv_std"])


@register("v_learning_curve")
def q_learning_curve(spark, sf_dir):
    """V9: rule-model learning curve: recall (default class) on nested training
    subsets and on the held-out part of 50 random splits; mean and population std.
    One pass over the expanded split rows: counts per (split, role, size) -- a
    50 x 7 table -- from which both curves are derived."""
    sizes = _sizes(spark, sf_dir)
    sp = _shuffle(spark, sf_dir, lambda rows: rule_classifier(rows).select(P.KEY, P.TARGET, "prediction"))   # once per row
    y0, p0 = F.col(P.TARGET) == 0, F.col("prediction") == 0
    cnt = materialize_small(sp.groupBy("split_id", "role", "size_idx").agg(
        F.sum(F.when(y0 & p0, 1).otherwise(0)).alias("tp"), F.sum(F.when(y0, 1).otherwise(0)).alias("pos")))
    w = W.partitionBy("split_id").orderBy("size_idx").rowsBetween(W.unboundedPreceding, 0)   # <= 5 rows per split
    tr = cnt.where(F.col("size_idx").isNotNull()).select(
        "split_id", "size_idx", V._div(F.sum("tp").over(w), F.sum("pos").over(w)).alias("train_recall"))
    te = cnt.where(F.col("role") == "test").select("split_id", V._div(F.col("tp"), F.col("pos")).alias("test_recall"))
    size_tbl = local_frame(spark, [(i, s_) for i, s_ in enumerate(sizes)], "size_idx int, train_size int")
    j = tr.join(te, "split_id").join(size_tbl, "size_idx")
    out = j.groupBy("train_size").agg(F.avg("train_recall").alias("train_mean"), F.stddev_pop("train_recall").alias("train_std"),
                                      F.avg("test_recall").alias("test_mean"), F.stddev_pop("test_recall").alias("test_std"))
    return _round_cols(out, ["train_mean", "train_std", "test_mean", "test_std"])


def _logistic_curve(spark, sf_dir):
    from riskframe.operators.logistic import logistic_learning_curve

    return logistic_learning_curve(train_rows(spark, sf_dir), P.KEY, P.TARGET, P.NUMERIC_FEATURES, P.CATEGORICAL_FEATURES,
                                   50, 0.2, 123, FRACTIONS, P.EVENT)


@register("v_learning_curve_logreg")
def q_learning_curve_logreg(spark, sf_dir):
    """V9 for the logistic candidate: 250 fits in batched Newton steps; mean and population
    std of train and held-out recall (default class), fit and score seconds per size."""
    curve = _logistic_curve(spark, sf_dir)
    parts = (("train", "train_recall"), ("test", "test_recall"), ("fit_time", "fit_time"), ("score_time", "score_time"))
    return curve.groupBy("train_size").agg(*[e for name, c in parts for e in (
        F.avg(c).alias(f"{name}_mean"), F.stddev_pop(c).alias(f"{name}_std"))])


@register("v_learning_curve_checks")
def q_learning_curve_checks(spark, sf_dir):
    """V9 for the logistic candidate: per size the fits, the default rows they learnt from
    and were scored on over all splits, the largest score equation at the fitted coefficients
    (zero to 4 digits) and the fits without a recall in [0, 1] or without a time."""
    curve = _logistic_curve(spark, sf_dir)
    odd = ~(F.col("train_recall").between(0, 1) & F.col("test_recall").between(0, 1)
            & (F.col("fit_time") > 0) & (F.col("score_time") > 0))
    return curve.groupBy("train_size").agg(
        F.count(F.lit(1)).alias("n_fits"), F.sum("n_train_pos").alias("n_train_pos"), F.sum("n_test_pos").alias("n_test_pos"),
        F.round(F.max("score_equation"), 4).alias("score_equation"), F.count(F.when(odd, 1)).alias("n_odd"))


def _candidates(spark, sf_dir):
    """Rule-model variants evaluated by stratified 5-fold CV and on the test rows."""
    train, test = train_rows(spark, sf_dir), test_rows(spark, sf_dir)
    folds = R.stratified_kfold(train, P.TARGET, P.KEY, 5, SEED, order="md5")
    out = None
    for name, th in (("heuristic", None), ("heuristic_strict", STRICT), ("heuristic_lenient", LENIENT)):
        cv = V.binary_metrics(rule_classifier(folds, th), P.TARGET, "prediction", 0, 2.0, ["fold"])
        cvs = cv.agg(F.avg("fbeta").alias("cv_fbeta_mean"), F.stddev_pop("fbeta").alias("cv_fbeta_std"),
                     F.lit(0.0).alias("cv_fit_time_mean"))
        st = rule_classifier(test, th).withColumn("__s", (F.col("prediction") == 0).cast("int"))
        tm = V.binary_metrics(st, P.TARGET, "prediction", 0, 2.0).select(
            F.col("recall").alias("test_recall"), F.col("f1").alias("test_f1"), F.col("fbeta").alias("test_fbeta"),
            F.col("n_pred_pos").alias("casos_mora_pred"))
        auc = V.roc_auc(st, P.TARGET, "__s", 0).select(F.col("roc_auc").alias("test_roc_auc"))
        row = attach(attach(cvs, tm), auc).select(F.lit(name).alias("modelo"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@register("v_selection")
def q_selection(spark, sf_dir):
    """V10 + V11 + J5: selection score and ranking of candidate models. The variants are
    rules, fitted in no time, so the speed term is the same for all; measured fit times
    enter in ``m_candidates``."""
    ranked = V.rank_candidates(V.selection_score(_candidates(spark, sf_dir)))
    return _round_cols(ranked, ["cv_fbeta_mean", "cv_fbeta_std", "test_recall", "test_f1", "test_fbeta", "test_roc_auc",
                                "selection_score"])


@register("v_stability")
def q_stability(spark, sf_dir):
    """Per-metric stability over stratified 5 folds (class 1, population std)."""
    folds = rule_classifier(R.stratified_kfold(train_rows(spark, sf_dir), P.TARGET, P.KEY, 5, SEED, order="md5"))
    m = V.binary_metrics(folds, P.TARGET, "prediction", 1, 2.0, ["fold"])
    folds = folds.withColumn("__s", F.col("prediction").cast("double"))
    auc = V.roc_auc(folds, P.TARGET, "__s", 1, ["fold"])
    per = m.join(auc, "fold")
    out = V.stability_verdict(per, ["accuracy", "f1", "roc_auc", "recall", "precision"])
    return _round_cols(out.drop("n_folds"), ["mean", "std"])


@register("v_compare")
def q_compare(spark, sf_dir):
    """V13 + J3: default vs strict rule model on the test rows, winner per metric."""
    names = ["accuracy", "precision", "recall", "f1", "fbeta"]
    a = V.metrics_long(V.binary_metrics(scored_test(spark, sf_dir), P.TARGET, "prediction", 0), names)
    b = V.metrics_long(V.binary_metrics(scored_test(spark, sf_dir, STRICT), P.TARGET, "prediction", 0),
                       names[:-1] + ["balanced_accuracy"])
    return _round_cols(V.compare_metrics(a, b, "local", "other"), ["local", "other"])


def _sweep(spark, sf_dir):
    t = scored_test(spark, sf_dir).withColumn("score_mora", F.col("rule_count") / 5.0)
    return V.threshold_sweep(t, P.TARGET, "score_mora", 0, 20, 2.0)


@register("v_threshold_sweep")
def q_threshold_sweep(spark, sf_dir):
    """Metrics at 21 thresholds of the rules-fired share."""
    return _round_cols(_sweep(spark, sf_dir), ["threshold", "accuracy", "precision", "recall", "f1", "fbeta"])


@register("v_near_threshold")
def q_near_threshold(spark, sf_dir):
    """Metrics at the threshold nearest 0.5."""
    return _round_cols(V.metrics_near_threshold(_sweep(spark, sf_dir), 0.5),
                       ["threshold", "accuracy", "precision", "recall", "f1", "fbeta"])


# =========================================================================== drift

# every numeric column of the training features, the nominal code included
DRIFT_COLUMNS = ["tipo_credito", *P.NUMERIC_FEATURES]

def _drift(spark, sf_dir):
    ref = train_rows(spark, sf_dir)
    prod = R.sample_n(test_rows(spark, sf_dir).select(P.KEY, *DRIFT_COLUMNS), P.KEY, 0.1, 50, SEED, order="md5")
    return K.ks_report(ref.select(*DRIFT_COLUMNS), prod, DRIFT_COLUMNS)


@register("k_ks_report")
def q_ks_report(spark, sf_dir):
    """K1 + J4: KS drift report, training rows vs a production sample of the test rows."""
    return _drift(spark, sf_dir)


def events_periods(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "ts", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    cut = F.lit("2024-01-15").cast("timestamp")
    return ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)


@register("k_ks_events")
def q_ks_events(spark, sf_dir):
    """K1 on the event stream: first two weeks vs the rest, for value and props.k."""
    ref, prod = events_periods(spark, sf_dir)
    return K.ks_report(ref, prod, ["value", "k"])


@register("k_drift_status")
def q_drift_status(spark, sf_dir):
    """K3: overall drift status."""
    return K.drift_status(_drift(spark, sf_dir))


@register("k_drifted_variables")
def q_drifted_variables(spark, sf_dir):
    """K3: drifted variables."""
    return K.drifted_variables(_drift(spark, sf_dir))


@register("k_top_statistic")
def q_top_statistic(spark, sf_dir):
    """K4: top-10 variables by KS statistic."""
    return K.top_by_statistic(_drift(spark, sf_dir), 10).select("variable", "ks_statistic")


@register("k_top_mean_shift")
def q_top_mean_shift(spark, sf_dir):
    """K5: top-8 variables by absolute mean difference."""
    return _round_cols(K.top_mean_shift(_drift(spark, sf_dir), 8), ["mean_diff"])


@register("k_prediction_mix")
def q_prediction_mix(spark, sf_dir):
    """K6: labelled prediction mix of the production sample."""
    prod = rule_classifier(R.sample_n(test_rows(spark, sf_dir), P.KEY, 0.1, 50, SEED, order="md5"))
    prod = PR.map_labels(prod, "prediction", P.LABELS, out="etiqueta")
    return Q.value_counts(prod, ["etiqueta"]).select(F.col("value").alias("etiqueta"), "count")


def stored_reference(spark, sf_dir):
    """K2: the training rows' snapshot, stored as a version and opened again by its folder."""
    import uuid

    from riskframe.session import checkpoint_dir
    from riskframe.sources.snapshots import open_snapshot, save_snapshot

    root = f"{checkpoint_dir(spark).rstrip('/')}/riskframe-snapshots/{uuid.uuid4().hex}"
    save_snapshot(train_rows(spark, sf_dir).select(*DRIFT_COLUMNS), DRIFT_COLUMNS, root)
    return open_snapshot(spark, root)


@register("k_monitoring_cycle")
def q_monitoring_cycle(spark, sf_dir):
    """K7: sample -> score -> drift -> report with the overall status attached."""
    from riskframe.plans.monitoring import monitoring_cycle

    res = monitoring_cycle(stored_reference(spark, sf_dir), test_rows(spark, sf_dir), P.KEY, DRIFT_COLUMNS)
    return res["report"].select("variable", "ks_statistic", "p_value", "drift_detectado", "n_muestra", "hay_drift")


@register("k_check_batch")
def q_check_batch(spark, sf_dir):
    """K8: on-demand check of a batch (the Independiente test loans) against training."""
    batch = test_rows(spark, sf_dir).where(F.col("tipo_laboral") == "Independiente")
    return K.check_batch(train_rows(spark, sf_dir), batch.select(*DRIFT_COLUMNS))


@register("k_period_stats")
def q_period_stats(spark, sf_dir):
    """K9 (batch form): 7-day tumbling-window counts and mean value per event type,
    the same aggregation the streaming job maintains."""
    from riskframe.streaming.monitor import period_stats

    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return _round_cols(period_stats(ev, "7 days"), ["mean_value"])


# =========================================================================== Spark ML models (rows-only checks)

def _fit_and_score(spark, sf_dir, name, **kw):
    from riskframe.operators.models import fit_candidate
    from riskframe.plans.training import evaluate, score_rows

    train, test = train_rows(spark, sf_dir), test_rows(spark, sf_dir)
    model = fit_candidate(train, name, P.NUMERIC_FEATURES, P.CATEGORICAL_FEATURES, P.TARGET, key=P.KEY,
                          use_smote=True, **kw)
    return evaluate(score_rows(model, test)).select(F.lit(name).alias("modelo"), "recall", "f1", "fbeta", "roc_auc",
                                                    "n_pred_pos")


@register("m_logreg_batch_score")
def q_logreg_batch_score(spark, sf_dir):
    """M2 + M6 + M7 + M8: balanced logistic regression (with SMOTE on the encoded
    training rows), batch-scored on the test rows."""
    from riskframe.operators.models import batch_score, fit_candidate

    model = fit_candidate(train_rows(spark, sf_dir), "logreg", P.NUMERIC_FEATURES, P.CATEGORICAL_FEATURES, P.TARGET,
                          use_smote=True, key=P.KEY)
    return batch_score(model, test_rows(spark, sf_dir), keep=[P.KEY])


@register("m_random_forest")
def q_random_forest(spark, sf_dir):
    """M3: 100-tree balanced random forest, test metrics for the default class."""
    return _fit_and_score(spark, sf_dir, "random_forest")


@register("m_gradient_boosting")
def q_gradient_boosting(spark, sf_dir):
    """M4: 100-round gradient boosting, test metrics."""
    return _fit_and_score(spark, sf_dir, "gradient_boosting")


@register("m_xgboost")
def q_xgboost(spark, sf_dir):
    """M5: second-order boosted trees (100 rounds, depth 6, step 0.3, penalty 1) with the class-1
    weight = majority/minority ratio (the original's setting, kept as an option)."""
    tr = train_rows(spark, sf_dir)
    ratio = A.class_ratio(tr, P.TARGET).first()["ratio"]
    return _fit_and_score(spark, sf_dir, "xgboost", scale_pos_weight=ratio)


@register("m_candidates")
def q_candidates(spark, sf_dir):
    """V9-V11 + J5 with Spark ML: 5-fold CV metrics, fit time, test metrics and selection
    score of all four candidates, each fitted with SMOTE."""
    from riskframe.operators.models import CANDIDATES
    from riskframe.plans.training import train_and_select

    train = train_rows(spark, sf_dir)
    ratio = A.class_ratio(train, P.TARGET).first()["ratio"]
    summary, _ = train_and_select(train, test_rows(spark, sf_dir), CANDIDATES, scale_pos_weight=ratio)
    return summary


# =========================================================================== encoding

from riskframe.operators import encoding as EN  # noqa: E402

SCALE_COLS = ["capital_prestado", "salario_cliente", "saldo_total", "puntaje_datacredito", "huella_consulta"]


@register("e_scaler_params")
def q_scaler_params(spark, sf_dir):
    """E1 fit on the training rows only: mean and population std per column."""
    p = EN.fit_scaler(train_rows(spark, sf_dir), SCALE_COLS)
    packed = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"mean_{c}").alias("mean"),
                                F.col(f"std_{c}").alias("std")) for c in SCALE_COLS])
    return _round_cols(p.select(F.inline(packed)), ["mean", "std"])


@register("e_scaled_test")
def q_scaled_test(spark, sf_dir):
    """E1 + E5: the training-fitted scaler applied to the test rows."""
    params = EN.fit_scaler(train_rows(spark, sf_dir), SCALE_COLS)
    out = EN.apply_scaler(test_rows(spark, sf_dir).select(P.KEY, *SCALE_COLS), params, SCALE_COLS)
    return _round_cols(out, SCALE_COLS)


@register("e_one_hot")
def q_one_hot(spark, sf_dir):
    """E2 + E3 + E5: one-hot of the test rows with the training levels
    (unknown/null -> zeros), long format (key, feature, value)."""
    levels = EN.collect_levels(EN.fit_levels(train_rows(spark, sf_dir), P.CATEGORICAL_FEATURES))
    wide = EN.one_hot(test_rows(spark, sf_dir).select(P.KEY, *P.CATEGORICAL_FEATURES), levels)
    names = [c for c in wide.columns if c.startswith("cat__")]
    return wide.unpivot([P.KEY], names, "feature", "value")


# =========================================================================== more projections

@register("p_drop_columns")
def q_drop_columns(spark, sf_dir):
    """Drop the high-null and irrelevant columns (absent names ignored)."""
    return PR.drop_columns(loan_table(spark, sf_dir), P.HIGH_NULL_COLUMNS + P.IRRELEVANT_COLUMNS + ["no_such_column"])


@register("p_numeric_columns")
def q_numeric_columns(spark, sf_dir):
    """The numeric columns of the loan table, chosen from its schema."""
    return PR.select_type(loan_table(spark, sf_dir), "numeric")


@register("p_round_half_even")
def q_round_half_even(spark, sf_dir):
    """Per-credit-type means rounded to 4 decimals half-to-even (numpy rounding)."""
    means = loan_table(spark, sf_dir).groupBy("tipo_credito").agg(
        F.avg("capital_prestado").alias("capital_prestado"), F.avg("salario_cliente").alias("salario_cliente"))
    return PR.round_columns(means, ["capital_prestado", "salario_cliente"], 4, half_even=True)


# =========================================================================== round trips and further operators

def _folder(spark):
    """A new folder under the shared checkpoint folder."""
    import uuid

    from riskframe.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/riskframe-out/{uuid.uuid4().hex}"


@register("s_csv_stage")
def q_csv_stage(spark, sf_dir):
    """S3: a stage written as CSV and read back with its types."""
    from riskframe.sources import io as IO

    df = loan_table(spark, sf_dir).select("loan_id", "plazo_meses", "tipo_laboral", "saldo_principal", "Pago_atiempo")
    path = _folder(spark)
    IO.stage_csv(df, path)
    return IO.read_stage(spark, path, df.schema)


@register("s_full_refresh")
def q_full_refresh(spark, sf_dir):
    """S2 + S4 + S5: a table replaced in a database, scanned with pruned columns."""
    import uuid

    from riskframe.session import cut_lineage
    from riskframe.sources import io as IO

    IO.ensure_namespace(spark, "riskframe_stage")
    table = f"riskframe_stage.loans_{uuid.uuid4().hex}"
    loans = loan_table(spark, sf_dir)
    IO.full_refresh(loans.select("loan_id", "plazo_meses", "Pago_atiempo"), table)
    IO.full_refresh(loans.where(F.col("tipo_laboral") == "Empleado").select("loan_id", "plazo_meses", "Pago_atiempo"), table)
    out = cut_lineage(IO.scan(spark, table, ["loan_id", "Pago_atiempo"]))
    IO.drop_refreshed(spark, table)
    return out


@register("s_metrics_json")
def q_metrics_json(spark, sf_dir):
    """A metrics table as JSON, read back."""
    from riskframe.sources import io as IO

    m = A.class_ratio(loan_table(spark, sf_dir), P.TARGET)
    path = _folder(spark)
    IO.write_metrics(m, path)
    return spark.read.schema(m.schema).json(path)


@register("s_run_log")
def q_run_log(spark, sf_dir):
    """Two runs appended to an experiment log, read back without the time."""
    from riskframe.sources import io as IO

    m = A.class_ratio(loan_table(spark, sf_dir), P.TARGET)
    path = _folder(spark)
    for run in ("first", "second"):
        IO.log_run(m, path, "balance", run)
    return spark.read.parquet(path).drop("logged_at")


@register("s_report")
def q_report(spark, sf_dir):
    """A report saved in partitions and read back."""
    from riskframe.sources import io as IO

    df = loan_table(spark, sf_dir).select("loan_id", "saldo_total", "tipo_laboral")
    path = _folder(spark)
    IO.write_report(df, path, ["tipo_laboral"])
    return spark.read.parquet(path)


@register("p_features_target")
def q_features_target(spark, sf_dir):
    """P5: key, features and target in one table, the target last."""
    return PR.features_and_target(clean_loans(spark, sf_dir).select(P.TARGET, P.KEY, *P.NUMERIC_FEATURES), P.TARGET, [P.KEY])


@register("p_rename")
def q_rename(spark, sf_dir):
    """P10: renamed pivot columns."""
    by = A.count_pivot(loan_table(spark, sf_dir), "tipo_laboral", P.TARGET)
    return PR.rename(by, {"n_0": "mora", "n_1": "al_dia"})


@register("k_reference_snapshot")
def q_reference_snapshot(spark, sf_dir):
    """K2: the stored reference snapshot, summed up per variable."""
    snap = K.reference_snapshot(train_rows(spark, sf_dir).select(*DRIFT_COLUMNS), DRIFT_COLUMNS)
    return snap.groupBy("variable").agg(F.sum("c_ref").alias("n"), F.count(F.lit(1)).alias("n_values"),
                                        F.min("value").alias("lo"), F.max("value").alias("hi"))


@register("k_stored_snapshot")
def q_stored_snapshot(spark, sf_dir):
    """K2 + K1: the drift report against the stored snapshot, which does not read the
    training rows."""
    prod = R.sample_n(test_rows(spark, sf_dir).select(P.KEY, *DRIFT_COLUMNS), P.KEY, 0.1, 50, SEED, order="md5")
    return K.ks_report(stored_reference(spark, sf_dir), prod, DRIFT_COLUMNS)


@register("k_batch_status")
def q_batch_status(spark, sf_dir):
    """K8: status of four batches: whole, one row, without common columns, and no row."""
    reference, test = stored_reference(spark, sf_dir), test_rows(spark, sf_dir)
    batch = test.where(F.col("tipo_laboral") == "Independiente").select(*DRIFT_COLUMNS)
    cases = [("independientes", batch), ("one row", test.where(F.col(P.KEY) == test.agg(F.min(P.KEY)).scalar()).select(*DRIFT_COLUMNS)),
             ("other columns", test.select(F.col("plazo_meses").alias("x"))), ("no row", batch.where(F.lit(False)))]
    out = None
    for name, b in cases:
        row = K.batch_status(reference, b).select(F.lit(name).alias("batch"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@register("k_drift_7_days")
def q_drift_7_days(spark, sf_dir):
    """K9: drift of each 7-day period after the first two weeks of events."""
    ref, prod = events_periods(spark, sf_dir)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"))
    ev = ev.select("ts", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    return K.drift_by_period(ref, ev, ["value", "k"], period="7 days")


@register("k_ks_exact")
def q_ks_exact(spark, sf_dir):
    """K1 with the exact p-value: the first two weeks of events against the rest. Where a side has more
    than 10,000 rows the p-value is the asymptotic one, as in the original."""
    ref, prod = events_periods(spark, sf_dir)
    return K.ks_report(ref, prod, ["value", "k"], digits=None, exact=True).select(
        "variable", F.round("ks_statistic", 9).alias("ks_statistic"), F.round("p_value", 9).alias("p_value"), "drift_detectado")


@register("v_best_candidate")
def q_best_candidate(spark, sf_dir):
    """The name and score of the candidate that is chosen."""
    ranked = V.rank_candidates(V.selection_score(_candidates(spark, sf_dir)))
    return _round_cols(ranked.where("rank = 1").select("modelo", "selection_score"), ["selection_score"])


KNN_COLS = ["plazo_meses", "huella_consulta", "edad_cliente"]


@register("r_nearest_minority")
def q_nearest_minority(spark, sf_dir):
    """The three exact nearest minority neighbours of each minority training row."""
    mino = train_rows(spark, sf_dir).where((F.col(P.TARGET) == 0) & F.col("edad_cliente").isNotNull())
    return R.exact_knn(mino, P.KEY, KNN_COLS, 3, SEED)


@register("r_smote_counts")
def q_smote_counts(spark, sf_dir):
    """Rows per class after SMOTE, real and synthetic."""
    out = R.smote(train_rows(spark, sf_dir).where(F.col("edad_cliente").isNotNull()).select(P.KEY, P.TARGET, *KNN_COLS),
                  P.TARGET, KNN_COLS, P.KEY, minority=0, k=3, seed=SEED)
    return out.groupBy(P.TARGET, "synthetic").agg(F.count(F.lit(1)).alias("n"))


@register("m_model_checks")
def q_model_checks(spark, sf_dir):
    """M2-M7: every candidate fitted with SMOTE and scored on the test rows: rows scored,
    probabilities outside [0, 1] or not adding up to 1, and predictions that are not the
    likelier class."""
    from riskframe.operators.models import CANDIDATES, encode_training, fit_encoded
    from riskframe.plans.training import score_rows

    train, test = train_rows(spark, sf_dir), test_rows(spark, sf_dir)
    ratio = A.class_ratio(train, P.TARGET).first()["ratio"]
    prep, enc = encode_training(train, P.NUMERIC_FEATURES, P.CATEGORICAL_FEATURES, P.TARGET, use_smote=True, key=P.KEY)
    out = None
    for name in CANDIDATES:
        model = fit_encoded(prep, enc, name, scale_pos_weight=ratio if name == "xgboost" else None)
        s = score_rows(model, test)
        p0, p1 = F.col("p_mora"), F.col("p_pago")
        odd = (p0 < 0) | (p1 < 0) | (F.abs(p0 + p1 - 1) > 1e-9)
        off = ((p1 > p0) & (F.col("prediction") != 1)) | ((p0 > p1) & (F.col("prediction") != 0))
        row = s.agg(F.count(F.lit(1)).alias("n_scored"), F.count(F.when(odd, 1)).alias("n_odd"), F.count(F.when(off, 1)).alias("n_off"))
        row = row.select(F.lit(name).alias("modelo"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@register("m_boosting_root")
def q_boosting_root(spark, sf_dir):
    """M5: the first split of second-order boosting over all training rows (class 1 weighs
    2, no penalty, under which some split always gains): variable, threshold (left below it) and the values of both leaves."""
    import json

    from pyspark.ml.functions import array_to_vector

    from riskframe.operators.boosting import Settings, fit_boosted
    from riskframe.operators.ranking import local_frame

    rows = train_rows(spark, sf_dir).where(F.col("edad_cliente").isNotNull()).select(
        array_to_vector(F.array(*[F.col(c).cast("double") for c in KNN_COLS])).alias("features"),
        F.col(P.TARGET).cast("double").alias("label"))
    model = fit_boosted(rows, Settings(rounds=1, max_depth=1, reg_lambda=0.0, scale_pos_weight=2.0))
    body = json.loads(model.getOrDefault("trees"))
    found = [(KNN_COLS[t["feature"][0]], body["cuts"][t["feature"][0]][t["cut"][0]], t["value"][1], t["value"][2])
             for t in body["trees"] if t["feature"][0] >= 0]           # one tree of one split
    out = local_frame(spark, found, "variable string, threshold double, value_left double, value_right double")
    return _round_cols(out, ["threshold", "value_left", "value_right"])
