"""DuckDB-runnable SQL equivalents of the registered queries (the correctness
oracle). They are written independently of the Spark code: plain window
functions and ``quantile_cont`` over the pre-registered driver views."""

from __future__ import annotations

from riskframe.plans import presets as P

LOANS = """
li AS (
  SELECT l_orderkey,
         count(*) AS n_li,
         sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS n_a,
         sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS n_n,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_r,
         sum(l_extendedprice * (1 - l_discount)) AS s_total,
         sum(l_extendedprice * (1 - l_discount) / (1 + l_tax)) AS s_principal,
         sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_extendedprice * l_tax ELSE 0 END) AS s_mora,
         sum(CASE WHEN l_returnflag = 'R' AND l_discount >= 0.08 THEN 1 ELSE 0 END) AS n_bad
  FROM lineitem GROUP BY l_orderkey
),
ct AS (SELECT o_custkey AS ck, sum(o_totalprice) AS cust_total FROM orders GROUP BY o_custkey),
lbase AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS c, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
         cu.c_acctbal, cu.c_mktsegment, li.*, ct.cust_total,
         CASE WHEN coalesce(li.n_bad, 0) >= 2 THEN 0 ELSE 1 END AS y
  FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey
  JOIN ct ON ct.ck = o.o_custkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey
),
loans AS (
  SELECT k AS loan_id,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS tipo_credito,
    o_orderdate AS fecha_prestamo,
    o_totalprice * 10 AS capital_prestado,
    CAST(2 + k % 89 AS INTEGER) AS plazo_meses,
    o_totalprice * 10 / CAST(2 + k % 89 AS INTEGER) AS cuota_pactada,
    CASE WHEN c % 97 = 0 THEN NULL ELSE CAST(15 + c % 90 AS INTEGER) END AS edad_cliente,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Independiente' ELSE 'Empleado' END AS tipo_laboral,
    greatest(c_acctbal, 0) * 200 AS salario_cliente,
    CAST(90 * y + k % 10 AS DOUBLE) AS puntaje,
    CASE WHEN c % 89 = 0 THEN NULL ELSE CAST(140 + (c * 37) % 820 AS DOUBLE) END AS puntaje_datacredito,
    CASE WHEN k % 100 < 27 THEN NULL ELSE greatest(c_acctbal, 0) * 200 END AS promedio_ingresos_datacredito,
    CASE k % 4 WHEN 0 THEN 'Creciente' WHEN 1 THEN 'Estable' WHEN 2 THEN 'Decreciente' ELSE '1234' END AS tendencia_ingresos,
    CAST((c * 7 + k) % 12 AS INTEGER) AS huella_consulta,
    cust_total - o_totalprice AS total_otros_prestamos,
    CAST(n_li AS INTEGER) AS cant_creditosvigentes,
    CAST(n_a AS INTEGER) AS creditos_sectorFinanciero,
    CAST(n_n AS INTEGER) AS creditos_sectorCooperativo,
    CAST(n_r AS INTEGER) AS creditos_sectorReal,
    s_total AS saldo_total,
    CASE WHEN k % 27 = 0 THEN NULL ELSE s_principal END AS saldo_principal,
    CAST(s_mora AS DOUBLE) AS saldo_mora,
    CASE WHEN k % 18 = 0 THEN NULL ELSE CAST(0.0 AS DOUBLE) END AS saldo_mora_codeudor,
    CAST(y AS INTEGER) AS Pago_atiempo
  FROM lbase
),
filtered AS (
  SELECT * FROM loans
  WHERE (edad_cliente BETWEEN 18 AND 100 OR edad_cliente IS NULL)
    AND (puntaje_datacredito BETWEEN 150 AND 950 OR puntaje_datacredito IS NULL)
),
meds AS (
  SELECT quantile_cont(saldo_mora, 0.5) AS m_mora, quantile_cont(saldo_total, 0.5) AS m_total,
         quantile_cont(saldo_mora_codeudor, 0.5) AS m_cod, quantile_cont(puntaje_datacredito, 0.5) AS m_score
  FROM filtered
),
clean AS (
  SELECT f.loan_id, f.tipo_credito, f.capital_prestado, f.plazo_meses, f.edad_cliente, f.tipo_laboral,
         f.salario_cliente, coalesce(f.puntaje_datacredito, m.m_score) AS puntaje_datacredito,
         f.huella_consulta, f.total_otros_prestamos, f.creditos_sectorFinanciero,
         f.creditos_sectorCooperativo, f.creditos_sectorReal,
         coalesce(f.saldo_total, m.m_total) AS saldo_total,
         CAST(coalesce(coalesce(f.saldo_mora, m.m_mora) > 0, false) AS INTEGER) AS tiene_mora,
         CASE WHEN f.salario_cliente = 0 OR f.salario_cliente IS NULL THEN 0.0
              ELSE f.capital_prestado / f.salario_cliente END AS ratio_capital_salario,
         f.Pago_atiempo
  FROM filtered f, meds m
)"""


def with_loans(body: str) -> str:
    return "WITH " + LOANS.strip() + "\n" + body


def age_band(col: str = "edad_cliente") -> str:
    return (f"CASE WHEN {col} > 0 AND {col} <= 30 THEN '≤30' WHEN {col} > 30 AND {col} <= 45 THEN '31-45' "
            f"WHEN {col} > 45 AND {col} <= 60 THEN '46-60' WHEN {col} > 60 AND {col} <= 150 THEN '>60' END")


def size_band(col: str = "capital_prestado") -> str:
    return (f"CASE WHEN {col} > 0 AND {col} <= 1500000 THEN 'Pequeño' "
            f"WHEN {col} > 1500000 AND {col} <= 3000000 THEN 'Mediano' "
            f"WHEN {col} > 3000000 THEN 'Grande' END")


def inquiry_band(col: str = "huella_consulta") -> str:
    return (f"CASE WHEN {col} > 0 AND {col} <= 3 THEN 'Baja' WHEN {col} > 3 AND {col} <= 6 THEN 'Media' "
            f"WHEN {col} > 6 THEN 'Alta' END")


def rate(target: str = "Pago_atiempo", event: int = 0) -> str:
    return f"CASE WHEN {target} = {event} THEN 1.0 ELSE 0.0 END"


SQL: dict[str, str] = {}

SQL["eda_default_rate_age_x_size"] = with_loans(f""",
banded AS (SELECT {age_band()} AS grupo_edad, {size_band()} AS tamano_credito, Pago_atiempo FROM filtered)
SELECT grupo_edad,
  CAST(avg(CASE WHEN tamano_credito = 'Pequeño' THEN {rate()} END) * 100 AS DOUBLE) AS "Pequeño",
  CAST(avg(CASE WHEN tamano_credito = 'Mediano' THEN {rate()} END) * 100 AS DOUBLE) AS "Mediano",
  CAST(avg(CASE WHEN tamano_credito = 'Grande' THEN {rate()} END) * 100 AS DOUBLE) AS "Grande"
FROM banded WHERE grupo_edad IS NOT NULL GROUP BY grupo_edad""")


# ----------------------------------------------------------------- shared fragments

SEED = 42


def mix(key: str = "loan_id", seed: int = SEED, salt: str | None = None) -> str:
    return f"substr(md5(concat_ws('|', CAST({key} AS VARCHAR), '{seed}'" + (f", CAST({salt} AS VARCHAR)" if salt else "") + ")), 1, 8)"


SPLIT = f""",
ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY Pago_atiempo ORDER BY {mix()}, loan_id) - 1 AS __r,
         count(*) OVER (PARTITION BY Pago_atiempo) AS __n
  FROM clean c
),
split AS (SELECT * EXCLUDE (__r, __n), CASE WHEN __r < round(__n * 0.2) THEN 'test' ELSE 'train' END AS split
          FROM ranked),
train AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'train'),
test AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'test')"""


def rules_sql(t: dict | None = None) -> tuple[str, str, str]:
    """(prediction, rule_hit, rule_count) CASE expressions of the rule model."""
    t = t or {"puntaje_muy_bajo": 600.0, "puntaje_moderado": 750.0, "puntaje_independiente": 700.0,
              "edad_joven": 30, "ratio_alto": 3.0, "huella_alta": 8}
    r = [
        "coalesce(tiene_mora = 1, false)",
        f"coalesce(puntaje_datacredito < {t['puntaje_muy_bajo']}, false)",
        f"coalesce(edad_cliente < {t['edad_joven']} AND ratio_capital_salario > {t['ratio_alto']}, false)",
        f"coalesce(huella_consulta > {t['huella_alta']} AND puntaje_datacredito < {t['puntaje_moderado']}, false)",
        f"coalesce(tipo_laboral = 'Independiente' AND puntaje_datacredito < {t['puntaje_independiente']}, false)",
    ]
    pred = "CAST(CASE WHEN " + " OR ".join(r) + " THEN 0 ELSE 1 END AS INTEGER)"
    hit = "CAST(CASE " + " ".join(f"WHEN {c} THEN {i + 1}" for i, c in enumerate(r)) + " ELSE 0 END AS INTEGER)"
    cnt = "CAST(" + " + ".join(f"CAST({c} AS INTEGER)" for c in r) + " AS INTEGER)"
    return pred, hit, cnt


PRED, HIT, CNT = rules_sql()


# ----------------------------------------------------------------- part 1: sources, filters, quality

LOAN_COLUMNS = ["loan_id", "tipo_credito", "fecha_prestamo", "capital_prestado", "plazo_meses", "cuota_pactada",
                "edad_cliente", "tipo_laboral", "salario_cliente", "puntaje", "puntaje_datacredito",
                "promedio_ingresos_datacredito", "tendencia_ingresos", "huella_consulta", "total_otros_prestamos",
                "cant_creditosvigentes", "creditos_sectorFinanciero", "creditos_sectorCooperativo",
                "creditos_sectorReal", "saldo_total", "saldo_principal", "saldo_mora", "saldo_mora_codeudor",
                "Pago_atiempo"]
STRING_COLUMNS = {"tipo_laboral", "tendencia_ingresos"}
RAW_NUMERIC = ["capital_prestado", "plazo_meses", "cuota_pactada", "edad_cliente", "salario_cliente", "puntaje",
               "puntaje_datacredito", "promedio_ingresos_datacredito", "huella_consulta", "total_otros_prestamos",
               "cant_creditosvigentes", "creditos_sectorFinanciero", "creditos_sectorCooperativo",
               "creditos_sectorReal", "saldo_total", "saldo_principal", "saldo_mora", "saldo_mora_codeudor"]
TREND = "CASE WHEN tendencia_ingresos IN ('Decreciente', 'Estable', 'Creciente') THEN tendencia_ingresos END"
WL = f""",
wl AS (SELECT * REPLACE ({TREND} AS tendencia_ingresos) FROM loans)"""


# Signed values are written ``round(x, 6) + 0.0``: DuckDB's round can give -0.0,
# which Spark's decimal rounding never does; adding +0.0 normalises the sign of zero.


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


SQL["s_loan_table"] = with_loans("SELECT * FROM loans")

SQL["p_table_info"] = with_loans("\n" + union(
    f"SELECT {i} AS position, '{c}' AS \"column\", count({c}) AS non_null FROM loans"
    for i, c in enumerate(LOAN_COLUMNS)))

SQL["p_head"] = with_loans("SELECT loan_id, tipo_credito, capital_prestado, Pago_atiempo FROM loans "
                           "ORDER BY loan_id LIMIT 5")

SQL["p_trend_ordinal"] = with_loans(WL + """
SELECT tendencia_ingresos,
  CAST(CASE tendencia_ingresos WHEN 'Decreciente' THEN 1 WHEN 'Estable' THEN 2 WHEN 'Creciente' THEN 3 END AS INTEGER)
    AS tendencia_rank, count(*) AS n
FROM wl GROUP BY 1, 2""")

SQL["p_label_map"] = with_loans("""
SELECT CASE Pago_atiempo WHEN 1 THEN 'Paga a tiempo' WHEN 0 THEN 'Mora' END AS etiqueta, count(*) AS n
FROM loans GROUP BY 1""")

SQL["p_cast_columns"] = with_loans("""
SELECT sum(CAST(plazo_meses AS DOUBLE)) AS sum_plazo,
       count(TRY_CAST(tendencia_ingresos AS INTEGER)) AS n_numeric_trend,
       max(TRY_CAST(tendencia_ingresos AS INTEGER)) AS max_numeric_trend
FROM loans""")

SQL["f_range_filter_report"] = with_loans("""
SELECT count(*) AS n_before, (SELECT count(*) FROM filtered) AS n_after,
       count(*) - (SELECT count(*) FROM filtered) AS n_removed
FROM loans""")

SQL["f_range_filtered_rows"] = with_loans("SELECT loan_id, edad_cliente, puntaje_datacredito FROM filtered")

_CC = [c for c in LOAN_COLUMNS if c not in ("fecha_prestamo", "puntaje", "cuota_pactada", "saldo_principal",
                                            "cant_creditosvigentes", "promedio_ingresos_datacredito",
                                            "tendencia_ingresos")]
SQL["f_complete_case"] = with_loans(f"SELECT {', '.join(_CC)} FROM loans WHERE "
                                    + " AND ".join(f"{c} IS NOT NULL" for c in _CC + ["fecha_prestamo"]))

SQL["f_arrears_rows"] = with_loans("SELECT loan_id, saldo_mora, puntaje_datacredito FROM loans WHERE saldo_mora > 0")

SQL["f_clip_tail_p99"] = with_loans("\n" + union(
    f"SELECT '{c}' AS variable, count(*) AS n_kept, round(max({c}), 6) AS max_kept FROM loans "
    f"WHERE {c} <= (SELECT quantile_cont({c}, 0.99) FROM loans)"
    for c in ["salario_cliente", "total_otros_prestamos", "saldo_total", "saldo_mora"]))

SQL["f_defaulters_by_type"] = with_loans("""
SELECT tipo_credito, count(*) AS n FROM loans WHERE Pago_atiempo IN (0) AND tipo_credito IN (1, 2, 3)
GROUP BY tipo_credito""")

_RULES = [("age_18_100", "edad_cliente", "edad_cliente BETWEEN 18 AND 100"),
          ("score_150_950", "puntaje_datacredito", "puntaje_datacredito BETWEEN 150 AND 950"),
          ("salary_positive", "salario_cliente", "salario_cliente > 0"),
          ("capital_300k_50m", "capital_prestado", "capital_prestado BETWEEN 300000 AND 50000000"),
          ("term_1_90", "plazo_meses", "plazo_meses BETWEEN 1 AND 90")]
SQL["f_domain_rules"] = with_loans("\n" + union(
    f"SELECT '{r}' AS rule, '{c}' AS variable, count({c}) AS n_checked, "
    f"CAST(sum(CASE WHEN {c} IS NOT NULL AND NOT ({cond}) THEN 1 ELSE 0 END) AS BIGINT) AS n_violations, "
    f"count(*) - count({c}) AS n_null, "
    f"round(sum(CASE WHEN {c} IS NOT NULL AND NOT ({cond}) THEN 1 ELSE 0 END) * 100.0 / nullif(count({c}), 0), 6)"
    f" AS pct_violations FROM loans" for r, c, cond in _RULES))

_SCORING = ["tipo_credito", "capital_prestado", "plazo_meses", "edad_cliente", "tipo_laboral", "salario_cliente",
            "total_otros_prestamos", "puntaje_datacredito", "huella_consulta", "saldo_total",
            "creditos_sectorFinanciero", "creditos_sectorCooperativo", "creditos_sectorReal", "tiene_mora",
            "ratio_capital_salario"]
SQL["f_enforce_schema"] = with_loans(f"""
SELECT 'accepted' AS status, count(*) AS n FROM clean WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _SCORING)}
UNION ALL
SELECT 'rejected' AS status, count(*) AS n FROM clean WHERE NOT ({' AND '.join(f'{c} IS NOT NULL' for c in _SCORING)})""")

SQL["q_null_counts"] = with_loans("\n" + union(
    f"SELECT '{c}' AS variable, count(*) - count({c}) AS n_null FROM loans" for c in LOAN_COLUMNS))

SQL["q_null_pct"] = with_loans("\n" + union(
    f"SELECT '{c}' AS variable, count(*) - count({c}) AS n_null, count(*) AS n_rows, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 6) AS pct_null FROM loans" for c in LOAN_COLUMNS))

SQL["q_high_null_columns"] = with_loans(WL + ",\nnp AS (" + union(
    f"SELECT '{c}' AS variable, count(*) - count({c}) AS n_null, count(*) AS n_rows, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 6) AS pct_null FROM wl" for c in LOAN_COLUMNS)
    + ")\nSELECT * FROM np WHERE pct_null > 15")

SQL["q_zero_counts"] = with_loans("\n" + union(
    f"SELECT '{c}' AS variable, CAST(sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zero FROM loans"
    for c in RAW_NUMERIC))

_SENT_S = "('', ' ', 'NA', 'N/A', 'n/a', 'na', 'NULL', 'null', 'None', 'none', '-', '--', '?', 'unknown', 'Unknown')"
_SENT_N = "(-1, -999, -9999, 99999)"


def _sentinel(c: str) -> str:
    cond = f"{c} IN {_SENT_S if c in STRING_COLUMNS else _SENT_N}"
    return (f"SELECT '{c}' AS variable, CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS n_hits, "
            f"coalesce(array_to_string(list_sort(list_distinct(list(CAST({c} AS VARCHAR)) FILTER (WHERE {cond}))), ','), '')"
            f" AS hits FROM loans")


SQL["q_sentinel_scan"] = with_loans("\n" + union(_sentinel(c) for c in LOAN_COLUMNS if c != "fecha_prestamo"))

SQL["q_distinct_values"] = with_loans("\n" + union(
    f"SELECT DISTINCT '{c}' AS variable, CAST({c} AS VARCHAR) AS value FROM loans"
    for c in ["tipo_credito", "tipo_laboral", "tendencia_ingresos", "plazo_meses", "huella_consulta", "Pago_atiempo"]))

SQL["q_distinct_counts"] = with_loans("\n" + union(
    f"SELECT '{c}' AS variable, count(DISTINCT {c}) AS n_distinct FROM loans"
    for c in LOAN_COLUMNS if c != "fecha_prestamo"))

SQL["q_value_counts"] = with_loans(WL + ",\nvc AS (" + union(
    f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM wl GROUP BY 2"
    for c in ["tipo_credito", "tipo_laboral", "tendencia_ingresos", "Pago_atiempo"]) + """)
SELECT variable, value, count, round(count / sum(count) OVER (PARTITION BY variable), 6) AS share FROM vc""")

SQL["q_fit_medians"] = with_loans("""
SELECT quantile_cont(saldo_mora, 0.5) AS saldo_mora, quantile_cont(saldo_total, 0.5) AS saldo_total,
       quantile_cont(saldo_mora_codeudor, 0.5) AS saldo_mora_codeudor,
       quantile_cont(puntaje_datacredito, 0.5) AS puntaje_datacredito
FROM filtered""")

SQL["d_base_pipeline"] = with_loans("SELECT * REPLACE (round(ratio_capital_salario, 6) AS ratio_capital_salario) FROM clean")


# ----------------------------------------------------------------- part 2: aggregates and features

EDA = WL + """,
eda AS (SELECT *, CAST(coalesce(saldo_mora > 0, false) AS INTEGER) AS tiene_mora FROM wl)"""


def long_of(src: str, cols, extra: str = "") -> str:
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    ex = f"{extra}, " if extra else ""
    return f"(UNPIVOT (SELECT {ex}{sel} FROM {src}) ON {', '.join(cols)} INTO NAME variable VALUE value)"


SQL["a_describe_numeric"] = with_loans(f""",
lng AS (SELECT * FROM {long_of('clean', P.NUMERIC_FEATURES)})
SELECT variable, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max
FROM lng GROUP BY variable""")

SQL["a_describe_categorical"] = with_loans(EDA + ",\nvc AS (" + union(
    f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM eda WHERE {c} IS NOT NULL GROUP BY 2"
    for c in ["tipo_credito", "tipo_laboral", "tendencia_ingresos"]) + """)
SELECT variable, CAST(sum(n) AS BIGINT) AS count, count(*) AS unique, first(value ORDER BY n DESC, value DESC) AS top,
       max(n) AS freq
FROM vc GROUP BY variable""")

SQL["a_describe_by"] = with_loans(EDA + """
SELECT tiene_mora, count(puntaje_datacredito) AS count, round(avg(puntaje_datacredito), 6) AS mean,
       round(stddev_samp(puntaje_datacredito), 6) AS std, min(puntaje_datacredito) AS min,
       round(quantile_cont(puntaje_datacredito, 0.25), 6) AS p25, round(quantile_cont(puntaje_datacredito, 0.5), 6) AS p50,
       round(quantile_cont(puntaje_datacredito, 0.75), 6) AS p75, max(puntaje_datacredito) AS max
FROM eda WHERE tiene_mora IS NOT NULL AND puntaje_datacredito IS NOT NULL GROUP BY tiene_mora""")

SQL["a_quantiles"] = with_loans("\n" + union(
    f"SELECT '{c}' AS variable, CAST({q} AS DOUBLE) AS q, round(quantile_cont({c}, {q}), 6) AS quantile FROM clean"
    for c in ["capital_prestado", "salario_cliente", "saldo_total"] for q in [0.01, 0.1, 0.5, 0.9, 0.99]))

SQL["a_corr_with_target"] = with_loans("\n" + union(
    f"SELECT '{c}' AS variable, round(corr(CAST({c} AS DOUBLE), CAST(Pago_atiempo AS DOUBLE)), 6) + 0.0 AS corr FROM loans"
    for c in RAW_NUMERIC))


def _corr_pairs(src: str, cols, where: str = "") -> str:
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    aggs = ", ".join(f"corr(CAST({cols[i]} AS DOUBLE), CAST({cols[j]} AS DOUBLE)) AS r{i}_{j}" for i, j in pairs)
    structs = []
    for i, j in pairs:
        structs.append(f"{{'var_a': '{cols[i]}', 'var_b': '{cols[j]}', 'ia': {i}, 'ib': {j}, 'corr': r{i}_{j}}}")
        if i != j:
            structs.append(f"{{'var_a': '{cols[j]}', 'var_b': '{cols[i]}', 'ia': {j}, 'ib': {i}, 'corr': r{i}_{j}}}")
    return (f"m AS (SELECT {aggs} FROM {src}),\n"
            f"pairs AS (SELECT unnest([{', '.join(structs)}], recursive := true) FROM m)")


SQL["a_corr_matrix"] = with_loans(",\n" + _corr_pairs("clean", P.NUMERIC_FEATURES)
                                  + "\nSELECT var_a, var_b, round(corr, 6) + 0.0 AS corr FROM pairs")

SQL["a_redundant_pairs"] = with_loans(",\n" + _corr_pairs("loans", RAW_NUMERIC)
                                      + "\nSELECT var_a, var_b, round(corr, 6) + 0.0 AS corr FROM pairs "
                                        "WHERE ia < ib AND abs(corr) >= 0.7")

SQL["a_leakage"] = with_loans(",\nc AS (" + union(
    f"SELECT '{c}' AS variable, corr(CAST({c} AS DOUBLE), CAST(Pago_atiempo AS DOUBLE)) AS corr FROM loans"
    for c in RAW_NUMERIC) + ")\nSELECT variable, round(corr, 6) + 0.0 AS corr FROM c WHERE abs(corr) > 0.9")

QUAD = EDA + """,
qm AS (SELECT quantile_cont(puntaje_datacredito, 0.5) AS ms, quantile_cont(huella_consulta, 0.5) AS mh FROM eda),
quad AS (
  SELECT e.*, CASE
    WHEN puntaje_datacredito >= ms AND huella_consulta >= mh THEN 'Score alto + muchas consultas'
    WHEN puntaje_datacredito >= ms AND huella_consulta < mh THEN 'Score alto + pocas consultas'
    WHEN puntaje_datacredito < ms AND huella_consulta >= mh THEN 'Score bajo + muchas consultas'
    WHEN puntaje_datacredito < ms AND huella_consulta < mh THEN 'Score bajo + pocas consultas'
    ELSE 'Otro' END AS grupo_riesgo
  FROM eda e, qm)"""

SQL["a_count_pivot_quadrant"] = with_loans(QUAD + """
SELECT grupo_riesgo, CAST(nullif(count(*) FILTER (WHERE Pago_atiempo = 0), 0) AS BIGINT) AS n_0,
       CAST(nullif(count(*) FILTER (WHERE Pago_atiempo = 1), 0) AS BIGINT) AS n_1
FROM quad GROUP BY grupo_riesgo""")


def rate_by(src: str, keys: str, where: str = "") -> str:
    w = f"WHERE {where}" if where else ""
    return (f"SELECT {keys}, count(*) AS total, CAST(sum({rate()}) AS BIGINT) AS n_event, "
            f"round(CAST(avg({rate()}) AS DOUBLE) * 100, 6) AS rate FROM {src} {w} GROUP BY ALL")


SQL["a_rate_by_job"] = with_loans(EDA + "\n" + rate_by("eda", "tipo_laboral", "tipo_laboral IS NOT NULL"))


def pivot_rate(src: str, row: str, col: str, levels) -> str:
    cells = ", ".join(
        f"round(CAST(avg(CASE WHEN {col} = '{v}' THEN {rate()} END) AS DOUBLE) * 100, 6) AS \"{v}\"" for v in levels)
    return f"SELECT {row}, {cells} FROM {src} WHERE {row} IS NOT NULL GROUP BY {row}"


SQL["a_rate_job_x_inquiry"] = with_loans(EDA + f""",
b AS (SELECT *, {inquiry_band()} AS huella_cat FROM eda)
{pivot_rate('b', 'tipo_laboral', 'huella_cat', ['Baja', 'Media', 'Alta'])}""")

SQL["a_rate_age_x_job"] = with_loans(EDA + f""",
b AS (SELECT *, {age_band()} AS grupo_edad FROM eda)
{pivot_rate('b', 'grupo_edad', 'tipo_laboral', ['Empleado', 'Independiente'])}""")

SQL["a_overall_rate"] = with_loans(f"""
SELECT count(*) AS total, CAST(sum({rate()}) AS BIGINT) AS n_event, round(CAST(avg({rate()}) AS DOUBLE) * 100, 6) AS rate
FROM loans""")

SQL["a_crosstab"] = with_loans("""
SELECT tipo_credito, count(*) FILTER (WHERE Pago_atiempo = 0) AS y_0, count(*) FILTER (WHERE Pago_atiempo = 1) AS y_1
FROM loans WHERE tipo_credito IS NOT NULL GROUP BY tipo_credito""")

SQL["a_crosstab_pct"] = with_loans("""
SELECT tipo_credito, round(count(*) FILTER (WHERE Pago_atiempo = 0) * 100.0 /
         (count(*) FILTER (WHERE Pago_atiempo = 0) + count(*) FILTER (WHERE Pago_atiempo = 1)), 6) AS pct_0,
       round(count(*) FILTER (WHERE Pago_atiempo = 1) * 100.0 /
         (count(*) FILTER (WHERE Pago_atiempo = 0) + count(*) FILTER (WHERE Pago_atiempo = 1)), 6) AS pct_1
FROM loans WHERE tipo_credito IS NOT NULL GROUP BY tipo_credito""")


def histogram_sql(src: str, cols, bins: int, by: str | None = None) -> str:
    byc = f"{by}, " if by else ""
    ext = by or ""
    where = f"WHERE {by} IS NOT NULL" if by else ""
    base = ("(SELECT DISTINCT variable, " + by + " FROM lng)") if by else "rng"
    return f""",
lng AS (SELECT * FROM {long_of(src, cols, ext)} {where}),
rng AS (SELECT variable, min(value) AS lo, max(value) AS hi FROM lng GROUP BY variable),
b AS (SELECT l.variable, {('l.' + by + ', ') if by else ''}
        CAST(CASE WHEN hi = lo THEN {bins // 2} ELSE least(floor((value - lo) / ((hi - lo) / {bins})), {bins - 1}) END
             AS INTEGER) AS bin
      FROM lng l JOIN rng r ON l.variable = r.variable),
cnt AS (SELECT variable, {byc}bin, count(*) AS count FROM b GROUP BY ALL),
grid AS (SELECT variable, {byc}CAST(unnest(range(0, {bins})) AS INTEGER) AS bin FROM {base} g)
SELECT g.variable, {('g.' + by + ', ') if by else ''}g.bin,
       {'round(' if by else ''}CASE WHEN hi = lo THEN lo - 0.5 + g.bin / {bins} ELSE lo + g.bin * (hi - lo) / {bins} END{', 6)' if by else ''} AS bin_lo,
       {'round(' if by else ''}CASE WHEN hi = lo THEN lo - 0.5 + (g.bin + 1) / {bins} ELSE lo + (g.bin + 1) * (hi - lo) / {bins} END{', 6)' if by else ''} AS bin_hi,
       coalesce(c.count, 0) AS count
FROM grid g JOIN rng r ON g.variable = r.variable
LEFT JOIN cnt c ON c.variable = g.variable AND c.bin = g.bin {('AND c.' + by + ' = g.' + by) if by else ''}"""


SQL["a_histogram"] = with_loans(histogram_sql("clean", P.NUMERIC_FEATURES, 40))
SQL["a_histogram_by_class"] = with_loans(histogram_sql(
    "clean", ["capital_prestado", "edad_cliente", "puntaje_datacredito"], 50, "Pago_atiempo"))

SQL["a_box_stats"] = with_loans(f""",
lng AS (SELECT * FROM {long_of('clean', P.NUMERIC_FEATURES, 'Pago_atiempo')} WHERE Pago_atiempo IS NOT NULL),
q AS (SELECT Pago_atiempo, variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM lng GROUP BY ALL),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.Pago_atiempo, f.variable, count(*) AS n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, min(value) FILTER (WHERE value >= lo AND value <= hi) AS whisker_lo,
       max(value) FILTER (WHERE value >= lo AND value <= hi) AS whisker_hi,
       count(*) FILTER (WHERE NOT (value >= lo AND value <= hi)) AS n_outliers
FROM lng l JOIN f ON l.Pago_atiempo = f.Pago_atiempo AND l.variable = f.variable
GROUP BY f.Pago_atiempo, f.variable, q1, median, q3, iqr""")

SQL["a_class_ratio"] = with_loans("""
SELECT count(*) FILTER (WHERE Pago_atiempo = 1) AS n_majority, count(*) FILTER (WHERE Pago_atiempo = 0) AS n_minority,
       round(count(*) FILTER (WHERE Pago_atiempo = 1) / count(*) FILTER (WHERE Pago_atiempo = 0), 2) AS ratio
FROM clean""")

SQL["a_class_weights"] = with_loans("""
SELECT Pago_atiempo, count(*) AS n_c,
       round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM clean WHERE Pago_atiempo IS NOT NULL GROUP BY Pago_atiempo""")

SQL["a_shape"] = with_loans("SELECT count(*) AS n_rows, CAST(17 AS BIGINT) AS n_cols FROM clean")

SQL["d_age_bands"] = with_loans(EDA + f""",
b AS (SELECT *, {age_band()} AS grupo_edad,
        CASE WHEN edad_cliente > 0 AND edad_cliente <= 30 THEN 0 WHEN edad_cliente > 30 AND edad_cliente <= 45 THEN 1
             WHEN edad_cliente > 45 AND edad_cliente <= 60 THEN 2 WHEN edad_cliente > 60 AND edad_cliente <= 150 THEN 3
        END AS grupo_edad_ord FROM eda)
{rate_by('b', 'grupo_edad, grupo_edad_ord', 'grupo_edad IS NOT NULL')}""")

SQL["d_ratio_segments"] = with_loans(EDA + """,
r AS (SELECT *, CASE WHEN salario_cliente = 0 THEN (CASE WHEN capital_prestado > 0 THEN 'inf'::DOUBLE
                                                          WHEN capital_prestado < 0 THEN '-inf'::DOUBLE END)
                     ELSE capital_prestado / salario_cliente END AS ratio FROM eda),
mx AS (SELECT max(ratio) AS m FROM r),
b AS (SELECT r.*, CASE WHEN ratio > 0 AND ratio <= 1 THEN 'Bajo (≤1)' WHEN ratio > 1 AND ratio <= 3 THEN 'Medio (1-3)'
                       WHEN ratio > 3 AND ratio <= 6 THEN 'Alto (3-6)' WHEN ratio > 6 AND ratio <= m THEN 'Muy alto (>6)'
                  END AS segmento_ratio,
             CASE WHEN ratio > 0 AND ratio <= 1 THEN 0 WHEN ratio > 1 AND ratio <= 3 THEN 1
                  WHEN ratio > 3 AND ratio <= 6 THEN 2 WHEN ratio > 6 AND ratio <= m THEN 3 END AS segmento_ratio_ord
      FROM r, mx)
""" + rate_by("b", "segmento_ratio, segmento_ratio_ord", "segmento_ratio IS NOT NULL"))

SQL["d_quadrant_rates"] = with_loans(QUAD + "\n" + rate_by("quad", "grupo_riesgo"))

SQL["d_three_sectors"] = with_loans(EDA + """,
b AS (SELECT *, CASE WHEN coalesce(creditos_sectorFinanciero > 0, false) AND coalesce(creditos_sectorCooperativo > 0, false)
                      AND coalesce(creditos_sectorReal > 0, false) THEN 'En los 3 sectores'
                     ELSE 'No en los 3 sectores' END AS en_3_sectores FROM eda)
""" + rate_by("b", "en_3_sectores"))


# ----------------------------------------------------------------- part 3: splits, rules, evaluation, drift

SAMPLE = f""",
__ts AS (SELECT *, row_number() OVER (ORDER BY {mix()}, loan_id) - 1 AS __q, count(*) OVER () AS __m FROM test),
sample AS (SELECT * EXCLUDE (__q, __m) FROM __ts WHERE __q < least(__m, greatest(50, floor(__m * 0.1))))"""

SQL["r_stratified_split"] = with_loans(SPLIT + "\nSELECT loan_id, Pago_atiempo, split FROM split")
SQL["r_sample_n"] = with_loans(SPLIT + SAMPLE + "\nSELECT loan_id FROM sample")

KFOLD = """,
kf AS (SELECT *, row_number() OVER (ORDER BY loan_id) - 1 AS __r, count(*) OVER () AS __n FROM train),
folds AS (SELECT * EXCLUDE (__r, __n), CAST(CASE WHEN __r < (__n % 10) * (__n // 10 + 1) THEN __r // (__n // 10 + 1)
          ELSE (__n % 10) + (__r - (__n % 10) * (__n // 10 + 1)) // (__n // 10) END AS INTEGER) AS fold FROM kf)"""
SQL["r_kfold"] = with_loans(SPLIT + KFOLD + "\nSELECT loan_id, fold FROM folds")

SKFOLD = f""",
__sk AS (SELECT *, row_number() OVER (PARTITION BY Pago_atiempo ORDER BY {mix()}, loan_id) - 1 AS __r FROM train),
__st AS (SELECT Pago_atiempo, coalesce(sum(count(*)) OVER (ORDER BY Pago_atiempo ROWS BETWEEN UNBOUNDED PRECEDING
                AND 1 PRECEDING), 0) AS __start FROM train GROUP BY Pago_atiempo),
sfolds AS (SELECT __sk.* EXCLUDE (__r), CAST((__start + __r) % 5 AS INTEGER) AS fold
           FROM __sk JOIN __st ON __sk.Pago_atiempo = __st.Pago_atiempo)"""
SQL["r_stratified_kfold"] = with_loans(SPLIT + SKFOLD + "\nSELECT loan_id, Pago_atiempo, fold FROM sfolds")

SHUFFLE = f""",
__ex AS (SELECT t.*, s.split_id FROM train t, (SELECT CAST(range AS INTEGER) AS split_id FROM range(50)) s),
__rk AS (SELECT *, row_number() OVER (PARTITION BY split_id ORDER BY {mix(seed=123, salt='split_id')}, loan_id) - 1 AS __r
         FROM __ex),
__nt AS (SELECT count(*) AS __n, CAST(ceil(count(*) * 0.2) AS BIGINT) AS __nte FROM train),
roles AS (SELECT __rk.* EXCLUDE (__r), CASE WHEN __r < __nte THEN 'test' ELSE 'train' END AS role,
                 CASE WHEN __r >= __nte THEN __r - __nte END AS train_rank FROM __rk, __nt),
sz AS (SELECT DISTINCT CAST(floor(CAST(f AS DOUBLE) * (__n - __nte)) AS BIGINT) AS size FROM __nt,
       (VALUES (0.1), (0.325), (0.55), (0.775), (1.0)) v(f)),
szi AS (SELECT CAST(row_number() OVER (ORDER BY size) - 1 AS INTEGER) AS size_idx, size FROM sz WHERE size > 0)"""
SQL["r_shuffle_splits"] = with_loans(SPLIT + SHUFFLE + """
SELECT split_id, role, count(*) AS n, CAST(sum(loan_id) AS BIGINT) AS key_sum FROM roles GROUP BY ALL""")
SQL["r_train_sizes"] = with_loans(SPLIT + SHUFFLE + """
SELECT split_id, size_idx, count(*) AS n, CAST(sum(loan_id) AS BIGINT) AS key_sum
FROM roles JOIN szi ON role = 'train' AND train_rank < size GROUP BY ALL""")

SQL["m_rule_predictions"] = with_loans(f"SELECT loan_id, {PRED} AS prediction, {HIT} AS rule_hit, {CNT} AS rule_count FROM clean")

PT = f""",
pt AS (SELECT *, {PRED} AS prediction, {HIT} AS rule_hit, {CNT} AS rule_count FROM test)"""

SQL["v_confusion_matrix"] = with_loans(SPLIT + PT + """
SELECT a AS actual, b AS predicted, (SELECT count(*) FROM pt WHERE Pago_atiempo = a AND prediction = b) AS count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(a, b)""")


def div(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


def counts(src: str, pos: int, keys: str = "", pred: str = "prediction") -> str:
    k = f"{keys}, " if keys else ""
    g = f" GROUP BY {keys}" if keys else ""
    return (f"SELECT {k}count(*) FILTER (WHERE Pago_atiempo = {pos} AND {pred} = {pos}) AS tp, "
            f"count(*) FILTER (WHERE Pago_atiempo <> {pos} AND {pred} = {pos}) AS fp, "
            f"count(*) FILTER (WHERE Pago_atiempo = {pos} AND {pred} <> {pos}) AS fn, "
            f"count(*) FILTER (WHERE Pago_atiempo <> {pos} AND {pred} <> {pos}) AS tn, count(*) AS n FROM {src}{g}")


def metrics(r: bool = True) -> str:
    rd = (lambda e: f"round({e}, 6)") if r else (lambda e: e)
    bal = (f"{div(f'{div('tp', 'tp + fn')} + {div('tn', 'tn + fp')}',
                  '(CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END + CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END)')}")
    return (f"{rd(div('tp + tn', 'tp + fp + fn + tn'))} AS accuracy, {rd(bal)} AS balanced_accuracy, "
            f"{rd(div('tp', 'tp + fp'))} AS precision, {rd(div('tp', 'tp + fn'))} AS recall, "
            f"{rd(div('2 * tp', '2 * tp + fp + fn'))} AS f1, {rd(div('5.0 * tp', '5.0 * tp + 4.0 * fn + fp'))} AS fbeta, "
            f"tp + fp AS n_pred_pos")


SQL["v_binary_metrics"] = with_loans(SPLIT + PT + f",\nc AS ({counts('pt', 0)})\nSELECT *, {metrics()} FROM c")


def auc_sql(src: str, score: str, pos: int, keys: str = "") -> str:
    """Mann-Whitney AUC with ties, per ``keys``."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    g = f" GROUP BY {keys}" if keys else ""
    return (f"(SELECT {k}sum(pos * (below + neg * 0.5)) / nullif(CAST(sum(pos) AS DOUBLE) * sum(neg), 0) AS roc_auc FROM "
            f"(SELECT *, sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg"
            f" AS below FROM (SELECT {k}{score} AS score, sum(CASE WHEN Pago_atiempo = {pos} THEN 1 ELSE 0 END) AS pos,"
            f" sum(CASE WHEN Pago_atiempo = {pos} THEN 0 ELSE 1 END) AS neg FROM {src} WHERE {score} IS NOT NULL"
            f" GROUP BY ALL) s) c{g})")


SQL["v_roc_auc"] = with_loans(SPLIT + PT + f"""
SELECT 'rule_count' AS score, round(roc_auc, 6) AS roc_auc FROM {auc_sql('pt', 'rule_count', 0)} a
UNION ALL
SELECT 'puntaje_datacredito' AS score, round(roc_auc, 6) AS roc_auc FROM {auc_sql('pt', 'puntaje_datacredito', 1)} b""")

SQL["v_classification_report"] = with_loans(SPLIT + PT + f""",
c0 AS ({counts('pt', 0)}), c1 AS ({counts('pt', 1)}),
per AS (
  SELECT '0' AS class, {div('tp', 'tp + fp')} AS precision, {div('tp', 'tp + fn')} AS recall,
         {div('2 * tp', '2 * tp + fp + fn')} AS f1, tp + fn AS support, {div('tp + tn', 'n')} AS acc FROM c0
  UNION ALL
  SELECT '1', {div('tp', 'tp + fp')}, {div('tp', 'tp + fn')}, {div('2 * tp', '2 * tp + fp + fn')}, tp + fn,
         {div('tp + tn', 'n')} FROM c1)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per
UNION ALL SELECT 'accuracy', NULL, NULL, round(first(acc), 6), CAST(sum(support) AS BIGINT) FROM per
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per""")


def curve_sql(src: str, score: str, pos: int) -> str:
    return f"""
st AS (SELECT {score} AS s, sum(CASE WHEN Pago_atiempo = {pos} THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN Pago_atiempo = {pos} THEN 0 ELSE 1 END) AS neg FROM {src} WHERE {score} IS NOT NULL GROUP BY 1),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM st),
cum AS (SELECT CAST(s AS DOUBLE) AS threshold,
               CAST(sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
               CAST(sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp
        FROM st)"""


SQL["v_roc_curve"] = with_loans(SPLIT + PT + "," + curve_sql("pt", "puntaje_datacredito", 1) + f"""
SELECT threshold, round({div('fp', 'N')}, 6) AS fpr, round({div('tp', 'P')}, 6) AS tpr, tp, fp FROM cum, tot
UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0, 0, 0""")

SQL["v_pr_curve"] = with_loans(SPLIT + PT + "," + curve_sql("pt", "rule_count", 0) + f"""
SELECT threshold, round({div('tp', 'tp + fp')}, 6) AS precision, round({div('tp', 'P')}, 6) AS recall FROM cum, tot""")

CVF = KFOLD + f""",
pf AS (SELECT *, {PRED} AS prediction FROM folds),
fc AS ({counts('pf', 0, 'fold')}),
tc AS (SELECT sum(tp) AS t_tp, sum(fp) AS t_fp, sum(fn) AS t_fn, sum(tn) AS t_tn FROM fc),
parts AS (SELECT fold, 'test' AS part, tp, fp, fn, tn FROM fc
          UNION ALL SELECT fold, 'train', t_tp - tp, t_fp - fp, t_fn - fn, t_tn - tn FROM fc, tc),
cvm AS (SELECT fold, part, {div('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {div('tp', 'tp + fp')} AS precision,
               {div('tp', 'tp + fn')} AS recall, {div('2 * tp', '2 * tp + fp + fn')} AS f1 FROM parts)"""
SQL["v_cv_metrics"] = with_loans(SPLIT + CVF + """
SELECT fold, part, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM cvm""")

SQL["v_fold_summary"] = with_loans(SPLIT + CVF + """,
lm AS (UNPIVOT cvm ON accuracy, precision, recall, f1 INTO NAME metric VALUE value)
SELECT metric, round(avg(value) FILTER (WHERE part = 'train'), 6) AS train_score,
       round(avg(value) FILTER (WHERE part = 'test'), 6) AS cv_mean,
       round(stddev_samp(value) FILTER (WHERE part = 'test'), 6) AS cv_std
FROM lm GROUP BY metric""")

SQL["v_learning_curve"] = with_loans(SPLIT + SHUFFLE + f""",
pr AS (SELECT *, {PRED} AS prediction FROM roles),
trc AS (SELECT split_id, size, {div('count(*) FILTER (WHERE Pago_atiempo = 0 AND prediction = 0)',
                                   'count(*) FILTER (WHERE Pago_atiempo = 0)')} AS train_recall
        FROM pr JOIN szi ON role = 'train' AND train_rank < size GROUP BY ALL),
tec AS (SELECT split_id, {div('count(*) FILTER (WHERE Pago_atiempo = 0 AND prediction = 0)',
                             'count(*) FILTER (WHERE Pago_atiempo = 0)')} AS test_recall
        FROM pr WHERE role = 'test' GROUP BY split_id)
SELECT CAST(size AS INTEGER) AS train_size, round(avg(train_recall), 6) AS train_mean,
       round(stddev_pop(train_recall), 6) AS train_std, round(avg(test_recall), 6) AS test_mean,
       round(stddev_pop(test_recall), 6) AS test_std
FROM trc JOIN tec USING (split_id) GROUP BY size""")


SQL["v_learning_curve_checks"] = with_loans(SPLIT + SHUFFLE + """,
tes AS (SELECT count(*) AS n_test_pos FROM roles WHERE role = 'test' AND Pago_atiempo = 0)
SELECT size AS train_size, count(DISTINCT split_id) AS n_fits,
       count(*) FILTER (WHERE Pago_atiempo = 0) AS n_train_pos, any_value(n_test_pos) AS n_test_pos,
       CAST(0.0 AS DOUBLE) AS score_equation, CAST(0 AS BIGINT) AS n_odd
FROM roles JOIN szi ON role = 'train' AND train_rank < size, tes GROUP BY size""")


def candidate_sql(name: str, th: dict | None) -> str:
    pred = rules_sql(th)[0]
    return f"""
SELECT '{name}' AS modelo, cv.*, te.*, au.* FROM
  (SELECT avg(f) AS cv_fbeta_mean, stddev_pop(f) AS cv_fbeta_std, CAST(0.0 AS DOUBLE) AS cv_fit_time_mean FROM
     (SELECT {div('5.0 * tp', '5.0 * tp + 4.0 * fn + fp')} AS f FROM
        ({counts(f'(SELECT *, {pred} AS prediction FROM sfolds)', 0, 'fold')}))) cv,
  (SELECT {div('tp', 'tp + fn')} AS test_recall, {div('2 * tp', '2 * tp + fp + fn')} AS test_f1,
          {div('5.0 * tp', '5.0 * tp + 4.0 * fn + fp')} AS test_fbeta, tp + fp AS casos_mora_pred FROM
     ({counts(f'(SELECT *, {pred} AS prediction FROM test)', 0)})) te,
  (SELECT roc_auc AS test_roc_auc FROM
     {auc_sql(f'(SELECT *, CAST({pred} = 0 AS INTEGER) AS __s FROM test)', '__s', 0)}) au"""


STRICT_TH = {"puntaje_muy_bajo": 650.0, "puntaje_moderado": 800.0, "puntaje_independiente": 750.0,
             "edad_joven": 35, "ratio_alto": 2.0, "huella_alta": 6}
LENIENT_TH = {"puntaje_muy_bajo": 550.0, "puntaje_moderado": 700.0, "puntaje_independiente": 650.0,
              "edad_joven": 25, "ratio_alto": 4.0, "huella_alta": 10}

SQL["v_selection"] = with_loans(SPLIT + SKFOLD + ",\ncands AS (" + union(
    [candidate_sql("heuristic", None), candidate_sql("heuristic_strict", STRICT_TH),
     candidate_sql("heuristic_lenient", LENIENT_TH)]) + """),
sc AS (SELECT *, 0.6 * test_fbeta + 0.25 / (1 + cv_fbeta_std) + 0.15 / (1 + cv_fit_time_mean) AS selection_score
       FROM cands)
SELECT modelo, round(cv_fbeta_mean, 6) AS cv_fbeta_mean, round(cv_fbeta_std, 6) AS cv_fbeta_std, cv_fit_time_mean,
       round(test_recall, 6) AS test_recall, round(test_f1, 6) AS test_f1, round(test_fbeta, 6) AS test_fbeta,
       casos_mora_pred, round(test_roc_auc, 6) AS test_roc_auc, round(selection_score, 6) AS selection_score,
       CAST(row_number() OVER (ORDER BY selection_score DESC, modelo) AS INTEGER) AS rank
FROM sc""")

SQL["v_stability"] = with_loans(SPLIT + SKFOLD + f""",
pf AS (SELECT *, {PRED} AS prediction FROM sfolds),
fc AS ({counts('pf', 1, 'fold')}),
fm AS (SELECT fold, {div('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {div('2 * tp', '2 * tp + fp + fn')} AS f1,
              {div('tp', 'tp + fn')} AS recall, {div('tp', 'tp + fp')} AS precision FROM fc),
fa AS {auc_sql('(SELECT *, CAST(prediction AS DOUBLE) AS __s FROM pf)', '__s', 1, 'fold')},
per AS (SELECT * FROM fm JOIN fa USING (fold)),
lm AS (UNPIVOT per ON accuracy, f1, roc_auc, recall, precision INTO NAME metric VALUE value),
s AS (SELECT metric, avg(value) AS mean, stddev_pop(value) AS std FROM lm GROUP BY metric),
v AS (SELECT *, coalesce(std < 0.05, false) AS stable FROM s)
SELECT metric, round(mean, 6) AS mean, round(std, 6) AS std, stable,
       CASE WHEN stable THEN 'ESTABLE' ELSE 'INESTABLE' END AS verdict, bool_and(stable) OVER () AS all_stable FROM v""")


def _metric_rows(src: str, names) -> str:
    return f"(UNPIVOT (SELECT {metrics(False)} FROM ({counts(src, 0)})) ON {', '.join(names)} INTO NAME metric VALUE value)"


SQL["v_compare"] = with_loans(SPLIT + f""",
a AS (SELECT metric, value AS local FROM {_metric_rows(f'(SELECT *, {PRED} AS prediction FROM test)',
                                                       ['accuracy', 'precision', 'recall', 'f1', 'fbeta'])}),
b AS (SELECT metric, value AS other FROM {_metric_rows(f"(SELECT *, {rules_sql(STRICT_TH)[0]} AS prediction FROM test)",
                                                       ['accuracy', 'precision', 'recall', 'f1', 'balanced_accuracy'])})
SELECT coalesce(a.metric, b.metric) AS metric, round(local, 6) AS local, round(other, 6) AS other,
       CASE WHEN local IS NULL OR other IS NULL THEN '-' WHEN local >= other THEN 'local' ELSE 'other' END AS winner
FROM a FULL OUTER JOIN b ON a.metric = b.metric""")

SWEEP = PT + f""",
cells AS (SELECT (SELECT CAST(max(i) AS INTEGER) FROM range(21) t(i) WHERE rule_count / 5.0 >= i / 20.0) AS cell,
                 sum(CASE WHEN Pago_atiempo = 0 THEN 1 ELSE 0 END) AS pos,
                 sum(CASE WHEN Pago_atiempo = 0 THEN 0 ELSE 1 END) AS neg FROM pt GROUP BY 1),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM cells),
grid AS (SELECT CAST(range AS INTEGER) AS i FROM range(0, 21)),
per AS (SELECT g.i, coalesce(c.pos, 0) AS pos, coalesce(c.neg, 0) AS neg FROM grid g LEFT JOIN cells c ON c.cell = g.i),
cm AS (SELECT i, CAST(sum(pos) OVER (ORDER BY i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS tp,
              CAST(sum(neg) OVER (ORDER BY i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fp
       FROM per),
sw AS (SELECT i / 20 AS threshold, tp, fp, CAST(P - tp AS BIGINT) AS fn, CAST(N - fp AS BIGINT) AS tn FROM cm, tot),
swm AS (SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn, round({div('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy,
               round({div('tp', 'tp + fp')}, 6) AS precision, round({div('tp', 'tp + fn')}, 6) AS recall,
               round({div('2 * tp', '2 * tp + fp + fn')}, 6) AS f1,
               round({div('5.0 * tp', '5.0 * tp + 4.0 * fn + fp')}, 6) AS fbeta FROM sw)"""
SQL["v_threshold_sweep"] = with_loans(SPLIT + SWEEP + "\nSELECT * FROM swm")
SQL["v_near_threshold"] = with_loans(SPLIT + SWEEP + "\nSELECT * FROM swm ORDER BY abs(threshold - 0.5), threshold LIMIT 1")


def ks_sql(ref: str, prod: str, cols, digits: int = 4) -> str:
    return f""",
__lr AS (SELECT *, 0 AS side FROM {long_of(ref, cols)}),
__lp AS (SELECT *, 1 AS side FROM {long_of(prod, cols)}),
__l AS (SELECT * FROM __lr UNION ALL SELECT * FROM __lp),
__cnt AS (SELECT variable, value, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS c_ref,
                 sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c_prod FROM __l GROUP BY variable, value),
__sides AS (SELECT variable, count(*) FILTER (WHERE side = 0) AS n_ref, count(*) FILTER (WHERE side = 1) AS n_prod,
                   avg(value) FILTER (WHERE side = 0) AS mean_ref, avg(value) FILTER (WHERE side = 1) AS mean_prod
            FROM __l GROUP BY variable),
__cum AS (SELECT variable,
            sum(c_ref) OVER (PARTITION BY variable ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr,
            sum(c_prod) OVER (PARTITION BY variable ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp
          FROM __cnt),
__d AS (SELECT c.variable, max(abs(cr / n_ref - cp / n_prod)) AS d FROM __cum c JOIN __sides s ON c.variable = s.variable
        GROUP BY c.variable),
__rep AS (SELECT s.*, __d.d, sqrt(CAST(n_ref AS DOUBLE) * n_prod / (n_ref + n_prod)) AS en
          FROM __sides s LEFT JOIN __d ON s.variable = __d.variable
          WHERE n_prod >= 2 AND n_ref >= 1 AND (SELECT count(*) FROM {prod}) >= 2),
__lam AS (SELECT *, (en + 0.12 + 0.11 / en) * d AS lam FROM __rep),
__pv AS (SELECT *, CASE WHEN lam < 0.1 THEN 1.0 ELSE least(1.0, greatest(0.0, 2.0 * list_reduce(list_transform(range(1, 101),
            lambda j: (CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * j * j * lam * lam)), lambda a, b: a + b))) END AS p
         FROM __lam),
report AS (SELECT variable, round_even(d, {digits}) AS ks_statistic, round_even(p, {digits}) AS p_value,
                  p < 0.05 AS drift_detectado, round_even(mean_ref, {digits}) AS media_referencia,
                  round_even(mean_prod, {digits}) AS media_produccion FROM __pv)"""


DRIFT = SPLIT + SAMPLE + ks_sql("train", "sample", ["tipo_credito", *P.NUMERIC_FEATURES])
SQL["k_ks_report"] = with_loans(DRIFT + "\nSELECT * FROM report")

EVENTS = """,
ev AS (SELECT ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
ev_ref AS (SELECT * FROM ev WHERE ts < TIMESTAMP '2024-01-15'),
ev_prod AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '2024-01-15')"""
SQL["k_ks_events"] = "WITH __x AS (SELECT 1)" + EVENTS + ks_sql("ev_ref", "ev_prod", ["value", "k"]) + "\nSELECT * FROM report"

SQL["k_drift_status"] = with_loans(DRIFT + """
SELECT coalesce(bool_or(drift_detectado), false) AS hay_drift, CAST(coalesce(sum(CAST(drift_detectado AS INTEGER)), 0) AS BIGINT)
       AS n_drift, count(*) AS n_variables FROM report""")
SQL["k_drifted_variables"] = with_loans(DRIFT + "\nSELECT variable FROM report WHERE drift_detectado")
SQL["k_top_statistic"] = with_loans(DRIFT + "\nSELECT variable, ks_statistic FROM report ORDER BY ks_statistic DESC, variable LIMIT 10")
SQL["k_top_mean_shift"] = with_loans(DRIFT + """
SELECT variable, round(abs(media_produccion - media_referencia), 6) AS mean_diff FROM report
ORDER BY abs(media_produccion - media_referencia) DESC, variable LIMIT 8""")
SQL["k_prediction_mix"] = with_loans(SPLIT + SAMPLE + f"""
SELECT CASE {PRED} WHEN 1 THEN 'Paga a tiempo' WHEN 0 THEN 'Mora' END AS etiqueta, count(*) AS count FROM sample GROUP BY 1""")
SQL["k_monitoring_cycle"] = with_loans(DRIFT + """
SELECT variable, ks_statistic, p_value, drift_detectado, (SELECT count(*) FROM sample) AS n_muestra,
       (SELECT coalesce(bool_or(drift_detectado), false) FROM report) AS hay_drift FROM report""")
SQL["k_check_batch"] = with_loans(SPLIT + """,
batch AS (SELECT * FROM test WHERE tipo_laboral = 'Independiente')""" + ks_sql("train", "batch", ["tipo_credito", *P.NUMERIC_FEATURES])
                                  + "\nSELECT * FROM report")
SQL["k_period_stats"] = """
SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS period_start,
       time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') + INTERVAL '7 days' AS period_end,
       event_type, count(*) AS n, round(avg(value), 6) AS mean_value
FROM events GROUP BY ALL"""


# ----------------------------------------------------------------- part 4: encoding

SCALE_COLS = ["capital_prestado", "salario_cliente", "saldo_total", "puntaje_datacredito", "huella_consulta"]
SCALER = ",\nsp AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALE_COLS) + " FROM train)"
SQL["e_scaler_params"] = with_loans(SPLIT + SCALER + "\n" + union(
    f"SELECT '{c}' AS variable, round(m_{c}, 6) AS mean, round(s_{c}, 6) AS std FROM sp" for c in SCALE_COLS))
SQL["e_scaled_test"] = with_loans(SPLIT + SCALER + "\nSELECT loan_id, " + ", ".join(
    f"round(CASE WHEN s_{c} = 0 THEN {c} - m_{c} ELSE ({c} - m_{c}) / s_{c} END, 6) + 0.0 AS {c}" for c in SCALE_COLS)
    + " FROM test, sp")
SQL["e_one_hot"] = with_loans(SPLIT + """,
lv AS (SELECT DISTINCT 'tipo_credito' AS v, CAST(tipo_credito AS VARCHAR) AS level FROM train WHERE tipo_credito IS NOT NULL
       UNION SELECT DISTINCT 'tipo_laboral', tipo_laboral FROM train WHERE tipo_laboral IS NOT NULL)
SELECT t.loan_id, 'cat__' || lv.v || '_' || lv.level AS feature,
       CASE WHEN (CASE lv.v WHEN 'tipo_credito' THEN CAST(t.tipo_credito AS VARCHAR) ELSE t.tipo_laboral END) = lv.level
            THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS value
FROM test t, lv""")


# ----------------------------------------------------------------- part 5: more projections

_DROPPED = ["promedio_ingresos_datacredito", "tendencia_ingresos", "fecha_prestamo", "puntaje", "cuota_pactada",
            "saldo_principal", "cant_creditosvigentes", "saldo_mora", "saldo_mora_codeudor"]
SQL["p_drop_columns"] = with_loans(f"SELECT * EXCLUDE ({', '.join(_DROPPED)}) FROM loans")
SQL["p_numeric_columns"] = with_loans("SELECT * EXCLUDE (fecha_prestamo, tipo_laboral, tendencia_ingresos) FROM loans")
SQL["p_round_half_even"] = with_loans("""
SELECT tipo_credito, round_even(avg(capital_prestado), 4) AS capital_prestado,
       round_even(avg(salario_cliente), 4) AS salario_cliente
FROM loans GROUP BY tipo_credito""")


# ----------------------------------------------------------------- part 5: round trips and further operators

SQL["s_csv_stage"] = with_loans("SELECT loan_id, plazo_meses, tipo_laboral, saldo_principal, Pago_atiempo FROM loans")
SQL["s_full_refresh"] = with_loans("SELECT loan_id, Pago_atiempo FROM loans WHERE tipo_laboral = 'Empleado'")
_BALANCE = """SELECT count(*) FILTER (WHERE Pago_atiempo = 1) AS n_majority, count(*) FILTER (WHERE Pago_atiempo = 0) AS n_minority,
       round(count(*) FILTER (WHERE Pago_atiempo = 1) / nullif(count(*) FILTER (WHERE Pago_atiempo = 0), 0), 2) AS ratio"""
SQL["s_metrics_json"] = with_loans(_BALANCE + " FROM loans")
SQL["s_run_log"] = with_loans(f"SELECT b.*, 'balance' AS experiment, run FROM ({_BALANCE} FROM loans) b, (VALUES ('first'), ('second')) v(run)")
SQL["s_report"] = with_loans("SELECT loan_id, saldo_total, tipo_laboral FROM loans")
SQL["p_features_target"] = with_loans(f"SELECT loan_id, {', '.join(P.NUMERIC_FEATURES)}, Pago_atiempo FROM clean")
SQL["p_rename"] = with_loans("""
SELECT tipo_laboral, nullif(count(*) FILTER (WHERE Pago_atiempo = 0), 0) AS mora, nullif(count(*) FILTER (WHERE Pago_atiempo = 1), 0) AS al_dia
FROM loans WHERE tipo_laboral IS NOT NULL GROUP BY tipo_laboral""")
_DRIFT_COLS = ["tipo_credito", *P.NUMERIC_FEATURES]
SQL["k_reference_snapshot"] = with_loans(SPLIT + f"""
SELECT variable, count(*) AS n, count(DISTINCT value) AS n_values, min(value) AS lo, max(value) AS hi
FROM {long_of('train', _DRIFT_COLS)} GROUP BY variable""")
SQL["k_batch_status"] = with_loans(SPLIT + """,
batch AS (SELECT * FROM test WHERE tipo_laboral = 'Independiente')""" + ks_sql("train", "batch", _DRIFT_COLS) + """
SELECT 'independientes' AS batch, CASE WHEN bool_or(drift_detectado) THEN 'Drift detectado' ELSE 'Sin drift significativo' END AS status,
       bool_or(drift_detectado) AS hay_drift, count(*) AS n_variables FROM report
UNION ALL SELECT 'one row', 'Muestra insuficiente para análisis de drift (mínimo 2 registros).', false, 0
UNION ALL SELECT 'other columns',
  'No se encontraron columnas numéricas en común. Verifique el esquema de los datos enviados.', false, 0
UNION ALL SELECT 'no row', 'Muestra insuficiente para análisis de drift (mínimo 2 registros).', false, 0""")


def _period_drift_sql() -> str:
    """One report per 7-day period, written out as a UNION over the periods of a month."""
    parts = []
    for i in range(6):
        start = f"(TIMESTAMP '2024-01-11' + INTERVAL '{7 * i} days')"
        parts.append("(WITH __x AS (SELECT 1)" + EVENTS + f""",
pd AS (SELECT * FROM ev_prod WHERE ts >= {start} AND ts < {start} + INTERVAL '7 days')""" + ks_sql("ev_ref", "pd", ["value", "k"])
                     + f"\nSELECT {start} AS period_start, * FROM report)")
    return "\nUNION ALL\n".join(parts)


SQL["k_drift_7_days"] = _period_drift_sql()
# the share of lattice paths that reach a gap of d, diagonal by diagonal, for sides up to 10,000
SQL["k_ks_exact"] = "WITH RECURSIVE __x AS (SELECT 1)" + EVENTS + ks_sql("ev_ref", "ev_prod", ["value", "k"]) + """,
__side AS (SELECT variable, d, p, CAST(n_ref AS BIGINT) AS n, CAST(n_prod AS BIGINT) AS m, CAST(round(d * n_ref * n_prod) AS BIGINT) AS h FROM __pv),
__walk(variable, n, m, h, t, q) AS (
  SELECT variable, n, m, h, 0::BIGINT, list_transform(range(0, n + 1), lambda i: 0.0::DOUBLE) FROM __side WHERE n <= 10000 AND m <= 10000
  UNION ALL
  SELECT variable, n, m, h, t + 1, list_transform(list_zip(range(0, n + 1), list_prepend(0.0::DOUBLE, q[:n]), q), lambda x:
    CASE WHEN x[1] > t + 1 OR t + 1 - x[1] > m THEN 0.0 WHEN abs(x[1] * m - (t + 1 - x[1]) * n) >= h THEN 1.0
         ELSE (x[1] * x[2] + (t + 1 - x[1]) * x[3]) / (t + 1) END)
  FROM __walk WHERE t < n + m),
__exact AS (SELECT variable, q[n + 1] AS pe FROM __walk WHERE t = n + m)
SELECT s.variable, round(d, 9) AS ks_statistic, round(coalesce(pe, p), 9) AS p_value, coalesce(pe, p) < 0.05 AS drift_detectado
FROM __side s LEFT JOIN __exact e ON s.variable = e.variable"""
SQL["v_best_candidate"] = f"SELECT modelo, selection_score FROM ({SQL['v_selection']}) WHERE rank = 1"
SQL["r_nearest_minority"] = with_loans(SPLIT + """,
mi AS (SELECT loan_id, CAST(plazo_meses AS DOUBLE) a, CAST(huella_consulta AS DOUBLE) b, CAST(edad_cliente AS DOUBLE) c
       FROM train WHERE Pago_atiempo = 0 AND edad_cliente IS NOT NULL),
nn AS (SELECT x.loan_id, y.loan_id AS nb_key, row_number() OVER (PARTITION BY x.loan_id
         ORDER BY sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (x.c - y.c) * (x.c - y.c)), y.loan_id) - 1 AS r
       FROM mi x JOIN mi y ON x.loan_id <> y.loan_id)
SELECT loan_id, CAST(r AS INTEGER) AS nb_rank, nb_key FROM nn WHERE r < 3""")
SQL["r_smote_counts"] = with_loans(SPLIT + """,
t AS (SELECT * FROM train WHERE edad_cliente IS NOT NULL),
c AS (SELECT count(*) FILTER (WHERE Pago_atiempo = 0) AS n0, count(*) FILTER (WHERE Pago_atiempo = 1) AS n1 FROM t)
SELECT CAST(0 AS INTEGER) AS Pago_atiempo, false AS synthetic, n0 AS n FROM c
UNION ALL SELECT 1, false, n1 FROM c
UNION ALL SELECT 0, true, n1 - n0 FROM c""")
SQL["m_model_checks"] = with_loans(SPLIT + """
SELECT modelo, count(*) AS n_scored, CAST(0 AS BIGINT) AS n_odd, CAST(0 AS BIGINT) AS n_off
FROM test, (VALUES ('logreg'), ('random_forest'), ('gradient_boosting'), ('xgboost')) v(modelo) GROUP BY modelo""")
SQL["k_stored_snapshot"] = SQL["k_ks_report"]
SQL["m_boosting_root"] = with_loans(SPLIT + """
, cells AS (
  SELECT j, variable, v, sum(CAST(w * (0.5 - y) AS DOUBLE)) AS g, sum(CAST(w * 0.25 AS DOUBLE)) AS h FROM (
    SELECT 0 AS j, 'plazo_meses' AS variable, CAST(plazo_meses AS DOUBLE) AS v, Pago_atiempo AS y,
           CASE WHEN Pago_atiempo = 1 THEN 2.0 ELSE 1.0 END AS w FROM train WHERE edad_cliente IS NOT NULL
    UNION ALL
    SELECT 1, 'huella_consulta', CAST(huella_consulta AS DOUBLE), Pago_atiempo,
           CASE WHEN Pago_atiempo = 1 THEN 2.0 ELSE 1.0 END FROM train WHERE edad_cliente IS NOT NULL
    UNION ALL
    SELECT 2, 'edad_cliente', CAST(edad_cliente AS DOUBLE), Pago_atiempo,
           CASE WHEN Pago_atiempo = 1 THEN 2.0 ELSE 1.0 END FROM train WHERE edad_cliente IS NOT NULL)
  GROUP BY j, variable, v),
sides AS (
  SELECT j, variable, v, sum(g) OVER below AS gl, sum(h) OVER below AS hl,
         sum(g) OVER (PARTITION BY j) AS g, sum(h) OVER (PARTITION BY j) AS h
  FROM cells WINDOW below AS (PARTITION BY j ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT variable, round(v, 6) AS threshold, round(-0.3 * gl / hl, 6) AS value_left,
       round(-0.3 * (g - gl) / (h - hl), 6) AS value_right
FROM sides WHERE hl >= 1 AND h - hl >= 1
ORDER BY gl * gl / hl + (g - gl) * (g - gl) / (h - hl) - g * g / h DESC, j, v LIMIT 1""")
