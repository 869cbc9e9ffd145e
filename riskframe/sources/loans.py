"""The loan table: one row per loan with the 23 raw credit columns.

The credit data of the original pipeline is not public, so the loan table is
derived from the order, customer and line-item tables (one loan per order).
Plan shape, chosen to survive skew at scale:

* line items are aggregated per order (partial + final hash aggregate);
* each customer's order total is a ``groupBy`` + join rather than a window, so a
  customer holding a third of all orders is pre-aggregated map-side instead of
  landing in one window task; the customer-side join is then one row per key,
  which AQE's skew-join handling can split on the order side;
* the line-item join is a left join on the order key, keeping loans without
  lines (their balances are null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.sources.io import table_path

_LI_COLS = ["l_orderkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _count_if(cond):
    return F.sum(F.when(cond, 1).otherwise(0))


def line_balances(lineitem: DataFrame) -> DataFrame:
    li = lineitem.select(*_LI_COLS)
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_li"),
        _count_if(flag == "A").alias("n_a"),
        _count_if(flag == "N").alias("n_n"),
        _count_if(flag == "R").alias("n_r"),
        F.sum(net).alias("s_total"),
        F.sum(net / (1 + F.col("l_tax"))).alias("s_principal"),
        F.sum(F.when((flag == "R") & (status == "F"), F.col("l_extendedprice") * F.col("l_tax"))
              .otherwise(0.0)).alias("s_mora"),
        _count_if((flag == "R") & (F.col("l_discount") >= 0.08)).alias("n_bad"),
    )


def loan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the 23-column loan table (plus ``loan_id``) from the driver tables."""
    orders = spark.read.parquet(table_path(sf_dir, "orders")).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = spark.read.parquet(table_path(sf_dir, "customer")).select(
        "c_custkey", "c_acctbal", "c_mktsegment")
    lineitem = spark.read.parquet(table_path(sf_dir, "lineitem"))
    return loans_from(orders, customer, lineitem)


def loans_from(orders: DataFrame, customer: DataFrame, lineitem: DataFrame) -> DataFrame:
    cust_totals = orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("cust_total"))
    cust = customer.join(cust_totals, customer.c_custkey == cust_totals.o_custkey).drop("o_custkey")
    li = line_balances(lineitem)
    base = (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .join(li, orders.o_orderkey == li.l_orderkey, "left"))

    k, c = F.col("o_orderkey"), F.col("o_custkey")
    y = F.when(F.coalesce(F.col("n_bad"), F.lit(0)) >= 2, 0).otherwise(1)
    salary = F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 200
    term = (2 + k % 89).cast("int")
    return base.select(
        k.alias("loan_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("tipo_credito"),
        F.col("o_orderdate").alias("fecha_prestamo"),
        (F.col("o_totalprice") * 10).alias("capital_prestado"),
        term.alias("plazo_meses"),
        (F.col("o_totalprice") * 10 / term).alias("cuota_pactada"),
        F.when(c % 97 == 0, None).otherwise((15 + c % 90).cast("int")).alias("edad_cliente"),
        F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"), "Independiente")
        .otherwise("Empleado").alias("tipo_laboral"),
        salary.alias("salario_cliente"),
        (90 * y + k % 10).cast("double").alias("puntaje"),
        F.when(c % 89 == 0, None).otherwise((140 + (c * 37) % 820).cast("double")).alias("puntaje_datacredito"),
        F.when(k % 100 < 27, None).otherwise(salary).alias("promedio_ingresos_datacredito"),
        F.when(k % 4 == 0, "Creciente").when(k % 4 == 1, "Estable").when(k % 4 == 2, "Decreciente")
        .otherwise("1234").alias("tendencia_ingresos"),
        ((c * 7 + k) % 12).cast("int").alias("huella_consulta"),
        (F.col("cust_total") - F.col("o_totalprice")).alias("total_otros_prestamos"),
        F.col("n_li").cast("int").alias("cant_creditosvigentes"),
        F.col("n_a").cast("int").alias("creditos_sectorFinanciero"),
        F.col("n_n").cast("int").alias("creditos_sectorCooperativo"),
        F.col("n_r").cast("int").alias("creditos_sectorReal"),
        F.col("s_total").alias("saldo_total"),
        F.when(k % 27 == 0, None).otherwise(F.col("s_principal")).alias("saldo_principal"),
        F.col("s_mora").alias("saldo_mora"),
        F.when(k % 18 == 0, None).otherwise(F.lit(0.0)).alias("saldo_mora_codeudor"),
        y.cast("int").alias("Pago_atiempo"),
    )
