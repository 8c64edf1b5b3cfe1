"""Ledger tables seen through the driver's order tables.

One nation is a building, one customer a person with one bank account, one
order both a unit the customer owns and an expense line of the building, one
line item a payment. Every table is read whole.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger_spark.functions.categories import EXTRAORDINARY, ORDINARY
from ledger_spark.functions.text import month_name
from ledger_spark.schemas import MONEY, PERCENT
from ledger_spark.tables import LedgerTables

DEPARTMENTS = ["A", "B", "C", "D", "E"]


@functools.cache
def _schema(spark: SparkSession, path: str) -> T.StructType:
    """Read from the file footers, once per session rather than once per read."""
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id_consorcio"),
        F.col("n_name").alias("nombre"),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_persona"),
        F.col("c_mktsegment").alias("nombre"),
        F.col("c_name").alias("apellido"),
        F.col("c_custkey").cast("string").alias("dni"),
        F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
        F.col("c_nationkey").cast("string").alias("telefono"),
        (F.col("c_mktsegment") == "HOUSEHOLD").cast("int").alias("es_inquilino"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_persona_cuenta"),
        F.col("c_custkey").alias("id_persona"),
        F.lpad(F.col("c_custkey").cast("string"), 22, "0").alias("cbu"),
    )


def _orders_with_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).withColumn(
        "id_consorcio", F.col("c_nationkey").cast("bigint")
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    share = (F.col("o_totalprice").cast(MONEY) * F.lit("0.0001").cast("decimal(5,4)")).cast(PERCENT)
    return _orders_with_building(spark, sf_dir).select(
        F.col("o_orderkey").alias("id_uf"),
        "id_consorcio",
        F.element_at(F.array(*[F.lit(d) for d in DEPARTMENTS]), priority).alias("departamento"),
        F.when(F.col("o_orderstatus") != "P", share).alias("porcentaje_de_prorrateo"),
    )


def unit_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id_uf"), F.col("o_custkey").alias("id_persona")
    )


def expense_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_building(spark, sf_dir).select(
        "id_consorcio",
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("mes"),
        month_name(F.month("o_orderdate")).alias("periodo"),
        F.when(F.col("o_orderstatus") == "P", EXTRAORDINARY).otherwise(ORDINARY).alias("clase"),
        F.col("o_totalprice").cast(MONEY).alias("importe"),
    )


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charges per building and month name, years pooled."""
    from ledger_spark.plans.charges import charge_rollup

    return charge_rollup(expense_lines(spark, sf_dir), ["id_consorcio", "periodo"])


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("id_persona_cuenta"),
        F.col("l_shipdate").cast("date").alias("fecha_de_pago"),
        F.col("l_extendedprice").cast(MONEY).alias("importe"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> LedgerTables:
    return LedgerTables(
        buildings=buildings(spark, sf_dir),
        charges=charges(spark, sf_dir),
        expense_lines=expense_lines(spark, sf_dir),
        people=people(spark, sf_dir),
        units=units(spark, sf_dir),
        unit_people=unit_people(spark, sf_dir),
        accounts=accounts(spark, sf_dir),
        payments=payments(spark, sf_dir),
    )
