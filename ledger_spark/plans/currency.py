"""Payments in other currencies, at the quote of their day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_spark.operators.as_of import as_of
from ledger_spark.plans.imports import quotes_latest


def payments_in_currency(payments: DataFrame, quotes: DataFrame, currencies: list[str]) -> DataFrame:
    """Every payment once per currency, at the selling quote of its day or else of the last day before.

    ``quotes`` has moneda, fecha, venta and secuencia; of several quotes of a day the last one loaded
    counts. ``vigente_desde`` is the day of the quote; a payment without a day or before the first
    quote has NULL there and in ``venta`` and ``importe_en_moneda``, as it has at a quote of zero.
    """
    steps = quotes_latest(quotes).withColumnRenamed("fecha", "fecha_de_pago")
    each = F.explode(F.array(*[F.lit(c) for c in currencies])).alias("moneda")
    rows = payments.select("*", each)
    found = as_of(rows, steps, "fecha_de_pago", ["moneda"], ["venta"])
    ratio = F.col("importe").cast("double") / F.nullif(F.col("venta").cast("double"), F.lit(0.0))
    return found.withColumn("importe_en_moneda", ratio)


def without_quote(converted: DataFrame) -> DataFrame:
    """Days with payments that no quote covers: moneda, fecha_de_pago, the number and the sum."""
    return (
        converted.where(F.col("vigente_desde").isNull())
        .groupBy("moneda", "fecha_de_pago")
        .agg(F.count(F.lit(1)).alias("pagos"), F.sum("importe").alias("importe"))
    )
