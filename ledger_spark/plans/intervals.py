"""Days between the payments credited to a unit, and months in a row without one."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledger_spark.operators.spread import lookup_join, spread
from ledger_spark.plans.payers import account_units
from ledger_spark.tables import LedgerTables

# Payments of one (unit, day) that are written from one row.
COPIES_PER_TASK = 10_000


def payment_days(tables: LedgerTables) -> DataFrame:
    """Per unit and day with payments: their number, the day before and after.

    The payments are counted per account and day before they are joined, and
    per unit and day after it, so the window sees at most one row per calendar
    day of a unit.
    """
    counted = (
        tables.payments.where(F.col("id_persona_cuenta").isNotNull())
        .where(F.col("fecha_de_pago").isNotNull())
        .groupBy("id_persona_cuenta", F.col("fecha_de_pago").cast("date").alias("fecha"))
        .agg(F.count(F.lit(1)).alias("pagos"))
    )
    credited = account_units(tables.accounts, tables.unit_people)
    days = (
        counted.join(credited, "id_persona_cuenta")
        .groupBy("id_uf", "fecha")
        .agg(F.sum("pagos").alias("pagos"))
    )
    by_day = Window.partitionBy("id_uf").orderBy("fecha")
    return days.withColumn("fecha_anterior", F.lag("fecha").over(by_day)).withColumn(
        "fecha_siguiente", F.lead("fecha").over(by_day)
    )


def payment_intervals(tables: LedgerTables, copies_per_task: int = COPIES_PER_TASK) -> DataFrame:
    """One row per payment with the previous payment date of the unit.

    Payments of one day follow each other at 0 days; only the first of the day
    looks back to an earlier day. Every day is cut into pieces of at most
    ``copies_per_task`` payments, which are spread over the cluster before they
    become one row per payment.
    """
    days = payment_days(tables).drop("fecha_siguiente")
    size = F.lit(copies_per_task).cast("bigint")
    first = F.lit(0).cast("bigint")
    pieces = spread(
        days.withColumn("start", F.explode(F.sequence(first, F.col("pagos") - 1, size))),
        "id_uf",
        "fecha",
        "start",
    )
    last = F.least(F.col("start") + size, F.col("pagos"))
    rows = pieces.withColumn("nth", F.explode(F.sequence(F.col("start") + 1, last)))
    previous = F.when(F.col("nth") == 1, F.col("fecha_anterior")).otherwise(F.col("fecha"))
    return rows.select(
        "id_uf",
        "fecha",
        previous.alias("fecha_anterior"),
        F.datediff("fecha", previous).alias("dias"),
    )


def unpaid_spells(
    tables: LedgerTables,
    charges: DataFrame,
    until: datetime.date | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """(id_uf, desde, hasta, meses, abierto): runs of charged months in which a unit paid nothing.

    Months are those for which the unit's building has charges, up to ``until``; a run goes on over
    months without charges. It is open if it holds the last of these months. A payment counts in the
    month it was made, whatever its amount.

    Units meet the months of their building and of their payments as two lists of one row each, and are
    dealt out by id before they become a row per month, so neither the window nor the groups over
    these rows move them again.
    """
    month, payments = F.trunc("fecha_de_pago", "month").alias("mes"), tables.payments
    charged = charges.where(F.col("mes").isNotNull())
    if until is not None:
        charged = charged.where(F.col("mes") <= F.lit(until))
        payments = payments.where(F.col("fecha_de_pago") <= F.lit(until))
    paid = payments.where("id_persona_cuenta IS NOT NULL AND fecha_de_pago IS NOT NULL")
    paid = paid.select("id_persona_cuenta", month).distinct()
    paid = paid.join(account_units(tables.accounts, tables.unit_people), "id_persona_cuenta")
    paid = paid.groupBy("id_uf").agg(F.collect_set("mes").alias("pagados"))
    months = charged.groupBy("id_consorcio").agg(F.collect_set("mes").alias("cobrados"))
    units = tables.units.select("id_uf", "id_consorcio").join(paid, "id_uf", "left")
    rows = spread(lookup_join(units, months, "id_consorcio"), "id_uf", partitions=partitions)
    rows = rows.select(
        "id_uf",
        F.coalesce("pagados", F.array().cast("array<date>")).alias("pagados"),
        F.array_max("cobrados").alias("ultimo"),
        F.explode("cobrados").alias("mes"),
    )
    rows = rows.select("id_uf", "mes", "ultimo", F.array_contains("pagados", F.col("mes")).alias("pago"))
    history = Window.partitionBy("id_uf").orderBy("mes").rowsBetween(Window.unboundedPreceding, 0)
    spells = rows.withColumn("racha", F.count_if("pago").over(history)).where("NOT pago")
    return spells.groupBy("id_uf", "racha").agg(
        F.min("mes").alias("desde"),
        F.max("mes").alias("hasta"),
        F.count(F.lit(1)).alias("meses"),
        (F.max("mes") == F.max("ultimo")).alias("abierto"),
    ).drop("racha")
