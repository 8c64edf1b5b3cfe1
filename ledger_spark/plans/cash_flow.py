"""Weekly cash flow."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledger_spark.plans.payers import account_units, paid_by_account
from ledger_spark.schemas import TOTAL
from ledger_spark.tables import LedgerTables


def weekly_cash_flow(
    tables: LedgerTables,
    since: datetime.date | None = None,
    until: datetime.date | None = None,
    building=None,
) -> DataFrame:
    """Payments per week (from Monday), the running total and the weekly mean.

    The weeks are summed before the windows run over them. Those windows have
    no partition key, but their input is one row per calendar week: 5,200 rows
    for a century, whatever the number of payments.
    """
    payments = tables.payments
    if since is not None:
        payments = payments.where(F.col("fecha_de_pago") >= F.lit(since))
    if until is not None:
        payments = payments.where(F.col("fecha_de_pago") <= F.lit(until))

    week = F.trunc("fecha_de_pago", "week").alias("semana")
    if building is None:
        weeks = payments.groupBy(week).agg(F.sum("importe").alias("importe"))
    else:
        credited = account_units(tables.accounts, tables.unit_people, tables.units)
        weeks = (
            paid_by_account(payments, week)
            .join(credited.where(F.col("id_consorcio") == building), "id_persona_cuenta", "left_semi")
            .groupBy("semana")
            .agg(F.sum("importe").alias("importe"))
        )

    so_far = Window.orderBy("semana").rowsBetween(Window.unboundedPreceding, 0)
    overall = Window.partitionBy()
    return weeks.where(F.col("semana").isNotNull()).select(
        "semana",
        F.col("importe").cast(TOTAL).alias("total"),
        F.sum("importe").over(so_far).cast(TOTAL).alias("acumulado"),
        (F.sum("importe").over(overall) / F.count(F.lit(1)).over(overall))
        .cast(TOTAL)
        .alias("promedio_semanal"),
    )
