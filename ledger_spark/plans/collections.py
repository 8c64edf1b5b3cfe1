"""Collections by month and department, and by type and period."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_spark.functions.amounts import or_zero
from ledger_spark.functions.text import month_number
from ledger_spark.plans.payers import account_units, paid_by_account
from ledger_spark.schemas import TOTAL
from ledger_spark.tables import LedgerTables


def collections_month_dept(
    tables: LedgerTables, year: int, departments: list[str], building=None
) -> DataFrame:
    """One row per month of the year, one column per department.

    The departments are given, so the pivot needs no pass to find them. A
    payer of several units is credited to the first one only.
    """
    payments = tables.payments.where(
        F.col("fecha_de_pago").between(
            F.lit(datetime.date(year, 1, 1)), F.lit(datetime.date(year, 12, 31))
        )
    )
    credited = account_units(tables.accounts, tables.unit_people, tables.units)
    if building is not None:
        credited = credited.where(F.col("id_consorcio") == building)
    cells = paid_by_account(payments, F.month("fecha_de_pago").alias("mes")).join(
        credited, "id_persona_cuenta"
    )
    months = cells.groupBy("mes").pivot("departamento", departments).agg(F.sum("importe"))
    return months.select("mes", *[F.col(d).cast(TOTAL).alias(d) for d in departments])


def collections_type_period(tables: LedgerTables, charges: DataFrame | None = None) -> DataFrame:
    """Payments per building and month, split like the month's charges.

    The charges are matched on the month name in ``periodo``, and on the year
    too where they carry ``mes``. A month without charges has no split.
    """
    charges = tables.charges if charges is None else charges
    ordinary = or_zero(F.col("total_ordinarios"))
    total = ordinary + or_zero(F.col("total_extraordinarios"))
    dated = "mes" in charges.columns
    when = (
        [F.year("mes").alias("anio"), F.month("mes").alias("nro_mes")]
        if dated
        else [month_number(F.col("periodo")).alias("nro_mes")]
    )
    keys = ["id_consorcio", "anio", "nro_mes"] if dated else ["id_consorcio", "nro_mes"]
    shares = (
        charges.select("id_consorcio", *when, ordinary.alias("ordinary"), total.alias("total"))
        .groupBy(*keys)
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("total").alias("total"))
    )

    credited = account_units(tables.accounts, tables.unit_people, tables.units)
    paid = (
        paid_by_account(
            tables.payments,
            F.year("fecha_de_pago").alias("anio"),
            F.month("fecha_de_pago").alias("nro_mes"),
        )
        .join(credited, "id_persona_cuenta")
        .groupBy("id_consorcio", "anio", "nro_mes")
        .agg(F.sum("importe").cast(TOTAL).alias("pagado"))
    )
    ratio = F.try_divide(F.col("ordinary").cast("double"), F.col("total").cast("double"))
    part = F.round(F.col("pagado").cast("double") * ratio, 2).cast(TOTAL)
    return (
        paid.join(shares, keys, "left")
        .withColumn("pagado_ordinario", part)
        .select(
            "id_consorcio",
            "anio",
            F.col("nro_mes").alias("mes"),
            "pagado",
            "pagado_ordinario",
            (F.col("pagado") - F.col("pagado_ordinario")).cast(TOTAL).alias("pagado_extraordinario"),
        )
    )
