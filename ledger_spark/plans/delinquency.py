"""Owners who owe the most per building."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_spark.functions.amounts import at_least_zero, or_zero, percent_of
from ledger_spark.functions.text import short_text
from ledger_spark.operators.periods import charges_in_periods
from ledger_spark.operators.spread import lookup_join
from ledger_spark.schemas import MONEY
from ledger_spark.tables import LedgerTables


def holdings(units: DataFrame, unit_people: DataFrame) -> DataFrame:
    """Per person and building: summed percentage and number of unit links.

    Aggregated before any further join, so a person or building with a large
    share of all units shrinks to one row per pair on the map side.
    """
    return (
        unit_people.join(units, "id_uf")
        .groupBy("id_persona", "id_consorcio")
        .agg(
            F.sum(or_zero(F.col("porcentaje_de_prorrateo"))).alias("porcentaje"),
            F.count(F.lit(1)).alias("unidades"),
        )
    )


def paid_by_person(payments: DataFrame, accounts: DataFrame, cutoff: datetime.date) -> DataFrame:
    """Payments up to the cut-off day, per person; unmatched payments drop out."""
    per_account = (
        payments.where(F.col("fecha_de_pago") <= F.lit(cutoff))
        .where(F.col("id_persona_cuenta").isNotNull())
        .groupBy("id_persona_cuenta")
        .agg(F.sum("importe").alias("importe"))
    )
    return (
        per_account.join(accounts.select("id_persona_cuenta", "id_persona"), "id_persona_cuenta")
        .groupBy("id_persona")
        .agg(F.sum("importe").alias("importe"))
    )


def _balances(
    tables: LedgerTables,
    cutoff: datetime.date,
    building,
    include_extra: bool,
    periods: str | None,
    dedup: bool,
    shown: list[str],
) -> DataFrame:
    """Debt, payments and balance per (owner, building), with ``shown`` columns of the owner."""
    if cutoff is None:
        raise ValueError("a cut-off date is required")

    units, charges = tables.units, tables.charges
    if building is not None:
        units = units.where(F.col("id_consorcio") == building)

    amount = or_zero(F.col("total_ordinarios"))
    if include_extra:
        amount = amount + or_zero(F.col("total_extraordinarios"))
    building_totals = (
        charges_in_periods(charges, periods, building)
        .groupBy("id_consorcio")
        .agg(F.sum(amount).alias("total"))
        .join(
            tables.buildings.select("id_consorcio", F.col("nombre").alias("Consorcio")),
            "id_consorcio",
        )
    )
    owners = (
        tables.people.where(F.col("es_inquilino") == 0)
        .select("id_persona", *shown)
        .join(paid_by_person(tables.payments, tables.accounts, cutoff), "id_persona", "left")
    )
    times = F.lit(1) if dedup else F.col("unidades")
    debt = percent_of(F.col("total"), F.col("porcentaje")).cast("decimal(38,6)")
    credit = or_zero(F.col("importe") * times).cast("decimal(38,2)")

    held = lookup_join(holdings(units, tables.unit_people), owners, "id_persona")
    return (
        lookup_join(held, building_totals, "id_consorcio")
        .select(
            "id_persona",
            "id_consorcio",
            "Consorcio",
            *shown,
            debt.alias("DeudaEsperada"),
            credit.alias("Pagos"),
        )
        .withColumn(
            "Morosidad", at_least_zero((F.col("DeudaEsperada") - F.col("Pagos")).cast(MONEY))
        )
    )


def _report_columns() -> list:
    return [
        "Consorcio",
        "apellido",
        "nombre",
        short_text(F.col("dni")).alias("dni"),
        "email",
        short_text(F.col("telefono")).alias("telefono"),
        "DeudaEsperada",
        "Pagos",
        "Morosidad",
    ]


def delinquency(
    tables: LedgerTables,
    cutoff: datetime.date,
    building=None,
    include_extra: bool = False,
    periods: str | None = None,
    dedup: bool = False,
) -> DataFrame:
    """Expected debt, payments and balance of every owner and building.

    Every unit of an owner is charged every selected period, and every payment
    counts once per owned unit. Both are products of sums, so the units, the
    charges and the payments are each aggregated first and only one row per
    (owner, building) is ever joined: the unit × period and payment × unit rows
    do not exist. ``dedup`` counts a payment once per building instead.
    """
    shown = ["apellido", "nombre", "dni", "email", "telefono"]
    return _balances(tables, cutoff, building, include_extra, periods, dedup, shown).select(
        "id_persona", "id_consorcio", *_report_columns()
    )


def top_delinquent_owners(
    tables: LedgerTables,
    cutoff: datetime.date,
    building=None,
    include_extra: bool = False,
    periods: str | None = None,
    n: int = 3,
    dedup: bool = False,
) -> DataFrame:
    """The ``n`` largest balances; ties by surname, name, then ids.

    Only the columns the order needs travel through the joins. The others are
    looked up for the ``n`` rows, a side whose size Spark knows from the limit.
    """
    order = [F.desc("Morosidad"), "apellido", "nombre", "id_persona", "id_consorcio"]
    shown = ["apellido", "nombre"]
    balances = _balances(tables, cutoff, building, include_extra, periods, dedup, shown)
    contact = tables.people.select("id_persona", "dni", "email", "telefono")
    return (
        balances.orderBy(*order)
        .limit(n)
        .join(contact, "id_persona")
        .orderBy(*order)
        .limit(n)
        .select(*_report_columns())
    )
