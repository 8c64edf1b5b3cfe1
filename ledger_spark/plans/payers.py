"""Which unit a payment is credited to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_spark.operators.spread import lookup_join


def payer_units(unit_people: DataFrame) -> DataFrame:
    """The first unit (lowest id) of each person."""
    return unit_people.groupBy("id_persona").agg(F.min("id_uf").alias("id_uf"))


def account_units(
    accounts: DataFrame, unit_people: DataFrame, units: DataFrame | None = None
) -> DataFrame:
    """One row per account: the unit its payments are credited to.

    With ``units`` it also carries the unit's building and department.
    """
    first = payer_units(unit_people)
    if units is not None:
        wanted = [c for c in ("id_uf", "id_consorcio", "departamento") if c in units.columns]
        first = first.join(units.select(*wanted), "id_uf")
    owned = accounts.select("id_persona_cuenta", "id_persona")
    return lookup_join(owned, first, "id_persona").drop("id_persona")


def paid_by_account(payments: DataFrame, *periods) -> DataFrame:
    """Payments summed per account and period, before any join.

    An account that makes a third of all payments becomes one row per period
    on the map side, so no later exchange sees the hot key.
    """
    return (
        payments.where(F.col("id_persona_cuenta").isNotNull())
        .groupBy("id_persona_cuenta", *periods)
        .agg(F.sum("importe").alias("importe"))
    )
