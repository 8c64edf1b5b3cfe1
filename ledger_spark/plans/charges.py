"""Monthly charges: building totals, each unit's share, and the running balance."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger_spark.functions.amounts import or_zero, percent_of
from ledger_spark.functions.categories import EXTRAORDINARY
from ledger_spark.operators.spread import lookup_join, spread
from ledger_spark.plans.payers import account_units, paid_by_account
from ledger_spark.schemas import MONEY, TOTAL


def charge_rollup(
    expense_lines: DataFrame, keys: list[str] = ("id_consorcio", "mes")
) -> DataFrame:
    """Ordinary and extraordinary totals of the expense lines per key."""
    extra = F.col("clase") == EXTRAORDINARY
    return expense_lines.groupBy(*keys).agg(
        F.sum(F.when(~extra, F.col("importe"))).cast(MONEY).alias("total_ordinarios"),
        F.sum(F.when(extra, F.col("importe"))).cast(MONEY).alias("total_extraordinarios"),
    )


def _monthly_totals(charges: DataFrame, include_extra: bool) -> DataFrame:
    amount = or_zero(F.col("total_ordinarios"))
    if include_extra:
        amount = amount + or_zero(F.col("total_extraordinarios"))
    return charges.groupBy("id_consorcio", "mes").agg(F.sum(amount).cast(MONEY).alias("total"))


def _share(total) -> Column:
    return percent_of(total, or_zero(F.col("porcentaje_de_prorrateo"))).cast(MONEY)


def _by_month(rows: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """One row per key with a map from month to value: an entry per calendar month. Rows without a
    month are no part of any; ``undated`` reports them."""
    entries = F.collect_list(F.struct("mes", value))
    return rows.where(F.col("mes").isNotNull()).groupBy(key).agg(F.map_from_entries(entries).alias(alias))


def _with_totals(
    units: DataFrame, paid: DataFrame, by_building: DataFrame, partitions: int | None
) -> tuple[DataFrame, DataFrame]:
    """Units with ``pagos`` of their id and ``totales`` of their building, as maps: those whose id
    occurs once, a row each, and the rows of all others, each id in one partition.

    Units are counted and meet their payments where they were dealt out by id. The totals, which make
    a row large, come last, so they are not shuffled with units of the first kind.
    """
    rows = _with_payments(units, paid, partitions)

    def complete(some: DataFrame) -> DataFrame:
        return lookup_join(some.drop("_filas"), by_building, "id_consorcio", "left")

    repeated = spread(complete(rows.where("_filas > 1")), "id_uf", partitions=partitions)
    return complete(rows.where("_filas = 1")), repeated


def _with_payments(units: DataFrame, paid: DataFrame, partitions: int | None) -> DataFrame:
    """Units dealt out by id, with ``pagos`` of their id and the number of rows that have it (``_filas``)."""
    dealt = spread(
        units.select("id_uf", "id_consorcio", "porcentaje_de_prorrateo"), "id_uf", partitions=partitions
    )
    rows = dealt.withColumn("_filas", F.count(F.lit(1)).over(Window.partitionBy("id_uf")))
    return rows.join(paid, "id_uf", "left")


def _shares_so_far(units: DataFrame, by_building: DataFrame, partitions: int | None) -> DataFrame:
    """(_clave, cargos) per building and percentage of ``units``: (mes, cargo, pagado, saldo_final) of each
    month charged, for a unit that paid nothing.

    Shares are rounded month by month, so units of one building and one percentage have one running
    sum: it is made once for all of them, and a building has no more of them than there are percentages.
    Never sent to the driver: Spark takes an array for a single entry and would broadcast them all.
    """
    pairs = units.select("id_consorcio", _percentage().alias("porcentaje_de_prorrateo")).distinct()
    rows = lookup_join(pairs.where(F.col("id_consorcio").isNotNull()), by_building, "id_consorcio")
    months = (
        spread(rows.select(_key(), "porcentaje_de_prorrateo", "totales"), "_clave", partitions=partitions)
        .select("_clave", "porcentaje_de_prorrateo", F.explode("totales").alias("mes", "total"))
        .select("_clave", "mes", or_zero(_share(F.col("total"))).cast(MONEY).alias("cargo"))
    )
    history = Window.partitionBy("_clave").orderBy("mes").rowsBetween(Window.unboundedPreceding, 0)
    nothing = F.lit(0).cast(MONEY).alias("pagado")
    so_far = F.sum("cargo").over(history).cast(TOTAL).alias("saldo_final")
    return (
        months.select("_clave", "mes", "cargo", nothing, so_far)
        .groupBy("_clave")
        .agg(F.collect_list(F.struct("mes", "cargo", "pagado", "saldo_final")).alias("cargos"))
        .hint("merge")
    )


def _percentage() -> Column:
    return or_zero(F.col("porcentaje_de_prorrateo"))


def _key() -> Column:
    return F.struct("id_consorcio", _percentage().alias("porcentaje")).alias("_clave")


def _less_payments(charged: str, paid: str) -> Column:
    """The months of ``charged`` with those of the map ``paid``, and the balances after both."""
    none = F.array().cast("array<struct<mes: date, cargo: decimal(18,2), pagado: decimal(18,2), saldo_final: decimal(28,2)>>")
    nothing = F.lit(0).cast(TOTAL)
    charges, payments = F.coalesce(charged, none), F.map_entries(paid)

    def paid_until(month: Column) -> Column:
        past = F.filter(payments, lambda p: p["key"] <= month)
        return F.aggregate(past, nothing, lambda total, p: (total + or_zero(p["value"])).cast(TOTAL))

    def entry(month: Column, charge: Column, balance: Column) -> Column:
        return F.struct(
            month.alias("mes"),
            charge.alias("cargo"),
            or_zero(F.try_element_at(paid, month)).cast(MONEY).alias("pagado"),
            (balance - paid_until(month)).cast(TOTAL).alias("saldo_final"),
        )

    def only_paid(month: Column) -> Column:
        last = F.array_max(F.filter(charges, lambda c: c["mes"] <= month))
        return entry(month, F.lit(0).cast(MONEY), F.coalesce(last["saldo_final"], nothing))

    both = F.transform(charges, lambda c: entry(c["mes"], c["cargo"], c["saldo_final"]))
    others = F.array_except(F.map_keys(paid), F.transform(charges, lambda c: c["mes"]))
    return F.concat(both, F.transform(others, only_paid))


def undated(charges: DataFrame, payments: DataFrame) -> DataFrame:
    """Charges without a month and payments without a day: their number and sum. They are in no
    monthly result."""
    amount = or_zero(F.col("total_ordinarios")) + or_zero(F.col("total_extraordinarios"))
    parts = [
        charges.where(F.col("mes").isNull()).select(F.lit("expensas").alias("tabla"), amount.alias("x")),
        payments.where(F.col("fecha_de_pago").isNull()).select(
            F.lit("pagos").alias("tabla"), or_zero(F.col("importe")).alias("x")
        ),
    ]
    return parts[0].union(parts[1]).groupBy("tabla").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("x").cast(TOTAL).alias("importe")
    )


def unit_charges(
    units: DataFrame, charges: DataFrame, include_extra: bool = True, partitions: int | None = None
) -> DataFrame:
    """Each unit's share of its building's total, per month, rounded to cents. ``partitions`` is the
    number of tasks that write the month rows."""
    totals = _monthly_totals(charges, include_extra)
    by_building = _by_month(totals, "id_consorcio", "total", "totales")
    return (
        spread(lookup_join(units, by_building, "id_consorcio"), "id_uf", partitions=partitions)
        .select("*", F.explode("totales").alias("mes", "total"))
        .select("id_uf", "id_consorcio", "mes", _share(F.col("total")).alias("cargo"))
    )


def unit_statement(
    units: DataFrame,
    charges: DataFrame,
    payments: DataFrame,
    accounts: DataFrame,
    unit_people: DataFrame,
    include_extra: bool = True,
    since: datetime.date | None = None,
    until: datetime.date | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Opening balance, charge, payments and closing balance per unit and month.

    A payment is credited to the payer's first unit in the month it was made.

    The result has a row per unit and month, many times the rows of its inputs,
    so those rows are made last, and are neither sorted nor shuffled. Until then
    a unit is one row. What it was charged so far is a lookup by building and
    percentage, and the few units that payments are credited to take off theirs
    within the row. Only an id that occurs more than once goes through a window
    over its month rows.

    ``since`` and ``until`` choose the months to show; balances always count
    the whole history.
    """
    paid = (
        paid_by_account(payments, F.trunc("fecha_de_pago", "month").alias("mes"))
        .join(account_units(accounts, unit_people), "id_persona_cuenta")
        .groupBy("id_uf", "mes")
        .agg(F.sum("importe").cast(MONEY).alias("pagado"))
    )
    totals = _monthly_totals(charges, include_extra)
    by_building = _by_month(totals, "id_consorcio", "total", "totales")
    paid_months = _by_month(paid, "id_uf", "pagado", "pagos")
    once = _with_payments(units, paid_months, partitions).where("_filas = 1")
    shares = _shares_so_far(units, by_building, partitions)
    rows = lookup_join(once.select("id_uf", "pagos", _key()), shares, "_clave", "left")
    months = F.when(F.col("pagos").isNull(), F.col("cargos")).otherwise(_less_payments("cargos", "pagos"))
    balances = rows.select("id_uf", F.explode(months).alias("_m")).select("id_uf", "_m.*")
    _, repeated = _with_totals(units, paid_months, by_building, partitions)
    balances = balances.unionByName(_month_by_month(repeated))
    if since is not None:
        balances = balances.where(F.col("mes") >= F.lit(since.replace(day=1)))
    if until is not None:
        balances = balances.where(F.col("mes") <= F.lit(until))
    return balances.select(
        "id_uf",
        "mes",
        (F.col("saldo_final") - (F.col("cargo") - F.col("pagado"))).cast(TOTAL).alias("saldo_anterior"),
        "cargo",
        "pagado",
        "saldo_final",
    )


def _month_by_month(units: DataFrame) -> DataFrame:
    """(id_uf, mes, cargo, pagado, saldo_final) of units with ``totales`` and ``pagos``, each id in one
    partition."""
    dates = F.array().cast("array<date>")
    months = F.array_union(
        F.coalesce(F.map_keys("totales"), dates), F.coalesce(F.map_keys("pagos"), dates)
    )
    by_month = units.select("*", F.explode(months).alias("mes")).select(
        "id_uf",
        "mes",
        or_zero(_share(F.try_element_at("totales", F.col("mes")))).cast(MONEY).alias("cargo"),
        or_zero(F.try_element_at("pagos", F.col("mes"))).cast(MONEY).alias("pagado"),
    )
    history = Window.partitionBy("id_uf").orderBy("mes").rowsBetween(Window.unboundedPreceding, 0)
    change = F.col("cargo") - F.col("pagado")
    return by_month.withColumn("saldo_final", F.sum(change).over(history).cast(TOTAL))
