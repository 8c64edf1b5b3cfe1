"""Which charge a payment settles: the oldest open one first."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger_spark.functions.amounts import or_zero
from ledger_spark.operators.spread import spread
from ledger_spark.plans.charges import _by_month, _monthly_totals, _share, _with_totals
from ledger_spark.plans.payers import account_units, paid_by_account
from ledger_spark.schemas import MONEY, TOTAL
from ledger_spark.tables import LedgerTables

# Days that a charge has been open, as (up to, name); older ones have the last name.
AGES = ((30, "0-30"), (60, "31-60"), (90, "61-90"))
OLDER = "mas de 90"


def _movements(
    tables: LedgerTables,
    charges: DataFrame,
    include_extra: bool,
    until: datetime.date | None,
    partitions: int | None,
    settling: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(id_uf, id_consorcio, movimientos) per unit: (abono, fecha, importe) of each month charged and each
    day paid, all amounts positive, a date perhaps more than once. First the units whose id occurs
    once, then the rows of all others, each id in one partition.

    What is credited to a month counts as paid on its first day, and what is taken back from a day's
    payments as charged in its month.
    """
    payments, dated = tables.payments, charges.where(F.col("mes").isNotNull())
    if until is not None:
        payments = payments.where(F.col("fecha_de_pago") <= F.lit(until))
        dated = dated.where(F.col("mes") <= F.lit(until))
    day = F.col("fecha_de_pago").cast("date").alias("mes")
    paid = (
        paid_by_account(payments.where(F.col("fecha_de_pago").isNotNull()), day)
        .join(account_units(tables.accounts, tables.unit_people), "id_persona_cuenta")
        .groupBy("id_uf", "mes")
        .agg(F.sum("importe").cast(MONEY).alias("pagado"))
    )
    by_building = _by_month(_monthly_totals(dated, include_extra), "id_consorcio", "total", "totales")
    paid_days = _by_month(paid, "id_uf", "pagado", "pagos")
    none = F.array().cast("array<struct<abono: boolean, fecha: date, importe: decimal(18,2)>>")

    def events(of: str, credit: bool, amount) -> Column:
        def event(entry: Column) -> Column:
            value = amount(entry["value"])
            back = value < 0
            # A taken-back payment is charged in its month; the first day of a month is the month.
            at = F.when(back & F.lit(credit), F.trunc(entry["key"], "month")).otherwise(entry["key"])
            return F.struct(
                (back != F.lit(credit)).alias("abono"),
                at.alias("fecha"),
                F.abs(value).cast(MONEY).alias("importe"),
            )

        return F.coalesce(F.transform(F.map_entries(of), event), none)

    share = events("totales", False, lambda total: or_zero(_share(total)))
    moved = F.filter(F.concat(share, events("pagos", True, or_zero)), lambda x: x["importe"] > 0)
    once, repeated = _with_totals(tables.units, paid_days, by_building, partitions)
    if settling:
        # Others have no credit: neither payments nor a share below zero.
        once = once.where(
            F.col("pagos").isNotNull()
            | (F.col("porcentaje_de_prorrateo") < 0)
            | F.exists(F.map_values("totales"), lambda total: total < 0)
        )
    columns = ["id_uf", "id_consorcio", moved.alias("movimientos")]
    return once.select(*columns), repeated.select(*columns)


def _of(credit: bool, moves: str = "movimientos") -> Column:
    """Movements of one kind from the oldest on."""
    return F.array_sort(F.filter(moves, lambda x: x["abono"] == F.lit(credit)))


def _sum_of(moves: str) -> Column:
    return F.aggregate(moves, F.lit(0).cast(TOTAL), lambda so_far, x: (so_far + x["importe"]).cast(TOTAL))


def _until(moves: str, most: str) -> Column:
    """The first movements whose sum reaches ``most``."""
    none = F.filter(moves, lambda x: F.lit(False))
    start = F.struct(F.lit(0).cast(TOTAL).alias("suma"), none.alias("tomados"))

    def taken(so_far: Column, x: Column) -> Column:
        return F.struct(
            (so_far["suma"] + x["importe"]).cast(TOTAL).alias("suma"),
            F.array_append(so_far["tomados"], x).alias("tomados"),
        )

    return F.aggregate(
        moves,
        start,
        lambda so_far, x: F.when(so_far["suma"] < F.col(most), taken(so_far, x)).otherwise(so_far),
        lambda so_far: so_far["tomados"],
    )


def _settled_ahead(units: DataFrame) -> DataFrame:
    """Units, an id a row, without the charges behind all they paid and without what they paid beyond
    all charges."""
    sides = units.select("id_uf", "id_consorcio", _of(False).alias("cargos"), _of(True).alias("abonos"))
    sums = sides.withColumns({"cargado": _sum_of("cargos"), "abonado": _sum_of("abonos")})
    return sums.select(
        "id_uf",
        "id_consorcio",
        F.concat(_until("cargos", "abonado"), _until("abonos", "cargado")).alias("movimientos"),
    )


def _rows(units: DataFrame) -> DataFrame:
    """(id_uf, id_consorcio, abono, fecha, importe): a row per date and kind."""
    same = ["id_uf", "id_consorcio", "abono", "fecha"]
    # Not the inner form: that puts a filter with the whole expression before it, computed once more.
    rows = units.select("id_uf", "id_consorcio", F.inline_outer("movimientos")).where("importe IS NOT NULL")
    return rows.groupBy(*same).agg(F.sum("importe").cast(MONEY).alias("importe"))


def _reached(movements: DataFrame) -> DataFrame:
    """Movements with ``hasta``, what has been charged, or paid, up to and with each."""
    order = Window.partitionBy("id_uf").orderBy("fecha").rowsBetween(Window.unboundedPreceding, 0)
    amount = F.col("importe")
    so_far = F.when(F.col("abono"), F.sum(F.when(F.col("abono"), amount)).over(order)).otherwise(
        F.sum(F.when(~F.col("abono"), amount)).over(order)
    )
    return movements.withColumn("hasta", so_far.cast(TOTAL))


def payment_allocation(
    tables: LedgerTables,
    charges: DataFrame,
    include_extra: bool = True,
    until: datetime.date | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """(id_uf, mes, fecha, importe): what each day's payments settle of each month's charge.

    Payments of a unit settle its charges from the oldest on; what is paid ahead settles later ones.
    The charges of a unit laid end to end, and its payments laid end to end, cut one line into
    pieces: each piece is one row, of the charge and the payment it lies in. So a unit has fewer rows
    than it has months and days together, and they come from one window over these, not from a join
    by ranges. Charges beyond the payments and payments beyond the charges are in no row: units
    without a credit, and what lies beyond the shorter line of a unit, never become rows.
    """
    once, repeated = _movements(tables, charges, include_extra, until, partitions, settling=True)
    # Dealt out by id again, now that a unit holds no more than can be settled.
    short = spread(_settled_ahead(once), "id_uf", partitions=partitions)
    return _pieces(_rows(short)).unionByName(_pieces(_rows(repeated)))


def _pieces(movements: DataFrame) -> DataFrame:
    points = _reached(movements)
    # Backwards, so that what comes next on the line has been seen already.
    line = Window.partitionBy("id_uf").orderBy(F.desc("hasta"), F.desc("abono"), F.desc("fecha"))
    ahead = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.coalesce(F.lead("hasta").over(line), F.lit(0).cast(TOTAL))

    def holder(credit: bool) -> Column:
        mine = F.when(F.col("abono") == F.lit(credit), F.col("fecha"))
        return F.last(mine, ignorenulls=True).over(ahead)

    pieces = points.select(
        "id_uf",
        holder(False).alias("mes"),
        holder(True).alias("fecha"),
        (F.col("hasta") - before).cast(MONEY).alias("importe"),
    )
    return pieces.where("mes IS NOT NULL AND fecha IS NOT NULL AND importe > 0")


def debt_by_age(
    tables: LedgerTables,
    charges: DataFrame,
    cutoff: datetime.date,
    include_extra: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """(id_consorcio, antiguedad, unidades, deuda) at the cut-off: what is open of the charges after
    payments settled the oldest ones, by the days since the first of their month.

    The charges of an age follow each other on the line, so of each age is open by what the charges up
    to its newest exceed all payments, at most all its charges: sums within the unit's row. Only an id
    that occurs more than once, perhaps in several buildings, is laid out charge by charge.
    """
    once, repeated = _movements(tables, charges, include_extra, cutoff, partitions)
    names = [OLDER] + [name for _, name in reversed(AGES)]
    oldest_first = [F.lit(cutoff - datetime.timedelta(days=most)) for most, _ in reversed(AGES)]
    start = F.struct(*[F.lit(0).cast(TOTAL).alias(x) for x in ("abonado", *names)])

    def add(so_far: Column, x: Column) -> Column:
        def grown(name: str, mine: Column) -> Column:
            more = F.when(mine, x["importe"]).otherwise(F.lit(0).cast(MONEY))
            return (so_far[name] + more).cast(TOTAL).alias(name)

        # Charged in each age or an older one; the last holds all charges.
        upto = [~x["abono"] & (x["fecha"] < day) for day in oldest_first] + [~x["abono"]]
        return F.struct(grown("abonado", x["abono"]), *map(grown, names, upto))

    sums = once.select("id_consorcio", F.aggregate("movimientos", start, add).alias("s"))
    nothing, open_of, before = F.lit(0).cast(TOTAL), [], F.lit(0).cast(TOTAL)
    for name in names:
        reached = F.greatest(F.col("s")[name] - F.col("s")["abonado"], nothing).cast(TOTAL)
        open_of.append(F.struct(F.lit(name).alias("antiguedad"), (reached - before).cast(TOTAL).alias("abierto")))
        before = reached
    by_unit = sums.select("id_consorcio", F.inline(F.array(*open_of))).where("abierto > 0")
    by_unit = by_unit.unionByName(_open_by_charge(_rows(repeated), cutoff))
    return by_unit.groupBy("id_consorcio", "antiguedad").agg(
        F.count(F.lit(1)).alias("unidades"), F.sum("abierto").cast(TOTAL).alias("deuda")
    )


def _open_by_charge(movements: DataFrame, cutoff: datetime.date) -> DataFrame:
    """(id_consorcio, antiguedad, abierto) per unit. A charge is open by what the charges up to it exceed
    all payments, at most by itself."""
    points = _reached(movements)
    unit = Window.partitionBy("id_uf")
    paid = or_zero(F.sum(F.when(F.col("abono"), F.col("importe"))).over(unit))
    left = F.least(F.col("importe"), F.col("hasta") - paid)
    open_ = points.withColumn("abierto", left).where("NOT abono AND abierto > 0")
    days = F.datediff(F.lit(cutoff), F.col("fecha"))
    age = F.when(days <= AGES[0][0], AGES[0][1])
    for most, name in AGES[1:]:
        age = age.when(days <= most, name)
    by_unit = open_.groupBy("id_uf", "id_consorcio", age.otherwise(OLDER).alias("antiguedad")).agg(
        F.sum("abierto").alias("abierto")
    )
    return by_unit.drop("id_uf").withColumn("abierto", F.col("abierto").cast(TOTAL))
