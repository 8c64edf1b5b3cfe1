"""Shares of a total that add up to it to the cent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledger_spark.functions.amounts import or_zero
from ledger_spark.operators.spread import lookup_join, spread
from ledger_spark.plans.charges import _monthly_totals
from ledger_spark.schemas import MONEY

# Hexadecimal digits of the id's digest that deal the units of one weight into ranges.
RANGE_DIGITS = 3


def _ranked(units: DataFrame) -> DataFrame:
    """Units with their weight and their place among those of equal weight in their building.

    The place follows the digest of the id, not the id. Units are counted by ranges of digests, the
    counts summed up over the ranges (at most 16 to the power of ``RANGE_DIGITS`` of a weight), and
    only within a range are units numbered, so that a building with very many units is many tasks.
    """
    weight = (or_zero(F.col("porcentaje_de_prorrateo")) * 100).cast("long")
    digest = F.md5(F.col("id_uf").cast("string").cast("binary"))
    rows = units.select(
        "id_uf",
        "id_consorcio",
        F.when(weight > 0, weight).otherwise(F.lit(0)).cast("long").alias("peso"),
        digest.alias("_digest"),
        F.substring(digest, 1, RANGE_DIGITS).alias("_range"),
    )
    same = ["id_consorcio", "peso"]
    counts = rows.groupBy(*same, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*same).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.struct(*same, "_range").alias("_key"), or_zero(F.sum("_n").over(before)).alias("_before")
    )
    inside = Window.partitionBy(*same, "_range").orderBy("_digest", "id_uf")
    rows = rows.withColumn("_place", F.row_number().over(inside))
    rows = lookup_join(rows.withColumn("_key", F.struct(*same, "_range")), offsets, "_key")
    return rows.select("id_uf", *same, (F.col("_before") + F.col("_place")).alias("lugar"))


def _quotas(units: DataFrame, totals: DataFrame) -> DataFrame:
    """Per building, weight and month: cents of every unit of that weight, and how many of them get
    one cent more.

    What is left after rounding down goes to the largest remainders. Units of one weight have one
    remainder, so a histogram of weights tells how far the cents reach: a building has at most as
    many rows here as there are percentages, whatever its units.
    """
    weights = units.groupBy("id_consorcio", "peso").agg(F.count(F.lit(1)).alias("unidades"))
    sums = weights.groupBy("id_consorcio").agg(
        F.sum(F.col("peso") * F.col("unidades")).alias("pesos"), F.sum("unidades").alias("todas")
    )
    weights = weights.join(sums, "id_consorcio").select(
        "id_consorcio",
        "peso",
        "unidades",
        # Without any percentage all units count alike.
        F.when(F.col("pesos") > 0, F.col("peso")).otherwise(1).cast("decimal(10,0)").alias("_peso"),
        F.when(F.col("pesos") > 0, F.col("pesos")).otherwise(F.col("todas")).cast("decimal(18,0)").alias("_pesos"),
    )
    cents = (F.abs("total") * 100).cast("decimal(20,0)")
    rows = weights.join(totals.select("id_consorcio", "mes", "total"), "id_consorcio").withColumns(
        {"_parts": cents * F.col("_peso"), "_cents": cents.cast("long")}
    )
    rows = rows.withColumns(
        {"cuota": F.expr("_parts div _pesos"), "_rest": F.expr("_parts % _pesos")}
    )
    month = Window.partitionBy("id_consorcio", "mes")
    left = F.col("_cents") - F.sum(F.col("cuota") * F.col("unidades")).over(month)
    larger = month.orderBy(F.desc("_rest"), "peso").rowsBetween(Window.unboundedPreceding, -1)
    reached = or_zero(F.sum("unidades").over(larger))
    more = F.least(F.greatest(left - reached, F.lit(0)), F.col("unidades"))
    return rows.select(
        "id_consorcio",
        "peso",
        "mes",
        F.struct(
            "mes",
            F.col("cuota").alias("cuota"),
            more.cast("long").alias("mas"),
            F.signum(F.col("total").cast("double")).cast("int").alias("signo"),
        ).alias("cuota"),
    )


def unit_charges_exact(
    units: DataFrame, charges: DataFrame, include_extra: bool = True, partitions: int | None = None
) -> DataFrame:
    """Each unit's share of its building's total per month, the shares of a month adding up to the
    total to the cent.

    Shares are in proportion to the percentages, which need not add up to a hundred; missing and
    negative ones count as 0, and where no unit has any all count alike. Every share is rounded down
    and the cents that are left go one each to the largest remainders, among equal ones to smaller
    percentages first and then by a digest of the id. A negative total is shared like a positive one.
    Charges without a month are left out (``undated`` reports them); a building without units has no
    rows.
    """
    ranked = _ranked(units)
    totals = _monthly_totals(charges, include_extra).where(F.col("mes").isNotNull())
    quotas = _quotas(ranked, totals).groupBy(F.struct("id_consorcio", "peso").alias("_key")).agg(
        F.collect_list("cuota").alias("_months")
    )
    rows = lookup_join(ranked.withColumn("_key", F.struct("id_consorcio", "peso")), quotas, "_key")
    dealt = spread(rows.select("id_uf", "id_consorcio", "lugar", "_months"), "id_uf", partitions=partitions)
    dealt = dealt.select("id_uf", "id_consorcio", "lugar", F.inline("_months"))
    cents = F.col("cuota") + F.when(F.col("lugar") <= F.col("mas"), 1).otherwise(0)
    amount = (cents * F.col("signo")).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")
    return dealt.select("id_uf", "id_consorcio", "mes", amount.cast(MONEY).alias("cargo"))
