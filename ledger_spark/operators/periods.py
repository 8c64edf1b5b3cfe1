"""Period sets: which months a report covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger_spark.functions.text import normalise


def split_list(spark: SparkSession, text: str) -> DataFrame:
    """One row ``periodo`` per distinct entry of a comma-separated list."""
    entries = spark.range(1).select(F.explode(F.split(F.lit(text), ",")).alias("entry"))
    return entries.select(normalise(F.col("entry")).alias("periodo")).distinct()


def period_set(charges: DataFrame, periods: str | None = None, building=None) -> DataFrame:
    """Distinct normalised periods: the given list, else those of the charges in scope."""
    if periods is not None:
        return split_list(charges.sparkSession, periods)
    scope = charges if building is None else charges.where(F.col("id_consorcio") == building)
    names = scope.select(normalise(F.col("periodo")).alias("periodo"))
    return names.where(F.col("periodo").isNotNull()).distinct()


def charges_in_periods(charges: DataFrame, periods: str | None = None, building=None) -> DataFrame:
    """Charges of the building whose period is in the list.

    Without a list every period in scope qualifies, so no join is needed;
    only rows without a period fall out, as they would in the join.
    """
    scope = charges if building is None else charges.where(F.col("id_consorcio") == building)
    if periods is None:
        return scope.where(F.col("periodo").isNotNull())
    wanted = split_list(charges.sparkSession, periods).withColumnRenamed("periodo", "wanted")
    return scope.join(wanted, normalise(F.col("periodo")) == F.col("wanted"), "left_semi")
