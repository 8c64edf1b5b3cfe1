"""The last known value at a point in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledger_spark.operators.spread import lookup_join

FOUND_AT = "vigente_desde"


def as_of(
    rows: DataFrame, steps: DataFrame, time: str, by: list[str], values: list[str], block: str = "month"
) -> DataFrame:
    """``rows`` with the values of the last row of ``steps`` at or before their time.

    ``steps`` has one row per ``by`` and time. Rows stay all; one without a time, or before the first
    step of its kind, gets NULL values. ``FOUND_AT`` is the time of the step.

    Only the different times of the rows are looked up, in blocks of calendar time: within a block by
    a window over these times and the steps, and before the first step of a block by the value that
    is carried over from earlier blocks, of which there is one row each. So neither a currency that
    all rows ask for nor a time at which most of them lie is one task: the rows themselves meet only
    the row of their time.
    """
    at, value = F.col(time), F.struct(F.col(time).alias(FOUND_AT), *values).alias("_value")
    period = F.date_trunc(block, F.col(time)).alias("_block")
    known = steps.where(at.isNotNull()).select(*by, time, period, value, F.lit(0).alias("_asked"))
    asked = rows.where(at.isNotNull()).select(*by, time).distinct()
    asked = asked.select(
        *by, time, period, F.lit(None).cast(known.schema["_value"].dataType).alias("_value"), F.lit(1)
    )
    events = known.union(asked)

    last = events.groupBy(*by, "_block").agg(F.max("_value").alias("_value"))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(
        F.struct(*by, "_block").alias("_at"),
        F.last("_value", ignorenulls=True).over(earlier).alias("_carried"),
    )
    within = Window.partitionBy(*by, "_block").orderBy(time, "_asked")
    so_far = F.last("_value", ignorenulls=True).over(
        within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = events.withColumn("_value", so_far).where("_asked = 1")
    found = found.withColumn("_at", F.struct(*by, "_block"))
    found = lookup_join(found, carried, "_at", "left").select(
        F.struct(*by, time).alias("_key"), F.coalesce("_value", "_carried").alias("_value")
    )
    keyed = rows.withColumn("_key", F.when(at.isNotNull(), F.struct(*by, time)))
    joined = lookup_join(keyed, found, "_key", "left")
    return joined.select(*rows.columns, *[f"_value.{c}" for c in (FOUND_AT, *values)])
