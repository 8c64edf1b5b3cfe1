"""Wide records to lines, lots to one table, roster to dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_to_long(df: DataFrame, ids: list[str], categories: list[str]) -> DataFrame:
    """One row per record and category that has a value."""
    present = [c for c in categories if c in df.columns]
    return df.unpivot(ids, present, "rotulo", "valor").where(F.col("valor").isNotNull())


def combine_lots(*lots: DataFrame) -> DataFrame:
    """Stack lots whose columns differ; a column a lot lacks becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lots)


def roster_buildings(roster: DataFrame) -> DataFrame:
    return roster.select("consorcio").where(F.col("consorcio").isNotNull()).distinct()


def roster_units(roster: DataFrame) -> DataFrame:
    """Units by natural key (building, number)."""
    return roster.select("consorcio", "numero", "piso", "departamento").distinct()


def roster_accounts(roster: DataFrame) -> DataFrame:
    """Account numbers with the unit each belongs to."""
    return roster.select("cbu", "consorcio", "numero").where(F.col("cbu").isNotNull()).distinct()
