"""Rejecting incomplete rows and reporting duplicate keys."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Split(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def with_reason(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``motivo``: the first rule a row breaks, NULL where it breaks none.

    A rule maps a reason to the condition a good row meets; a NULL condition
    counts as broken.
    """
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in rules.items()]
    return df.withColumn("motivo", F.coalesce(*broken, F.lit(None).cast("string")))


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> Split:
    """Accepted rows, and rejected rows with ``motivo``."""
    tagged = with_reason(df, rules)
    return Split(
        accepted=tagged.where(F.col("motivo").isNull()).drop("motivo"),
        rejected=tagged.where(F.col("motivo").isNotNull()),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows (``filas``)."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("filas")).where(F.col("filas") > 1)
    )
