"""Choosing among rows of one key, and loading the same rows twice safely."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The row that comes last in ``order`` for each key.

    ``row_number() = 1`` lets the optimizer keep only one row per key and map
    task before the exchange, so a key with very many rows is no hot group.
    ``order`` must tell the rows of a key apart, else the choice is arbitrary.
    """
    descending = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    latest = Window.partitionBy(*keys).orderBy(*descending)
    return df.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def _same(left: str, right: str, keys: list[str]) -> Column:
    pairs = [F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}")) for k in keys]
    return reduce(Column.__and__, pairs)


def _keys(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys])


def new_rows(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is not yet present (null-safe on the keys).

    A load is small next to the table it goes into. So the stored keys are
    first reduced to those of the load: where the load can be broadcast, the
    table is only scanned, and what is shuffled never exceeds the load.
    """
    loaded, stored = _keys(incoming, "_new_", keys), _keys(existing, "_old_", keys)
    present = stored.join(loaded, _same("_old_", "_new_", keys), "left_semi")
    return incoming.join(present, _same("", "_old_", keys), "left_anti")


def replace_rows(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The table with the incoming rows in place of stored ones of equal key."""
    loaded = _keys(incoming, "_new_", keys)
    return existing.join(loaded, _same("", "_new_", keys), "left_anti").unionByName(incoming)


def idempotent_upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    mode: str = "keep_existing",
    sequence: str | None = None,
) -> DataFrame:
    """The table after loading ``incoming``; loading it again changes nothing.

    ``keep_existing`` adds only keys not yet present. ``newest_wins`` keeps for
    each key the row with the highest ``sequence``; at equal sequence the
    stored row stays.
    """
    if mode == "keep_existing":
        return existing.unionByName(new_rows(existing, incoming, keys))
    if mode != "newest_wins":
        raise ValueError(f"unknown mode {mode!r}")
    if sequence is None:
        raise ValueError("newest_wins needs the sequence column")
    stacked = existing.withColumn("_stored", F.lit(1)).unionByName(
        incoming.withColumn("_stored", F.lit(0))
    )
    return keep_latest(stacked, keys, sequence, "_stored").drop("_stored")
