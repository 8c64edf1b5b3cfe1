"""Keeping tasks even: rows about to multiply, and joins on uneven keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def spread(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Hash the rows into a number of partitions, by default as many as the session shuffles into.

    Adaptive execution sizes partitions by the bytes that enter a stage. Where
    a row leaves it as a hundred, that gives far too few tasks; a fixed number
    of partitions is not merged.
    """
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions or default, *keys)


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows, whose keys may be very uneven, to one lookup row per key.

    Adaptive execution splits the rows of a hot key over many tasks, but only
    where both sides come straight out of an exchange. A lookup that was just
    grouped by the key does not: it is already partitioned by it. With a digest
    as second join key it is exchanged once more, and the hot key can be split.
    A lookup that is small enough is broadcast all the same.

    Whole numbers of different types (int and bigint) compare equal but digest
    unequal, so the digest is taken of them as bigint. Other keys of different
    types, of which one value may be written in several ways (7, 7.00, 007), are
    joined by the key alone.
    """
    kinds = [df.schema[key].dataType for df in (rows, lookup)]
    if kinds[0] == kinds[1]:
        digest = F.xxhash64(key)
    elif all(isinstance(kind, IntegralType) for kind in kinds):
        digest = F.xxhash64(F.col(key).cast("bigint"))
    else:
        return rows.join(lookup, key, how)
    return (
        rows.withColumn("_digest", digest)
        .join(lookup.withColumn("_digest", digest), [key, "_digest"], how)
        .drop("_digest")
    )
