"""Connected components of an edge table, without bringing edges or components to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_spark.llm.tables import scratch
from ledger_spark.operators.spread import lookup_join


def _smallest(edges: DataFrame, by: str, other: str) -> DataFrame:
    """Per node its smallest neighbour or itself; combined in the map tasks first."""
    return edges.groupBy(by).agg(F.least(F.min(other), F.first(by)).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its smallest node.

    Rounds of two star steps: every node links its larger neighbours, then its smaller ones, to the
    smallest node it knows. Components turn into stars in a logarithmic number of rounds. Each round
    is a written table, so a lost executor costs one round at most.
    """
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    pairs, state = scratch(pairs.distinct(), "edges"), None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            lookup_join(both.where("b > a"), _smallest(both, "a", "b"), "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        small = (
            lookup_join(large, _smallest(large, "a", "b"), "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        pairs = scratch(small, "edges")
        before, state = state, pairs.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
    stars = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.union(centres)
