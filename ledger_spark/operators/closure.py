"""Everything that can be reached over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_spark.session import staged


def closure(edges: DataFrame) -> DataFrame:
    """(nodo, destino, pasos): every other node that each node reaches over ``edges`` (nodo, destino),
    with the fewest steps.

    Each round doubles the steps: paths of exactly 2^k steps are continued by all known ones. A
    shortest path is cut at its 2^k-th node into two shortest paths, so nothing is missed and a pair
    is found about once. Pairs known already are left out, so circles end, and as known pairs meet the
    new ones once a round, they are shuffled as often as the logarithm of the longest path. Each
    round is a written table; the driver sees one answer per round. NULLs reach nothing.
    """
    edges = edges.where("nodo IS NOT NULL AND destino IS NOT NULL AND nodo <> destino")
    last = staged(edges.select("nodo", "destino").distinct().withColumn("pasos", F.lit(1)), "closure")
    known, steps = last, 1
    while True:
        longest = last.where(F.col("pasos") == steps)
        if longest.isEmpty():
            return known
        ahead = known.select(
            F.col("nodo").alias("_medio"), F.col("destino").alias("_fin"), F.col("pasos").alias("_mas")
        )
        found = (
            longest.join(ahead, F.col("destino") == F.col("_medio"))
            .where(F.col("nodo") != F.col("_fin"))
            .groupBy("nodo", F.col("_fin").alias("destino"))
            .agg(F.min(F.col("pasos") + F.col("_mas")).alias("pasos"))
        )
        found = found.join(known.select("nodo", "destino"), ["nodo", "destino"], "left_anti")
        last = staged(found, "closure")
        known, steps = known.unionByName(last), 2 * steps


def paths(start: DataFrame, edges: DataFrame) -> DataFrame:
    """(origen, nodo, distancia): the nodes of ``start`` (origen, nodo), one step away, and all that these
    reach over ``edges``. An origin with several nodes may have a pair more than once; the least
    distance is among them."""
    start = start.where("origen IS NOT NULL AND nodo IS NOT NULL").select("origen", "nodo").distinct()
    onward = start.join(closure(edges), "nodo").select(
        "origen", F.col("destino").alias("nodo"), (F.col("pasos") + 1).alias("distancia")
    )
    return start.withColumn("distancia", F.lit(1)).unionByName(onward)


def reachable(start: DataFrame, edges: DataFrame) -> DataFrame:
    """(origen, nodo, distancia): every node that each origin of ``start`` (origen, nodo) reaches over
    ``edges`` (nodo, destino), with the fewest steps; the nodes of ``start`` are one step away."""
    return paths(start, edges).groupBy("origen", "nodo").agg(F.min("distancia").alias("distancia"))
