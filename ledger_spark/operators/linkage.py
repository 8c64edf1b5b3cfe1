"""The same person under another spelling: texts one edit apart, and groups of linked rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger_spark.session import discard, staged_at

# Longer texts are looked up by their halves; each deletion of a shorter one is a key.
LONG = 64


def plain_name(*parts: Column) -> Column:
    """The parts in lower case with one blank between words and without accents; NULL where empty."""
    joined = F.lower(F.regexp_replace(F.trim(F.concat_ws(" ", *parts)), r"\s+", " "))
    return F.nullif(F.translate(joined, "áéíóúüñ", "aeiouun"), F.lit(""))


def _keys(text: Column) -> Column:
    """Texts of which two texts share one at least if they are one edit apart.

    A short text gives itself and itself without each of its characters. Of a long one an edit leaves
    the first or the last half alone, half being that of the shorter text.
    """
    size = F.length(text)
    without = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.concat(text.substr(F.lit(1), i - 1), text.substr(i + 1, size)),
    )
    short = F.array_distinct(F.concat(F.array(text), without))
    halves = [F.floor(size / 2).cast("int"), F.floor((size - 1) / 2).cast("int")]
    long = F.array(
        *[F.concat(F.lit("<"), n.cast("string"), F.lit(":"), text.substr(F.lit(1), n)) for n in halves],
        *[F.concat(F.lit(">"), n.cast("string"), F.lit(":"), text.substr(size - n + 1, n)) for n in halves],
    )
    return (
        F.when(size == 0, F.array(text))
        .when(size < LONG, short)
        .when(size > LONG, F.array_distinct(long))
        .otherwise(F.array_distinct(F.concat(short, long)))
    )


def one_edit_apart(values: DataFrame, text: str, within: list[str] = ()) -> DataFrame:
    """(*within, a, b) with a < b: different texts of equal ``within`` at Levenshtein distance one.

    Every text is looked up by its keys, not compared with all others: texts that share a key are
    different, so a key of short texts holds no more of them than there are ways to put one
    character back. Repeated rows count once; NULLs, also in ``within``, are linked to nothing.
    """
    within = list(within)
    known = values.select(*within, F.col(text).alias("a")).dropna().distinct()
    keyed = known.withColumn("_k", F.explode(_keys(F.col("a"))))
    keyed = keyed.select(*within, "a", F.xxhash64(*within, "_k").alias("_k"))
    other = keyed.select(*[F.col(c).alias(f"_o_{c}") for c in within], F.col("a").alias("b"), "_k")
    same = [F.col(c) == F.col(f"_o_{c}") for c in within]
    met = keyed.join(other, "_k").where(F.col("a") < F.col("b"))
    for condition in same:
        met = met.where(condition)
    return met.where(F.levenshtein("a", "b", 1) == 1).select(*within, "a", "b").distinct()


def groups(pairs: DataFrame) -> DataFrame:
    """(nodo, grupo, enlaces) of every node in ``pairs`` (a, b): the least node that can be reached from
    it, itself included, and its number of different neighbours.

    In each round a node takes the least label of its neighbours and then the label of that label.
    Rounds are written tables, the last but one is removed; the driver sees one number per round.
    """
    spark = pairs.sparkSession
    both = pairs.select("a", "b").union(pairs.select("b", "a")).where("a <> b").distinct()
    edges, edges_at = staged_at(both, "linked")
    labels, at = staged_at(
        edges.groupBy(F.col("a").alias("nodo")).agg(
            F.least(F.col("nodo"), F.min("b")).alias("grupo"), F.count(F.lit(1)).alias("enlaces")
        ),
        "groups",
    )
    while True:
        offered = (
            edges.join(labels.select(F.col("nodo").alias("b"), "grupo"), "b")
            .groupBy(F.col("a").alias("nodo"))
            .agg(F.min("grupo").alias("_ofrecido"))
        )
        near = labels.join(offered, "nodo").select(
            "nodo", "grupo", F.least("grupo", "_ofrecido").alias("_menor"), "enlaces"
        )
        over = labels.select(F.col("nodo").alias("_menor"), F.col("grupo").alias("_siguiente"))
        found = near.join(over, "_menor").select(
            "nodo", F.col("_siguiente").alias("_nuevo"), "enlaces", "grupo"
        )
        following, next_at = staged_at(
            found.select(
                "nodo",
                F.col("_nuevo").alias("grupo"),
                "enlaces",
                (F.col("_nuevo") != F.col("grupo")).alias("_movido"),
            ),
            "groups",
        )
        discard(spark, at)
        at, labels = next_at, following.drop("_movido")
        if following.where("_movido").isEmpty():
            discard(spark, edges_at)
            return labels
