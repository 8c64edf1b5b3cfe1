"""List membership, existence across tables, and permission audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger_spark.operators.closure import paths
from ledger_spark.operators.spread import lookup_join
from ledger_spark.session import staged

# What may be permitted is numbered; a row holds the answers to so many of them as bits.
BITS = 64
# Hexadecimal digits of the digest that deals them into ranges to be numbered.
RANGE_DIGITS = 3
CELL = ["esquema", "objeto", "permiso"]


def in_list(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def exists_in(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with at least one match; never more than one row out per row in."""
    return df.join(other.select(*keys), keys, "left_semi")


def missing_from(desired: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a match: the gap between desired and present state."""
    return desired.join(present.select(*keys), keys, "left_anti")


def missing_members(desired: DataFrame, present: DataFrame) -> DataFrame:
    """Desired (role, member) pairs not yet present, each once."""
    return missing_from(desired.select("rol", "miembro").distinct(), present, ["rol", "miembro"])


def effective_access(permissions: DataFrame) -> DataFrame:
    """Per role and object whether access is allowed: granted and never denied.

    ``permissions`` has one row (rol, objeto, accion) per statement, with the
    action ``GRANT`` or ``DENY``.
    """
    granted = F.bool_or(F.col("accion") == "GRANT")
    denied = F.bool_or(F.col("accion") == "DENY")
    return permissions.groupBy("rol", "objeto").agg((granted & ~denied).alias("permitido"))


def _statements(permissions: DataFrame, objects: DataFrame) -> DataFrame:
    """Per role, object and kind of permission whether it is granted and whether it is denied;
    statements on a schema as those on each of its objects."""
    granted = F.bool_or(F.col("accion") == "GRANT").alias("otorgado")
    denied = F.bool_or(F.col("accion") == "DENY").alias("denegado")
    stated = permissions.groupBy("rol", "esquema", "objeto", "permiso").agg(granted, denied)
    of_schema = stated.where(F.col("objeto").isNull()).drop("objeto")
    of_schema = of_schema.join(objects.select("esquema", "objeto").distinct(), "esquema")
    return stated.where(F.col("objeto").isNotNull()).unionByName(of_schema)


def effective_access_users(
    permissions: DataFrame, members: DataFrame, objects: DataFrame
) -> DataFrame:
    """Per member, object and kind of permission whether access is allowed.

    ``permissions`` has one row (rol, esquema, objeto, permiso, accion) per statement; without an
    object it holds for every object of the schema. ``members`` has (rol, miembro), ``objects``
    (esquema, objeto). A member is allowed what any of its roles is granted and none is denied; a
    denial of one kind (ALTER) leaves the others (EXECUTE) alone. Statements on objects that
    ``objects`` does not list count as well.

    Statements and members become one row per key before they meet, so what is joined does not grow
    with repeated statements.
    """
    by_member = members.select("rol", "miembro").distinct().join(
        _statements(permissions, objects), "rol"
    )
    allowed = F.bool_or("otorgado") & ~F.bool_or("denegado")
    return by_member.groupBy("miembro", "esquema", "objeto", "permiso").agg(
        allowed.alias("permitido")
    )


def effective_access_nested(
    permissions: DataFrame, members: DataFrame, objects: DataFrame, nested: DataFrame
) -> DataFrame:
    """``effective_access_users`` where roles are members of roles.

    ``nested`` has (rol, dentro_de): what the outer role may or may not do holds for the inner one as
    well, over any number of levels; circles are followed once. ``distancia`` is the number of steps
    from the member to the nearest role that states anything on the object, 1 for a role of its own.
    A denial counts from any distance.

    Statements are bits of whole numbers, of one role and up to ``BITS`` objects with a kind of
    permission. Only these rows meet the members and are shuffled; rows of a member and an object are
    made last.
    """
    edges = nested.select(F.col("rol").alias("nodo"), F.col("dentro_de").alias("destino"))
    start = members.select(F.col("miembro").alias("origen"), F.col("rol").alias("nodo"))
    stated = staged(_statements(permissions, objects), "statements")
    cells = staged(_numbered(stated.select(*CELL).distinct()), "cells")
    roles = paths(start, edges).select(
        F.col("origen").alias("miembro"), F.col("nodo").alias("rol"), "distancia"
    )
    either = F.col("otorgado").bitwiseOR(F.col("denegado"))
    by_word = (
        roles.join(_words(stated, cells), "rol")
        .groupBy("miembro", "palabra")
        .agg(
            F.bit_or("otorgado").alias("otorgado"),
            F.bit_or("denegado").alias("denegado"),
            F.collect_list(F.struct("distancia", either.alias("dichos"))).alias("_dichos"),
        )
    )
    meaning = cells.groupBy("palabra").agg(F.collect_list(F.struct("bit", *CELL)).alias("_celdas"))
    levels = by_word.select("*", F.inline(_nearest("_dichos"))).drop("_dichos")
    rows = lookup_join(levels, meaning, "palabra").select("*", F.inline("_celdas"))

    def holds(word: str) -> Column:
        return F.col(word).bitwiseAND(F.col("bit")) != 0

    return rows.where(holds("primeros")).select(
        "miembro",
        "esquema",
        "objeto",
        "permiso",
        (holds("otorgado") & ~holds("denegado")).alias("permitido"),
        "distancia",
    )


def _nearest(levels: str) -> Column:
    """(distancia, primeros) for each distance: the bits that no smaller distance has."""
    none = F.array().cast("array<struct<distancia: int, primeros: bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("vistos"), none.alias("niveles"))

    def add(so_far: Column, x: Column) -> Column:
        first = x["dichos"].bitwiseAND(F.bitwise_not(so_far["vistos"]))
        level = F.struct(x["distancia"].alias("distancia"), first.alias("primeros"))
        return F.struct(
            so_far["vistos"].bitwiseOR(x["dichos"]).alias("vistos"),
            F.array_append(so_far["niveles"], level).alias("niveles"),
        )

    return F.aggregate(F.sort_array(levels), start, add, lambda so_far: so_far["niveles"])


def _numbered(cells: DataFrame) -> DataFrame:
    """Different cells with the word and the bit that stand for them. They are counted by ranges of
    digests, the counts summed up over the ranges (at most 16 to the power of ``RANGE_DIGITS``), and
    only within a range are cells numbered."""
    digest = F.md5(F.to_json(F.struct(*CELL)).cast("binary"))
    rows = cells.withColumn("_range", F.substring(digest, 1, RANGE_DIGITS))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*CELL)) - 1
    rows = rows.withColumn("_place", place).join(offsets, "_range")
    return rows.select(
        *CELL,
        F.expr(f"(_before + _place) div {BITS}").alias("palabra"),
        F.expr(f"shiftleft(1L, CAST((_before + _place) % {BITS} AS INT))").alias("bit"),
    )


def _words(stated: DataFrame, cells: DataFrame) -> DataFrame:
    """(rol, palabra, otorgado, denegado): what a role is granted and denied, as bits."""
    known = cells.select(*[F.col(c).alias(f"_{c}") for c in CELL], "palabra", "bit")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CELL]
    bits = [
        F.bit_or(F.when(F.col(c), F.col("bit")).otherwise(F.lit(0).cast("bigint"))).alias(c)
        for c in ("otorgado", "denegado")
    ]
    return (
        stated.where(F.col("rol").isNotNull())
        .join(known, reduce(Column.__and__, same))
        .groupBy("rol", "palabra")
        .agg(*bits)
    )
