"""People registered twice under another spelling: reported, never merged (N08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_spark.operators.linkage import groups, one_edit_apart, plain_name
from ledger_spark.operators.spread import lookup_join

# Names of neighbouring documents may differ by so many edits.
NAME_EDITS = 2


def similar_people(people: DataFrame) -> DataFrame:
    """Pairs (id_a, id_b), id_a < id_b, of people who may be one person, and why:

    - ``por_documento``: documents one edit apart and names at most two;
    - ``por_contacto``: the same e-mail and the same name, or names one edit apart.

    People of one e-mail and name are linked to the one of least id among them, who alone is compared
    with other names: a shared address of very many people gives one pair each. Names are compared in
    lower case without accents; a missing name, document or e-mail links nobody.
    """
    known = people.select(
        "id_persona",
        F.nullif("dni", F.lit("")).alias("dni"),
        plain_name(F.col("nombre"), F.col("apellido")).alias("nombre"),
        F.nullif(F.lower(F.trim("email")), F.lit("")).alias("email"),
    ).where("id_persona IS NOT NULL AND nombre IS NOT NULL")

    def side(suffix: str, key: str, columns: list[str]) -> DataFrame:
        renamed = {c: f"{c}_{suffix}" for c in columns}
        return known.select(key, *columns).distinct().withColumnsRenamed(renamed)

    own = ["id_persona", "nombre"]
    by_document = (
        one_edit_apart(known, "dni")
        .join(side("a", "dni", own).withColumnRenamed("dni", "a"), "a")
        .join(side("b", "dni", own).withColumnRenamed("dni", "b"), "b")
        .where(F.levenshtein("nombre_a", "nombre_b", NAME_EDITS) >= 0)
        .select("id_persona_a", "id_persona_b", F.lit(True).alias("doc"), F.lit(False).alias("con"))
    )
    reached = known.where("email IS NOT NULL").select("email", "nombre", "id_persona")
    heads = reached.groupBy("email", "nombre").agg(F.min("id_persona").alias("cabeza"))
    # The least id is a minimum over a window without order: combined before the exchange by the
    # aggregate, and joined back by a digest of both columns.
    digest = F.xxhash64("email", "nombre").alias("_d")
    members = reached.select(digest, "email", "nombre", "id_persona").join(
        heads.select(digest, F.col("email").alias("_e"), F.col("nombre").alias("_n"), "cabeza"), "_d"
    )
    members = members.where("email = _e AND nombre = _n AND id_persona <> cabeza")
    # Only an e-mail of several names links any; the others need no keys.
    several = heads.groupBy("email").agg(F.count(F.lit(1)).alias("_nombres")).where("_nombres > 1")
    heads = lookup_join(heads, several.select("email"), "email")
    respelled = (
        one_edit_apart(heads, "nombre", ["email"])
        .join(heads.select("email", F.col("nombre").alias("a"), F.col("cabeza").alias("_a")), ["email", "a"])
        .join(heads.select("email", F.col("nombre").alias("b"), F.col("cabeza").alias("_b")), ["email", "b"])
    )
    by_contact = members.select(F.col("cabeza").alias("id_persona_a"), F.col("id_persona").alias("id_persona_b"))
    by_contact = by_contact.union(respelled.select("_a", "_b")).select(
        "*", F.lit(False).alias("doc"), F.lit(True).alias("con")
    )
    return (
        by_document.union(by_contact)
        .where("id_persona_a <> id_persona_b")
        .groupBy(
            F.least("id_persona_a", "id_persona_b").alias("id_a"),
            F.greatest("id_persona_a", "id_persona_b").alias("id_b"),
        )
        .agg(F.max("doc").alias("por_documento"), F.max("con").alias("por_contacto"))
    )


def people_groups(people: DataFrame) -> DataFrame:
    """(id_persona, grupo, enlaces) of everyone whom ``similar_people`` links to another, the group named
    by its least id."""
    pairs = similar_people(people).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    return groups(pairs).withColumnRenamed("nodo", "id_persona")
