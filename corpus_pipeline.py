"""From raw documents to token ids: five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on every row of ``docs`` and returns a DataFrame; all
but the last return the columns of ``docs``. Between stages the rows are written and read again.
NULL and empty texts are rejected by the first stage, as they have no language; an empty table
passes through all stages; further columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger_spark.llm import language_id, secret_scan
from ledger_spark.llm.decontamination import decontaminate
from ledger_spark.llm.sentencepiece_codec import encode_decode
from ledger_spark.llm.simhash import near_duplicates
from ledger_spark.llm.tables import scratch, table, unused

# Below this probability a document is of no language that the model knows.
MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language; a missing ``lang`` is filled in."""
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))))
    aside = _aside(docs)
    named = language_id.predict(docs.withColumnsRenamed(aside), model)
    kept = named.where(
        (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    )
    kept = kept.withColumn("lang", F.coalesce("lang", "lang_pred")).drop("lang_pred", "score")
    return kept.withColumnsRenamed({new: old for old, new in aside.items()})


def _aside(docs: DataFrame) -> dict[str, str]:
    """Other names for the columns of ``docs`` whose names, in any case, the stages give to their own."""
    clash = [c for c in docs.columns if c.lower() in ("lang_pred", "score", "secret_spans")]
    return dict(zip(clash, unused(docs, clash), strict=True))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: that of the smallest doc_id, rows without one last, and of
    those the smallest digest of the text. Rows that share a doc_id are told apart by the digest."""
    key, head = unused(docs, ["row", "head"])
    row = F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", F.unhex(F.md5("text")).alias("digest")
    )
    named = docs.withColumn(key, row)
    groups = near_duplicates(named.select(key, "text"), id_column=key)
    heads = groups.where(F.col(key).eqNullSafe(F.col("component")))
    # Equal rows have one key: each map task keeps one of them before the exchange.
    single = named.dropDuplicates([key])
    heads = heads.select(F.col(key).alias(head)).distinct()
    return single.join(heads, F.col(key) == F.col(head), "left_semi").select(docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` follows the text."""
    aside = _aside(docs)
    [clean] = unused(docs, ["clean"])
    kept = docs.withColumnsRenamed(aside)
    found = secret_scan.scan(kept, secret_scan.train(docs), clean=clean)
    redacted = found.withColumn("text", F.coalesce(clean, "text")).drop("secret_spans", clean)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        redacted = redacted.withColumn("n_chars", length)
    return redacted.withColumnsRenamed({new: old for old, new in aside.items()})


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the decoded text of every document."""
    coded = encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_free),
    ("secret_scan", without_secrets),
    ("sentencepiece", token_ids),
]

# Learned models and fingerprints have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
