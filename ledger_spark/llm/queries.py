"""The operators as queries over the test tables, in the form that their contracts fix."""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger_spark.llm import language_id, recurrent_lm, secret_scan
from ledger_spark.llm.chat_rotation import rotate
from ledger_spark.llm.decontamination import verdicts
from ledger_spark.llm.lexical_search import search as lexical_search
from ledger_spark.llm.pii import BASE, count_of, listed, personal_data
from ledger_spark.llm.sentencepiece_codec import encode_decode
from ledger_spark.llm.simhash import near_duplicates
from ledger_spark.llm.suffix_dedup import remove_repeats
from ledger_spark.llm.tables import table
from ledger_spark.llm.threshold_search import integer_vector, search, usable
from ledger_spark.llm.token_counts import count_tokens
from ledger_spark.llm.vector_codes import compress, whole_numbers


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = encode_decode(table(spark, sf_dir, "documents"), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("word_bpe_49k.json")
    counted = count_tokens(table(spark, sf_dir, "documents"), model)
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op3_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data(docs).select("doc_id", "pii_spans")
    counts = [count_of(F.col("pii_spans"), kind).alias(f"n_{kind}") for kind in BASE]
    base = F.filter("pii_spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("pii_spans")).alias("spans"),
    )


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = (
        table(spark, sf_dir, "embeddings")
        .where(usable(F.col("embedding")))
        .select("vec_id", integer_vector(F.col("embedding")).alias("v"))
    )
    return search(vectors, F.col("vec_id") % 20 == 0)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    spans = F.col("secret_spans")
    counts = [count_of(spans, kind).alias(f"n_{kind}") for kind in secret_scan.BASE]
    base = F.filter(spans, lambda s: s["kind"].isin(*secret_scan.BASE))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = verdicts(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = language_id.held_out(F.col("doc_id"))
    model = language_id.train(docs.where(~kept))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", kept.alias("held_out"), "lang_pred", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = (
        table(spark, sf_dir, "embeddings")
        .where(usable(F.col("embedding")))
        .select("vec_id", "label", whole_numbers(F.col("embedding")).alias("v"))
    )
    coded, books = compress(vectors)
    numbers = ",".join(map(str, books.reshape(-1).tolist()))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c.cast("bigint"))), 2, "0"))
    return coded.select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def op13_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = recurrent_lm.held_out(F.col("doc_id"))
    model = recurrent_lm.fit(docs.where(~kept).select("text"))
    return recurrent_lm.score(docs.withColumn("held_out", kept), model)


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_token_counts": op2_token_counts,
    "op3_chat_rotation": op3_chat_rotation,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_pii": op5_pii,
    "op6_topk": op6_topk,
    "op7_secrets": op7_secrets,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_simhash": op10_simhash,
    "op11_lexical_search": op11_lexical_search,
    "op12_vector_codes": op12_vector_codes,
    "op13_recurrent_lm": op13_recurrent_lm,
}
