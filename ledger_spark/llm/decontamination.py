"""Benchmark decontamination with DataFrame functions only.

The normalised windows of the benchmark form a hash set. Every document position is looked up by
the hash of its next three words, and a hit is verified on the words of the whole window. The set
is broadcast after its rows and bytes were counted; a larger one is joined by shuffle instead, and
then a position carries the words of one window, not those of its whole document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger_spark.llm.tables import unused

WINDOW = 13
# Words at the start of a window that make its lookup key.
KEY_WORDS = 3
MAX_BROADCAST_BYTES = 64 << 20
# Positions that are looked up from one row: the words of a row are carried beside each of them.
POSITIONS = 256
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, with A-Z in lower case."""
    return F.regexp_extract_all(F.translate(text, UPPER, UPPER.lower()), F.lit(WORD), F.lit(0))


def _key(all_words: Column, at: Column, count: int) -> Column:
    return F.xxhash64(F.lit(count), *[F.get(all_words, at + i) for i in range(count)])


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id") -> DataFrame:
    """Distinct (item_id, k, gram, key_words, key): all windows of k = 13 words of the items; an
    item of fewer words is one window, one without words (NULL too) none."""
    items = benchmark.select(item_id, words(F.coalesce("text", F.lit(""))).alias("w"))
    k = F.least(F.size("w"), F.lit(WINDOW))
    at = F.explode(F.sequence(F.lit(0), F.size("w") - k))
    windows = items.where(F.size("w") > 0).select(item_id, "w", k.alias("k"), at.alias("at"))
    grams = windows.select(
        F.col(item_id).alias("item_id"),
        "k",
        F.array_join(F.slice("w", F.col("at") + 1, F.col("k")), " ").alias("gram"),
    ).distinct()
    count = F.least("k", F.lit(KEY_WORDS))
    first = F.split("gram", " ")
    keys = [F.when(count == c, _key(first, F.lit(0), c)) for c in range(1, KEY_WORDS + 1)]
    return grams.withColumns({"key_words": count, "key": F.coalesce(*keys)})


def _parts(split: DataFrame) -> DataFrame:
    """Documents in parts of ``POSITIONS`` words, each with the words of windows that begin in it.

    ``first`` is the place of a part; a document without words has one empty part. So what is carried
    beside a position has a bound, and a long text takes as long as many short ones.
    """
    begins = F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(POSITIONS))

    def part(first: Column) -> Column:
        return F.struct(
            first.alias("first"), F.slice("w", first + 1, F.lit(POSITIONS + WINDOW - 1)).alias("w")
        )

    kept = ["doc_id", "text_hash", F.size("w").alias("n_words")]
    return split.select(*kept, F.inline(F.transform(begins, part)))


def _lookups(all_words: Column, count: int) -> Column:
    """The key of every position of a part."""

    def entry(at: Column) -> Column:
        return F.struct(at.alias("at"), _key(all_words, at, count).alias("key"))

    last = F.least(F.size(all_words), F.lit(POSITIONS)) - 1
    some = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), entry)
    return F.when(last >= 0, some).otherwise(F.slice(some, F.lit(1), F.lit(0)))


def contamination(
    docs: DataFrame, benchmark: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, spans array<struct<at, k>> (word
    positions of verified windows) and items array<string>.

    A text that is NULL or has no words has no spans; repeated rows each get their row; rows with
    one doc_id but different texts are told apart by the hash of the text. Items and documents may
    be empty. Other columns are left out.
    """
    grams = benchmark_windows(benchmark)
    bounds = grams.agg(
        F.collect_set("key_words"), F.coalesce(F.sum(F.octet_length("gram") + 64), F.lit(0))
    ).first()
    entries = grams.select(F.col("item_id").cast("string").alias("item"), "k", "gram", "key")
    text = F.coalesce("text", F.lit(""))
    split = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), words(text).alias("w"))
    lookups = [_lookups(F.col("w"), count) for count in sorted(bounds[0])]
    start = F.array(F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("key")))
    start = F.when(F.col("first") == 0, start).otherwise(F.slice(start, F.lit(1), F.lit(0)))
    positions = _parts(split).select(
        "doc_id", "text_hash", "n_words", "first", "w", F.inline(reduce(F.concat, lookups, start))
    )
    place = (F.col("first") + F.col("at")).alias("at")
    columns = ["doc_id", "text_hash", "n_words", place, "k", "item"]
    # One more entry that every document meets once: it carries the number of words.
    none = F.lit(None).cast("string")
    marker = grams.sparkSession.range(1).select(
        none.alias("item"),
        F.lit(0).alias("k"),
        F.lit("").alias("gram"),
        F.lit(0).cast("long").alias("key"),
    )
    if bounds[1] <= max_broadcast_bytes:
        window = F.array_join(F.slice("w", F.col("at") + 1, F.col("k")), " ")
        found = (
            positions.join(F.broadcast(entries.unionByName(marker)), "key")
            .where((F.col("k") == 0) | (window == F.col("gram")))
            .select(columns)
        )
    else:
        # The entry of every document would be one hot key of the shuffle: it is added afterwards.
        ahead = F.slice("w", F.col("at") + 1, F.lit(WINDOW))
        positions = positions.where("key <> 0").withColumn("ahead", ahead).drop("w")
        window = F.array_join(F.slice("ahead", F.lit(1), F.col("k")), " ")
        found = positions.join(entries, "key").where(window == F.col("gram")).select(columns)
        each = [F.size("w").alias("n_words"), F.lit(0).alias("at"), F.lit(0).alias("k")]
        found = found.unionByName(
            split.select("doc_id", "text_hash", *each, none.alias("item"))
        )
    hit = F.col("k") > 0
    gathered = found.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count_if(~hit).alias("copies"),
        F.collect_set(F.when(hit, F.struct("at", "k"))).alias("spans"),
        F.collect_set("item").alias("items"),
    )
    return gathered.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop(
        "_copy", "copies"
    )


def hit_words(spans: Column) -> Column:
    """Number of words inside any of the spans."""

    def add(so_far: Column, span: Column) -> Column:
        end = span["at"] + span["k"]
        begin = F.greatest(so_far["end"], span["at"])
        return F.struct(
            F.greatest(so_far["end"], end).alias("end"),
            (so_far["total"] + F.greatest(end - begin, F.lit(0))).alias("total"),
        )

    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(F.array_sort(spans), zero, add, lambda x: x["total"])


def verdicts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contamination`` with n_hit and contaminated: a twentieth of the words or more are hit."""
    return (
        contamination(docs, benchmark)
        .withColumn("n_hit", hit_words(F.col("spans")))
        .withColumn(
            "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    doc_id, text_hash = unused(docs, ["id", "hash"])
    bad = (
        verdicts(docs, benchmark)
        .where("contaminated")
        .select(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash))
        .distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (
        F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(text_hash)
    )
    return docs.join(bad, same, "left_anti")
