"""Texts full of matches, equal rows in numbers, rows without ids, and names that clash."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledger_spark.llm import secret_scan
from ledger_spark.llm.decontamination import decontaminate, verdicts
from ledger_spark.llm.pii import count_of, personal_data
from ledger_spark.llm.suffix_dedup import remove_repeats
from tests.llm import brute
from tests.llm.test_operators import ITEM, prose


def seconds(run):
    start = time.perf_counter()
    out = run()
    return time.perf_counter() - start, out


def text_of(spark, text):
    return spark.createDataFrame([(1, text)], "doc_id long, text string")


def doubling(run, small, large):
    """Four times the text within well under sixteen times the time; the first call warms up."""
    run(small)
    first, _ = seconds(lambda: run(small))
    second, out = seconds(lambda: run(large))
    assert second < 9 * first + 2
    return out


def test_personal_data_in_a_text_full_of_it(spark):
    def run(n):
        found = personal_data(text_of(spark, "jo.do@example.org 10.2.3.4 +441234567890, " * n))
        return found.select(*[count_of(F.col("pii_spans"), k) for k in ("email", "ip", "phone")]).first()

    assert tuple(doubling(run, 6_000, 24_000)) == (24_000,) * 3


def test_context_near_a_match(spark):
    rows = [(1, "my mail is a@b.cc"), (2, "it is a@b.cc"), (3, "a@b.cc" + " " * 50 + "mail"), (4, "a@b.cc, write")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.pii_spans[0].score for r in personal_data(docs).collect()}
    assert found[1] == found[4] == 1.0 and found[2] == found[3] == 0.9


def test_redaction_of_a_text_full_of_secrets(spark):
    def run(n):
        docs = text_of(spark, "token=abcdef123456789 é " * n)
        found = secret_scan.scan(docs, secret_scan.train(docs))
        return found.select(secret_scan.redact(F.col("text"), F.col("secret_spans"))).first()[0]

    assert doubling(run, 10_000, 40_000) == "<SECRET> é " * 40_000


def test_decontamination_of_a_long_text(spark):
    items = spark.createDataFrame([(1, ITEM), (2, "dead beef")], "item_id long, text string")
    words = prose(1000)

    def run(n):
        return verdicts(text_of(spark, (words + ITEM) * n), items).first()

    row = doubling(run, 40, 160)
    want = brute.contamination([(words + ITEM) * 160], [(1, ITEM), (2, "dead beef")])[0]
    assert (row.n_words, row.n_hit, len(row["items"])) == want[:3]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_windows_over_the_edges_of_parts(spark, limit):
    from ledger_spark.llm.decontamination import contamination

    items = [(1, ITEM), (2, "one"), (3, "dead beef")]
    texts = [f"{prose(n)} {ITEM}" for n in range(225, 262, 3)] + ["x " * 255 + "one", "x " * 256 + "one", "one"]
    texts += ["x " * 255 + "dead beef " + "x " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(docs, asked, max_broadcast_bytes=limit).collect()
    want = brute.contamination(texts, items)
    for row in found:
        hit = {at for s in row.spans for at in range(s.at, s.at + s.k)}
        assert (row.n_words, len(hit), sorted(row["items"])) == (
            want[row.doc_id][0],
            want[row.doc_id][1],
            sorted({str(i) for i, t in items if brute.contamination([texts[row.doc_id]], [(i, t)])[0][1]}),
        )


def same_low_bits(spark, bits=18):
    """Two texts whose 64-bit hashes end in the same bits."""
    hashed = spark.range(3000).select(
        F.concat(F.repeat(F.concat(F.lit("a text of its own, number "), F.col("id")), 12)).alias("text")
    )
    hashed = hashed.withColumn("low", F.xxhash64("text").bitwiseAND(F.lit((1 << bits) - 1)))
    pairs = hashed.groupBy("low").agg(F.sort_array(F.collect_list("text")).alias("t"))
    return pairs.where("size(t) > 1").orderBy("low").first().t[:2]


@pytest.mark.parametrize("ids", [(None, None), (7, 7)])
def test_rows_told_apart_by_their_whole_hash(spark, ids):
    a, b = same_low_bits(spark)
    apart = prose(80)
    rows = [(ids[0], a), (ids[1], b), (ids[1], apart)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    ranked = sorted((r[1] for r in rows), key=order.get)
    want = {brute.sha(t): x for t, x in zip(ranked, brute.repeats(ranked), strict=True)}
    got = remove_repeats(docs).collect()
    found = sorted((r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), brute.sha(bytes(r.kept))) for r in got)
    assert found == sorted(want.values())


def test_many_equal_rows_of_one_id(spark):
    text = prose(40) * 2
    one = brute.repeats([text])[0]

    def run(n):
        rows = spark.range(n).select(F.lit(5).cast("long").alias("doc_id"), F.lit(text).alias("text"))
        return remove_repeats(rows).select(F.octet_length("kept").alias("n")).groupBy("n").count().collect()

    assert [tuple(r) for r in doubling(run, 2_500, 10_000)] == [(one[0] - one[1], 10_000)]


CLASH = ["_id", "_hash", "_row", "_rank", "Score", "Lang_Pred", "SECRET_SPANS", "__id", "first", "at"]


def test_columns_of_any_name_go_through_the_stages(spark, tmp_path):
    rows = [(i, prose(60), "xx", i) for i in range(30)] + [(40, prose(4) + ITEM, "xx", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars int")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in CLASH})
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == 30
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        for row in out.collect():
            assert all(row[c] == f"{c}{row.doc_id}" for c in CLASH)
