"""The pipeline against plain Python over the same stages."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from ledger_spark.llm import language_id
from tests.llm import brute
from tests.llm.test_operators import ITEM, prose, tables


def test_pipeline(spark, tmp_path):
    from sentencepiece import SentencePieceProcessor

    texts = [prose(80) for _ in range(40)]
    rows = [(i, t, "xx", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(50 + i, texts[i], "xx", "s", 1) for i in range(5)]  # copies
    rows += [(60, prose(10) + ITEM, "xx", "s", 1), (61, None, "xx", "s", 0), (62, "12 34", None, "s", 5)]
    rows += [(63, prose(60) + " password: abcdefgh12345678", None, "s", 1)]
    sf = tables(spark, tmp_path, rows)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    heads = brute.components([r[0] for r in kept], [brute.fingerprint(r[1]) for r in kept])
    kept = [r for r, head in zip(kept, heads, strict=True) if r[0] == head]
    bad = brute.contamination([r[1] for r in kept], [(1, ITEM), (4, " ".join(ITEM.split()[10:25])), (5, "dead beef")])
    kept = [r for r, b in zip(kept, bad, strict=True) if not b[-1]]
    assert sorted(got) == [r[0] for r in kept] and 63 in got and 60 not in got
    for doc, text, *_ in kept:
        for start, _, _, end in reversed(brute.secrets(text)):
            text = text[:start] + "<SECRET>" + text[end:]
        assert got[doc].ids == library.encode(text)
        assert got[doc].decoded_sha256 == brute.sha(text)


def test_stages_keep_columns_and_empty_tables(spark, tmp_path):
    sf = tables(spark, tmp_path, [])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert sorted(out.columns) == sorted(docs.columns)
        assert out.count() == 0
    assert corpus_pipeline.run(spark, sf).count() == 0
    assert language_id.held_out(F.col("doc_id")) is not None


def test_one_row_of_each_group_where_ids_repeat_or_are_missing(spark):
    a, b, c, d, e, f = (prose(80) for _ in range(6))
    rows = [(1, a), (1, b), (1, b), (2, c), (2, a), (3, a), (None, d), (None, d), (None, c), (None, e)]
    rows += [(5, f), (4, f), (None, f), (4, f), (6, None), (None, None)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n int")
    out = corpus_pipeline.near_dedup(spark, docs.repartition(4), "")
    assert out.columns == ["doc_id", "text", "n"]
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(1, a), (1, b), (2, c), (4, f), (6, None), (None, d), (None, e)], key=repr)
