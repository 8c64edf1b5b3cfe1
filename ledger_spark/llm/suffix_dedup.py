"""Removal of repeated strings by content hashes of runs around min-hash anchors.

Two suffixes share a bucket if they agree in their first bytes. The start buckets are q-grams of 32
bytes; their identifiers are hashes of bytes, computed as differences of running sums. This is not
the refinement of bucket refinement: buckets are not sorted by the identifiers of buckets at later
offsets, nor are updates used again by recursion, which needs a row for every suffix in every round.
Content hashes of ever smaller runs split the buckets instead, as the next paragraph says.

Not every suffix is sent around. Each string of 100 bytes has an anchor, the q-gram of smallest hash
inside it (the leftmost of equals): equal strings have equal anchors at equal places. So one row
per anchor, about one in 32 positions, stands for the run of strings it is the anchor of, and
buckets of one anchor end there. A bucket is then split into classes of anchors whose whole runs
agree: all but the first member of a class are repeats as a whole. Only where a bucket has several
classes, their first members are refined: the run is cut into smaller runs of starts (69, 17, 4, 1),
the hash of whose common bytes, brought back from the documents, is the next identifier, and again
whole classes are settled, buckets of one class end, and the rest goes on. At the last level a run
is one string.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger_spark.llm.tables import pieces, scratch, scratch_at
from ledger_spark.operators.spread import lookup_join
from ledger_spark.session import discard

LENGTH = 100
GRAM = 32
STARTS = LENGTH - GRAM + 1
# Starts that one refined run covers, level by level.
WIDTHS = (17, 4, 1)

BUFFER = 1 << 18
PIECE = 1 << 20
CHUNK_BYTES = 4_000_000

MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = 0xD1342543DE82EF95


class RunningHash:
    """Identifiers of byte strings by differences of running sums, modulo 2**64."""

    def __init__(self, size: int):
        random = np.random.default_rng(20)
        self.value = random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.power = np.cumprod(np.full(size, BASE, dtype=np.uint64))
        inverse = pow(BASE, -1, 1 << 64)
        self.inverse = np.cumprod(np.full(size, inverse, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.value[data] * self.power[: len(data)], out=out[1:])
        return out

    def ids(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.inverse[start])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= MIX
    x ^= x >> np.uint64(29)
    return x


def anchors(data: np.ndarray, lengths: np.ndarray, hashes: RunningHash):
    """For documents one after another: per anchor run (document, anchor, first and last start in
    the buffer, identifier of the q-gram, identifier of all bytes of the run)."""
    sums = hashes.sums(data)
    n = len(data) - GRAM + 1
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * hashes.inverse[:n])
    key = ((grams >> np.uint64(24)) << np.uint64(24)) | np.arange(n, dtype=np.uint64)
    width, least = 1, key
    while 2 * width <= STARTS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if (rest := STARTS - width) > 0:
        least = np.minimum(least[: len(least) - rest], least[rest:])
    begins = np.cumsum(lengths) - lengths
    strings = np.maximum(lengths - LENGTH + 1, 0)
    document = np.repeat(np.arange(len(lengths)), strings)
    start = np.arange(len(document)) + np.repeat(begins - (np.cumsum(strings) - strings), strings)
    anchor = (least[start] & np.uint64((1 << 24) - 1)).astype(np.int64)
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    document, anchor, low, high = document[first], anchor[first], start[first], start[last]
    run = hashes.ids(sums, low, high + LENGTH)
    shape = ((anchor - low) * LENGTH + (high - low)).astype(np.uint64)
    return document, anchor, low, high, grams[anchor], mixed(run + shape * MIX)


def _anchor_rows(rows: DataFrame, all_columns: bool) -> DataFrame:
    """(h) or (h, f, doc, sub, pack) of every anchor. pack holds, from the top, the start of the run,
    the anchor's distance from it, and the number of starts less one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = RunningHash(PIECE + BUFFER + 2 * LENGTH)
        for batch in pieces(batches, 0, CHUNK_BYTES):
            texts = [t.encode() for t in batch.column(0).to_pylist()]
            docs = batch.column(1).to_numpy(zero_copy_only=False)
            subs = batch.column(2).to_numpy(zero_copy_only=False)
            # Strings to look at: (row, offset in the text, bytes); long texts in pieces that
            # overlap by one byte less than a string.
            parts = [
                (i, at, t[at : at + PIECE + LENGTH - 1])
                for i, t in enumerate(texts)
                for at in range(0, max(0, len(t) - LENGTH + 1), PIECE)
            ]
            out, held, size = [], [], 0
            for part in parts:
                held.append(part)
                size += len(part[2])
                if size >= BUFFER:
                    out.append(packed(held, docs, subs, hashes))
                    held, size = [], 0
            if held:
                out.append(packed(held, docs, subs, hashes))
            if out:
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                names = ["h", "f", "doc", "sub", "pack"]
                used = len(names) if all_columns else 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns[:used]], names[:used]
                )

    def packed(held, docs, subs, hashes):
        data = np.frombuffer(b"".join(p[2] for p in held), dtype=np.uint8)
        lengths = np.array([len(p[2]) for p in held])
        begins = np.cumsum(lengths) - lengths
        part, anchor, low, high, gram, whole = anchors(data, lengths, hashes)
        row = np.array([p[0] for p in held])[part]
        offset = np.array([p[1] for p in held])[part] - begins[part]
        pack = ((low + offset) << 32) | ((anchor - low) << 8) | (high - low)
        return gram.view(np.int64), whole.view(np.int64), docs[row], subs[row], pack

    schema = "h long, f long, doc long, sub long, pack long" if all_columns else "h long"
    return rows.select("text", "doc", "sub").mapInArrow(run, schema)


def _start(pack: Column) -> Column:
    return F.shiftright(pack, 32)


def _distance(pack: Column) -> Column:
    return F.shiftright(pack, 8).bitwiseAND(F.lit(127))


def _more(pack: Column) -> Column:
    """Number of starts less one."""
    return pack.bitwiseAND(F.lit(127))


def _pack(start: Column, distance: Column, more: Column) -> Column:
    high = F.shiftleft(start.cast("long"), 32) + F.shiftleft(distance.cast("long"), 8)
    return high + more.cast("long")


def _settled(members: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Of members (h bucket, f class, doc, sub, pack): those that repeat an earlier one as a whole, and
    the first members of classes in buckets of more than one class. Both read the files of the classes,
    whose path comes last."""
    first = members.groupBy("h", "f").agg(F.min(F.struct("doc", "sub", "pack")).alias("first"))
    first, path = scratch_at(first, "classes")
    repeats = members.withColumn("class", F.xxhash64("h", "f"))
    of_class = first.select(
        F.xxhash64("h", "f").alias("class"),
        F.col("h").alias("_h"),
        F.col("f").alias("_f"),
        F.col("first.doc").alias("_doc"),
        F.col("first.sub").alias("_sub"),
        F.col("first.pack").alias("_pack"),
    )
    repeats = (
        repeats.join(of_class, "class")
        .where("h = _h AND f = _f AND (doc <> _doc OR sub <> _sub OR pack <> _pack)")
        .select("doc", "sub", "pack")
    )
    several = first.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    open_ = lookup_join(first, several, "h", "left_semi").select("h", "f", "first.*")
    return repeats, open_, path


def _with_bytes(open_: DataFrame, rows: DataFrame) -> DataFrame:
    """The members with the bytes of their runs; a document's members are bounded by its length."""
    grouped = open_.groupBy("doc", "sub").agg(F.collect_list(F.struct("h", "pack")).alias("members"))
    joined = rows.select("doc", "sub", F.col("text").cast("binary").alias("bytes")).join(
        grouped, ["doc", "sub"]
    )
    one = F.col("member.pack")
    cut = F.substring("bytes", _start(one).cast("int") + 1, (_more(one) + LENGTH).cast("int"))
    return joined.select("doc", "sub", "bytes", F.explode("members").alias("member")).select(
        F.col("member.h").alias("h"), "doc", "sub", one.alias("pack"), cut.alias("bytes")
    )


def _refined(members: DataFrame, width: int) -> DataFrame:
    """The runs (h, doc, sub, pack, bytes) cut at multiples of ``width`` of the distance between anchor
    and start, with new bucket and class identifiers."""
    pack = F.col("pack")
    far, near = _distance(pack), _distance(pack) - _more(pack)
    cuts = F.sequence(F.floor(near / width), F.floor(far / width))
    run = members.withColumn("cut", F.explode(cuts)).withColumns(
        {
            "far": F.least(far, (F.col("cut") + 1) * width - 1).cast("int"),
            "near": F.greatest(near, F.col("cut") * width).cast("int"),
            "skip": far.cast("int"),
        }
    )
    run = run.withColumn("skip", F.col("skip") - F.col("far"))
    own = F.substring("bytes", F.col("skip") + 1, F.col("far") - F.col("near") + LENGTH)
    run = run.select(
        "h",
        "doc",
        "sub",
        _pack(_start(pack) + F.col("skip"), F.col("far"), F.col("far") - F.col("near")).alias("pack"),
        own.alias("bytes"),
        "cut",
        "far",
        "near",
    )
    # Bytes that every start of the full cut has: from its last start to the end of its first string.
    last_start = F.col("far") - F.col("cut") * width
    common = F.substring(
        "bytes", last_start.cast("int") + 1, F.lit(LENGTH - width + 1)
    )
    return run.select(
        F.xxhash64("h", "cut", common).alias("h"),
        F.xxhash64("far", "near", "bytes", "h").alias("f"),
        "doc",
        "sub",
        "pack",
        "bytes",
    )


def repeated_runs(rows: DataFrame) -> DataFrame:
    """(doc, sub, start, end) of byte runs that are covered by strings that also start earlier."""
    several = _anchor_rows(rows, False).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    # With a second key both sides come straight out of an exchange, so adaptive execution can split
    # the anchors of a very common q-gram over many tasks.
    parity = F.col("h").bitwiseAND(F.lit(1)).alias("parity")
    several = several.where("n > 1").select("h", parity).hint("shuffle_hash")
    anchored = _anchor_rows(rows, True).select("*", parity)
    members = anchored.join(several, ["h", "parity"], "left_semi").drop("parity")
    members, anchors_path = scratch_at(members, "anchors")
    found, open_, classes = _settled(members)
    parts = [scratch(found, "repeats")]
    discard(rows.sparkSession, anchors_path)
    members = _with_bytes(open_, rows)
    # A level's files go as soon as the next one's are written.
    read = [classes]
    for width in WIDTHS:
        refined, runs = scratch_at(_refined(members, width), "runs")
        for path in read:
            discard(rows.sparkSession, path)
        found, open_, classes = _settled(refined.drop("bytes"))
        parts.append(scratch(found, "repeats"))
        read = [runs, classes]
        if width > 1:
            members = refined.join(open_, ["h", "f", "doc", "sub", "pack"], "left_semi").drop("f")
    for path in read:
        discard(rows.sparkSession, path)
    packs = reduce(DataFrame.unionByName, parts)
    pack = F.col("pack")
    return packs.select(
        "doc",
        "sub",
        _start(pack).cast("int").alias("start"),
        (_start(pack) + _more(pack) + LENGTH).cast("int").alias("end"),
    )


def _documents(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, doc, sub, text): rows are told apart by doc and sub, which also order them.

    ``sub`` is the hash of the text where the id is missing or stands at different texts, else 0, so
    that it takes no room where ids are keys.
    """
    text, doc = F.coalesce(text_column, F.lit("")), F.col(id_column).cast("long")
    hashed = df.select(doc.alias("doc"), F.xxhash64(text).alias("hash")).where("doc IS NOT NULL")
    several = hashed.groupBy("doc").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
    several = scratch(several.where("low <> high").select("doc"), "shared-ids")
    rows = df.select(F.col(id_column).alias("id"), doc.alias("doc"), text.alias("text"))
    if several.isEmpty():
        alone = F.col("doc").isNotNull()
    else:
        rows = lookup_join(rows, several.withColumn("many", F.lit(True)), "doc", "left")
        alone = F.col("doc").isNotNull() & F.col("many").isNull()
    return rows.select(
        "id",
        F.coalesce("doc", F.lit((1 << 63) - 1)).alias("doc"),
        F.when(alone, F.lit(0)).otherwise(F.xxhash64("text")).alias("sub"),
        "text",
    )


def remove_repeats(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row (id, n_bytes, spans array<struct<start, end>>, kept binary) per row of ``df``.

    A byte goes if a string of 100 bytes covers it that also starts earlier: in a row of smaller id,
    or in the same row at an earlier start. Spans are the maximal removed runs, in bytes. NULL
    counts as empty; texts below 100 bytes stay whole. Rows without an id come after all others.
    Rows that share an id, or have none, are documents of their own in the order of a 64-bit hash of
    their texts; equal rows have equal results. Ids are whole numbers. An empty table gives an empty
    table; other columns are left out.
    """
    rows = _documents(df, id_column, text_column)
    # Equal rows find the same runs: as a set they are combined in the map tasks.
    runs = repeated_runs(rows).groupBy("doc", "sub").agg(
        F.collect_set(F.struct("start", "end")).alias("runs")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, CHUNK_BYTES):
            sizes, spans, kept = [], [], []
            for value, found in zip(
                batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
            ):
                data = value.encode()
                sizes.append(len(data))
                if not found:
                    spans.append([])
                    kept.append(data)
                    continue
                change = np.zeros(len(data) + 1, dtype=np.int32)
                np.add.at(change, [r["start"] for r in found], 1)
                np.add.at(change, [r["end"] for r in found], -1)
                gone = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                spans.append(
                    [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                )
                kept.append(np.frombuffer(data, dtype=np.uint8)[~gone].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(spans, kind),
                    pa.array(kept, pa.binary()),
                ],
                ["id", "n_bytes", "spans", "kept"],
            )

    kind = df.schema[id_column].dataType.simpleString()
    joined = rows.join(runs, ["doc", "sub"], "left").select("id", "text", "runs")
    schema = f"id {kind}, n_bytes long, spans array<struct<start: int, end: int>>, kept binary"
    return joined.mapInArrow(cut, schema).withColumnRenamed("id", id_column)
