"""SimHash fingerprints and their near-duplicate classes by pigeonring filtering.

The 64 bits lie on a ring of five segments. If two fingerprints differ in at most four bits, some
chain of consecutive segments starting at segment i keeps its running number of differences
within the proportional budgets 4/5, 8/5, 12/5, ... bits, that is 0, 1, 2, 3 whole bits. So
segment i is equal and segment i+1 differs in one bit at most: candidates come from equality of
these two segments, one of them with one bit flipped. The chain is then followed to its end, and
only pairs that pass are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_spark.llm.components import components
from ledger_spark.llm.tables import pieces, scratch
from ledger_spark.operators.spread import lookup_join, spread

MAX_BITS = 4
# Segments of the ring as (first bit, width); one more than the bits that may differ.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
# Members of a candidate group that one task compares at a time with as many others.
BLOCK = 2048
# Pairs compared at a time.
PAIRS = 250_000
CHUNK_BYTES = 4_000_000
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
SEPARATORS = bytes([9, 10, 11, 12, 13])


def fingerprint(text: str | None, words: int) -> int:
    """The majority bits of the XXH64 values of the word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    data = (text or "").encode().translate(bytes.maketrans(UPPER + SEPARATORS, LOWER + b" " * 5))
    parts = [w for w in data.split(b" ") if w]
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(w) + 1 for w in parts])
    starts = (ends - [len(w) + 1 for w in parts]).tolist()
    last = (ends - 1).tolist()
    n = max(1, len(parts) - words + 1)
    spans = zip(starts[:n], last[min(words, len(parts)) - 1 :], strict=True)
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):
        bits = np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "little")


def fingerprints(
    df: DataFrame, words: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row (id, fp long) per row of ``df``, the 64 bits as a signed number; no shuffle.

    A text without words (NULL too) has the fingerprint zero. Fewer than ``words`` words make one
    shingle of all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1, CHUNK_BYTES):
            found = [fingerprint(t, words) for t in batch.column(1).to_pylist()]
            values = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["id", "fp"])

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(id_column, text_column).mapInArrow(run, f"id {kind}, fp long")
    return rows.withColumnRenamed("id", id_column)


def _segment(i: int):
    first, width = SEGMENTS[i]
    return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))


def _key(i: int, following):
    """Number of the segment, its value and the value of the next one in one long."""
    return F.lit(i << 26) + F.shiftleft(_segment(i), 13) + following


def _index_keys(distinct: DataFrame) -> DataFrame:
    """Per fingerprint and segment the key of the segment and the next."""
    keys = [_key(i, _segment((i + 1) % len(SEGMENTS))) for i in range(len(SEGMENTS))]
    return distinct.select("fp", F.explode(F.array(*keys)).alias("key"), F.lit(True).alias("own"))


def _probe_keys(distinct: DataFrame) -> DataFrame:
    """The same keys with one bit of the next segment flipped."""
    keys = []
    for i in range(len(SEGMENTS)):
        j = (i + 1) % len(SEGMENTS)
        for bit in range(SEGMENTS[j][1]):
            keys.append(_key(i, _segment(j).bitwiseXOR(F.lit(1 << bit))))
    return distinct.select("fp", F.explode(F.array(*keys)).alias("key"), F.lit(False).alias("own"))


def chain_holds(differing: np.ndarray) -> np.ndarray:
    """Whether some chain around the ring keeps within all its proportional budgets."""
    m = len(SEGMENTS)
    counts = [
        np.bitwise_count((differing >> np.uint64(f)) & np.uint64((1 << w) - 1))
        for f, w in SEGMENTS
    ]
    found = np.zeros(differing.shape, dtype=bool)
    for i in range(m):
        within, total = np.ones(differing.shape, dtype=bool), np.zeros(differing.shape, np.int64)
        for length in range(1, m + 1):
            total = total + counts[(i + length - 1) % m]
            within &= total * m <= length * MAX_BITS
        found |= within
    return found


def forest(left: np.ndarray, right: np.ndarray, nodes: int) -> np.ndarray:
    """Positions of links that join the same nodes as all of them, fewer than there are nodes."""
    label, kept = np.arange(nodes), []
    at = np.arange(len(left))
    while True:
        low, high = label[left[at]], label[right[at]]
        at = at[low != high]
        if not len(at):
            return np.concatenate(kept) if kept else np.empty(0, np.int64)
        high, first = np.unique(np.maximum(label[left[at]], label[right[at]]), return_index=True)
        chosen = at[first]
        kept.append(chosen)
        label[high] = np.minimum(label[left[chosen]], label[right[chosen]])
        while (label[label] != label).any():
            label = label[label]
        label = label[label]


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, enough to connect all that link.

    A group of candidates shares a key. Groups are dealt out as pairs of blocks of about ``BLOCK``
    members, so no task holds more than two blocks, and each pair of blocks returns fewer edges
    than it has members: large groups of near copies do not become all their pairs.
    """
    index = _index_keys(distinct)
    # A fingerprint becomes 64 rows here: deal them out by number first, not by their few bytes.
    # (By a digest: a second exchange by the column they were made distinct by would be left out.)
    dealt_out = spread(distinct.withColumn("_at", F.xxhash64("fp")), "_at")
    probes = lookup_join(_probe_keys(dealt_out), index.select("key").distinct(), "key", "left_semi")
    members = index.unionByName(probes)
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = (
        lookup_join(members, sizes, "key")
        .withColumn("block", F.pmod(F.xxhash64("fp"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "key",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "fp",
            "own",
        )
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _whole_groups(batches, ["key", "low", "high"]):
            yield pd.DataFrame(_group_edges(part), columns=["a", "b"])

    dealt = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInPandas(compare, "a long, b long").distinct()


def _whole_groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """The sorted rows in frames that never cut a group."""
    held = None
    for frame in batches:
        if held is not None:
            frame = pd.concat([held, frame], ignore_index=True)
        last = np.logical_and.reduce([(frame[c] == frame[c].iloc[-1]).to_numpy() for c in by])
        if not last.all():
            yield frame[~last]
        held = frame[last].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _group_edges(frame: pd.DataFrame) -> np.ndarray:
    """Edges of all groups of the frame, fewer than its rows; a link joins a whole-key member and any member of the
    group, of different blocks where the group is a pair of blocks."""
    by = frame[["key", "low", "high"]].to_numpy()
    group = np.cumsum(np.append(False, (by[1:] != by[:-1]).any(axis=1)))
    fp = frame["fp"].to_numpy().view(np.uint64)
    own, block = frame["own"].to_numpy(), frame["block"].to_numpy()
    sizes = np.bincount(group)
    starts = np.cumsum(sizes) - sizes
    left = np.flatnonzero(own)
    partners = sizes[group[left]]
    kept_a, kept_b, done = left[:0], left[:0], 0
    ends = np.cumsum(partners)
    while done < len(left):
        # As many whole-key members at a time as make about PAIRS pairs.
        until = max(done + 1, int(np.searchsorted(ends, ends[done] + PAIRS)))
        mine, counts = left[done:until], partners[done:until]
        done = until
        a = np.repeat(mine, counts)
        b = np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts)
        b += np.repeat(starts[group[mine]], counts)
        split = by[a, 1] != by[a, 2]
        asked = (fp[a] != fp[b]) & (~split | (block[a] != block[b]))
        a, b = a[asked], b[asked]
        differing = fp[a] ^ fp[b]
        passed = chain_holds(differing)
        a, b, differing = a[passed], b[passed], differing[passed]
        near = np.bitwise_count(differing) <= MAX_BITS
        # Links found so far are thinned together with the new ones.
        a, b = np.concatenate([kept_a, a[near]]), np.concatenate([kept_b, b[near]])
        kept = forest(a, b, len(fp))
        kept_a, kept_b = a[kept], b[kept]
    return np.stack([fp[kept_a], fp[kept_b]], axis=1).view(np.int64)


def near_duplicates(
    df: DataFrame, words: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row (id, fp, component) per row of ``df``: the smallest id reachable over links.

    Documents of equal fingerprint are linked without being paired; only distinct fingerprints are
    compared. Repeated rows stay; rows without an id take part, and a component that has no other
    rows has the component NULL. An empty table gives an empty table; other columns are left out.
    """
    docs = scratch(fingerprints(df, words, id_column, text_column), "fingerprints")
    joined = components(links(docs.select("fp").distinct()))
    named = docs.groupBy("fp").agg(F.min(id_column).alias("least"))
    of = named.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    heads = of.groupBy("component").agg(F.min("least").alias("head"))
    of = lookup_join(of, heads, "component").select("fp", F.col("head").alias("component"))
    return lookup_join(docs, of, "fp").select(id_column, "fp", "component")
