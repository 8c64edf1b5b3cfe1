"""Ranked lexical search: short lists summed term by term, long ones skipped document by document.

Every task holds shards of documents of bounded size as lists of one term each (documents ascending,
with what the term adds to each). For a query, its short lists are added up first into one list of
documents with their sums. From then on that list is one more iterator, with the greatest of its
sums as bound, beside the long lists: windows of documents are passed in order, those whose bounds
cannot reach the k-th score are skipped, lists that cannot bring a document in by themselves are only
looked up for the documents the other lists bring, and a document is given up as soon as what is left
cannot lift it. The k-th scores found so far go from shard to shard of a task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from ledger_spark.llm.tables import pieces, scratch, share, shared

TEXT_BYTES = 4_000_000
# Bytes of query texts that are held and broadcast at once; more queries are more blocks.
QUERY_BYTES = 8_000_000
POSTINGS_PER_SHARD = 1_000_000
DOCS_PER_WINDOW = 1024
# A list is short if it has at most one in so many documents of its shard.
SHORT_SHARE = 32

# Fixed by the contract: what is no part of a term becomes a blank, capitals become small.
_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else (c if c in _KEEP else 0x20) for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII; A-Z in lower case."""
    return (text or b"").translate(_FOLD).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Shard:
    """Lists of one term each over some documents, which are numbered by ascending id."""

    def __init__(self, terms, docs, scores, documents: int, vocabulary: int):
        order = np.lexsort((docs, terms))
        self.docs, self.scores = docs[order], scores[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=vocabulary))])
        self.documents = documents

    def list_of(self, term: int, times: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[term], self.starts[term + 1])
        return self.docs[at], self.scores[at] * times


def _added_up(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The accumulators of some lists as one list: each document once, with its sum."""
    docs = np.concatenate([d for d, _ in lists])
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], np.concatenate([s for _, s in lists])[order]
    first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
    return docs[first], np.add.reduceat(scores, first)


class Best:
    """The k best documents of one query so far; equal scores by key."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.empty(0, np.int64)
        self.keys = np.empty((0, 2), np.int64)  # 1 for a missing id, the id

    @property
    def least(self) -> int:
        """What a document must reach at least: the k-th score, or 1."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        keys = np.concatenate([self.keys, keys])
        order = np.lexsort((keys[:, 1], keys[:, 0], -scores))[: self.k]
        self.scores, self.keys = scores[order], keys[order]


def search_shard(shard: Shard, query: list[tuple[int, int]], keys: np.ndarray, best: Best) -> None:
    """Bring the documents of a shard into the best of a query of (term, times)."""
    lists = [shard.list_of(term, times) for term, times in query]
    lists = [x for x in lists if len(x[0])]
    short = [x for x in lists if len(x[0]) * SHORT_SHARE <= shard.documents]
    iterators = [x for x in lists if len(x[0]) * SHORT_SHARE > shard.documents]
    if short:
        iterators.append(_added_up(short))
    if not iterators:
        return
    iterators.sort(key=lambda x: int(x[1].max()))
    bounds = np.cumsum([int(s.max()) for _, s in iterators])  # of each list and all before it
    edges = np.arange(0, shard.documents + DOCS_PER_WINDOW, DOCS_PER_WINDOW)
    places = [np.searchsorted(docs, edges) for docs, _ in iterators]
    highest = np.zeros(len(edges) - 1, dtype=np.int64)
    for (_, scores), place in zip(iterators, places, strict=True):
        full = np.flatnonzero(place[1:] > place[:-1])
        highest[full] += np.maximum.reduceat(scores, place[full])
    for w, low in enumerate(edges[:-1]):
        least = best.least
        if highest[w] < least:
            continue
        # Lists before ``lead`` cannot reach the k-th score even together.
        lead = int(np.searchsorted(bounds, least))
        sums = np.zeros(DOCS_PER_WINDOW, dtype=np.int64)
        for (docs, scores), place in zip(iterators[lead:], places[lead:], strict=True):
            at = slice(place[w], place[w + 1])
            sums[docs[at] - low] += scores[at]
        found = np.flatnonzero(sums)
        for i in range(lead - 1, -1, -1):
            found = found[sums[found] + bounds[i] >= least]
            (docs, scores), place = iterators[i], places[i]
            held = docs[place[w] : place[w + 1]] - low
            if len(found) and len(held):
                at = np.minimum(np.searchsorted(held, found), len(held) - 1)
                met = held[at] == found
                sums[found[met]] += scores[place[w] + at[met]]
        found = found[sums[found] >= least]
        if len(found):
            best.add(sums[found], keys[low + found])


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every row with a term: all its terms counted, those of the
    vocabulary listed."""
    words_of_task = share(docs.sparkSession, vocabulary)
    schema = StructType.fromDDL("doc_id long, n long, terms array<int>, tfs array<long>")
    names, kinds = schema.fieldNames(), to_arrow_schema(schema).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared(words_of_task)
        for batch in pieces(batches, 1, TEXT_BYTES):
            made: tuple[list, ...] = ([], [], [], [])
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                terms = terms_of(text)
                if not terms:
                    continue
                known = [(number[t], tf) for t, tf in Counter(terms).items() if t in number]
                row = (doc_id, len(terms), [t for t, _ in known], [tf for _, tf in known])
                for column, value in zip(made, row, strict=True):
                    column.append(value)
            arrays = [pa.array(v, kind) for v, kind in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.mapInArrow(run, schema)


def _shards(
    batches: Iterator[pa.RecordBatch], weights: np.ndarray, documents: int, length: int
) -> Iterator[tuple[Shard, np.ndarray]]:
    """The rows of a task as shards, each with the keys of its documents."""
    held: list[pa.RecordBatch] = []
    size = 0

    def made() -> tuple[Shard, np.ndarray]:
        rows = pa.Table.from_batches(held)
        missing = rows["doc_id"].is_null().to_numpy().astype(np.int64)
        keys = np.stack([missing, rows["doc_id"].fill_null(0).to_numpy()], axis=1)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        counts = pa.compute.list_value_length(rows["terms"]).to_numpy()
        terms = pa.compute.list_flatten(rows["terms"]).to_numpy()
        tf = pa.compute.list_flatten(rows["tfs"]).to_numpy()
        m = 100 - 75 + (75 * rows["n"].to_numpy() * documents) // length
        scores = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, counts)))
        docs = np.repeat(place, counts)
        return Shard(terms, docs, scores, len(order), len(weights)), keys[order]

    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            held.append(part)
            size += len(part.column(2).flatten())
            if size >= POSTINGS_PER_SHARD:
                yield made()
                held, size = [], 0
    if held:
        yield made()


def _block(docs: DataFrame, items: list, item_type: StructField, k: int) -> DataFrame:
    """(item, item_id, rank, doc_id, score) of one block of queries, held whole."""
    queries = [Counter(terms_of(None if t is None else bytes(t))) for _, t in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*queries)))}
    postings = scratch(_postings(docs, vocabulary), "postings")
    documents, length = postings.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = np.array([weight(documents, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    plan = [[(vocabulary[t], times) for t, times in q.items() if vocabulary[t] in df] for q in queries]
    ids = [item_id for item_id, _ in items]
    state = share(docs.sparkSession, (weights, plan, ids))
    added = [StructField(name, LongType()) for name in ("item", "doc_id", "score")]
    schema = StructType([added[0], item_type, *added[1:]])
    names, kinds = schema.fieldNames(), to_arrow_schema(schema).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, plan, ids = shared(state)
        best = [Best(k) for _ in plan]
        for shard, keys in _shards(batches, weights, documents, length):
            for query, found in zip(plan, best, strict=True):
                search_shard(shard, query, keys, found)
        at = [i for i, found in enumerate(best) for _ in found.scores]
        keys = [key for found in best for key in found.keys.tolist()]
        columns = [
            at,
            [ids[i] for i in at],
            [None if missing else doc for missing, doc in keys],
            [s for found in best for s in found.scores.tolist()],
        ]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names)

    first = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = postings.mapInArrow(run, schema).withColumn("rank", F.row_number().over(first))
    return ranked.where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents for each item.

    ``docs`` has doc_id (whole numbers) and text, ``items`` item_id and text; other columns are not
    looked at. Each row of either is a document or an item of its own, also where ids repeat or are
    NULL, and rows without an id are last among equal scores. NULL and empty texts have no terms and
    are in no result; neither are scores of 0. An empty table gives no rows.

    Queries are taken in blocks of bounded bytes (a longer one is a block by itself); the terms and
    the weights of a block are broadcast, and each block reads the documents anew. Documents are not
    shuffled: a task returns k rows an item at most.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    asked = items.select("item_id", F.col("text").cast("binary").alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // QUERY_BYTES
    at = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = []
    for block in range(blocks):
        held = asked.where(at == block).select("item_id", "text").collect()
        found.append(_block(docs, held, asked.schema["item_id"], k))
    return reduce(DataFrame.unionAll, found).select("item_id", "rank", "doc_id", "score")
