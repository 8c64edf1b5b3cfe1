"""Compression of integer vectors to codes of codebook entries, with memoised grid cells.

A vector is cut into equal parts, and each part is written as the index of its nearest codebook
entry. A codebook is found by rounds of assigning and averaging over all rows. Whatever lies in one
cell of a coarse grid has few entries that can be nearest: an entry whose least distance to the
cell's box exceeds another's greatest is nearest nowhere in it. The entries that are left are kept
under the cell's key and used for every later part in that cell; only they are evaluated, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledger_spark.llm.tables import scratch, share, shared
from ledger_spark.operators.spread import lookup_join

# Whole numbers beyond this saturate, so that squared distances and their sums fit 64 bits.
LIMIT = 1 << 26
# Cells along the range of a codebook's entries, in each dimension.
CELLS = 8
# Cells remembered per part position; beyond it the memory of a position starts anew.
MAX_CELLS = 1 << 14
ROWS_AT_ONCE = 2048
BOUNDS_AT_ONCE = 256


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as a bigint, held within ``LIMIT``."""

    def whole(x: Column) -> Column:
        held = F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x.cast("double") * scale))
        return F.floor(held).cast("bigint")

    return F.transform(vector, whole)


class PartCodebook:
    """The entries of one part position, and what is known of the grid cells met so far."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        spread = int((entries.max(axis=0) - entries.min(axis=0)).max())
        self.edge = max(1, -(-spread // CELLS))
        self.known: dict[bytes, np.ndarray] = {}

    def possible(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell the entries, ascending, that can be nearest to a whole point of its box."""
        keys = [c.tobytes() for c in cells]
        new = [i for i, key in enumerate(keys) if key not in self.known]
        if len(self.known) + len(new) > MAX_CELLS:
            self.known, new = {}, list(range(len(keys)))
        for start in range(0, len(new), BOUNDS_AT_ONCE):
            at = new[start : start + BOUNDS_AT_ONCE]
            low = cells[at][:, None, :] * self.edge
            below, above = low - self.entries, self.entries - (low + self.edge - 1)
            least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
            most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
            left = least <= most.min(axis=1, keepdims=True)
            for i, row in zip(at, left, strict=True):
                self.known[keys[i]] = np.flatnonzero(row)
        return [self.known[key] for key in keys]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest entry, the lower index of equals."""
        cells, inside = np.unique(points // self.edge, axis=0, return_inverse=True)
        kept = self.possible(cells)
        sizes = np.array([len(k) for k in kept])
        starts = np.cumsum(sizes) - sizes
        flat = np.concatenate(kept)
        inside = inside.reshape(-1)
        each = sizes[inside]
        first = np.cumsum(each) - each
        # Position of every (point, possible entry) pair in ``flat``.
        place = np.arange(each.sum()) - np.repeat(first - starts[inside], each)
        entry = flat[place]
        apart = np.repeat(points, each, axis=0) - self.entries[entry]
        distance = np.einsum("ij,ij->i", apart, apart)
        best = np.minimum.reduceat(distance, first)
        entry = np.where(distance == np.repeat(best, each), entry, len(self.entries))
        return np.minimum.reduceat(entry, first), best


def _blocks(
    batches: Iterator[pa.RecordBatch], column: int, width: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of rows, which of them have vectors of the width, and these vectors."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            vectors = part.column(column)
            fit = pa.compute.equal(pa.compute.list_value_length(vectors), width).fill_null(False)
            held = vectors.filter(fit).flatten().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(fit.to_numpy(zero_copy_only=False))
            yield part, at, held.astype(np.int64).reshape(-1, width)


def _sums(rows: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(part, entry, place, n, total): over all rows the sums of the parts nearest to each entry.

    A task returns one row per number of the codebooks, whatever the rows.
    """
    parts, entries, width = codebooks.shape
    books_of_task = share(rows.sparkSession, codebooks)
    names = ["part", "entry", "place", "n", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [PartCodebook(b) for b in shared(books_of_task)]
        n = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, width), dtype=np.int64)
        for _, at, vectors in _blocks(batches, 0, parts * width):
            if not len(at):
                continue
            for p, book in enumerate(books):
                points = vectors[:, p * width : (p + 1) * width]
                index, _ = book.nearest(points)
                n[p] += np.bincount(index, minlength=entries)
                np.add.at(total[p], index, points)
        part, entry = np.nonzero(n)
        arrays = [
            np.repeat(part, width),
            np.repeat(entry, width),
            np.tile(np.arange(width), len(part)),
            np.repeat(n[part, entry], width),
            total[part, entry].reshape(-1),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays], names)

    found = rows.select("v").mapInArrow(run, ", ".join(f"{name} long" for name in names))
    return found.groupBy("part", "entry", "place").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    )


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the rows of smallest vec_id, as (part, entry, place).

    The width is that of the first row whose length divides into parts; ids that repeat are ordered
    by the vector, rows without an id come last. At most ``entries`` vectors reach the driver.
    """
    fit = rows.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    head = fit.orderBy(*order).select("v").limit(1).collect()
    if not head:
        return np.zeros((parts, 0, 1), dtype=np.int64)
    width = len(head[0]["v"])
    chosen = fit.where(F.size("v") == width).orderBy(*order).select("v").limit(entries).collect()
    vectors = np.array([r["v"] for r in chosen], dtype=np.int64)
    return np.ascontiguousarray(vectors.reshape(len(chosen), parts, -1).transpose(1, 0, 2))


def fit_codebooks(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray:
    """Codebooks (part, entry, place) after so many rounds over all ``rows`` (vec_id, v).

    The driver holds the codebooks alone; an entry that is nearest to no part stays as it is.
    """
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books.shape[1] else 0):
        for part, entry, place, n, total in _sums(rows, books).collect():
            books[part, entry, place] = total // n
    return books


def encode(rows: DataFrame, codebooks: np.ndarray, vector_column: str = "v") -> DataFrame:
    """``rows`` with ``codes`` (array of entry indexes in part order) and ``error`` (squared
    distances added up), replaced if there; NULL for vectors of another length. No shuffle."""
    parts, _, width = codebooks.shape
    books_of_task = share(rows.sparkSession, codebooks)
    new = StructType.fromDDL("codes array<int>, error long")
    rows = rows.drop(*new.fieldNames())
    kinds = to_arrow_schema(new)
    column = rows.columns.index(vector_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared(books_of_task)
        books = [PartCodebook(b) for b in held] if held.shape[1] else []
        for batch, at, vectors in _blocks(batches, column, parts * width if books else -1):
            codes = np.empty((len(at), parts), dtype=np.int32)
            error = np.zeros(len(at), dtype=np.int64)
            for p, book in enumerate(books if len(at) else []):
                codes[:, p], best = book.nearest(vectors[:, p * width : (p + 1) * width])
                error += best
            all_codes: list[np.ndarray | None] = [None] * batch.num_rows
            all_errors: list[int | None] = [None] * batch.num_rows
            for i, c, e in zip(at.tolist(), codes, error.tolist(), strict=True):
                all_codes[i], all_errors[i] = c, e
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(all_codes, kinds.types[0]),
                    pa.array(all_errors, kinds.types[1]),
                ],
                batch.schema.names + kinds.names,
            )

    return rows.mapInArrow(run, StructType(rows.schema.fields + new.fields))


def with_label_error(coded: DataFrame, name: str) -> DataFrame:
    """``label_error``: the errors of all rows of the same label, NULL labels being one.

    Sums are combined in the map tasks and looked up again, so that one label may hold most rows.
    NULL where the sum is beyond 64 bits or no row of the label has an error.
    """
    coded = scratch(coded.withColumn("_label", F.struct("label")), name)
    sums = coded.groupBy("_label").agg(F.try_sum("error").alias("label_error"))
    return lookup_join(coded, sums, "_label", "left").drop("_label")


def compress(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2
) -> tuple[DataFrame, np.ndarray]:
    """Rows of ``vectors`` (vec_id, label, v) with codes, error and label_error; the codebooks.

    ``v`` holds bigints. Each row counts as often as it is there. With fewer rows than entries the
    codebooks have as many entries as rows; an empty table gives no rows and empty codebooks. A
    vector whose length is not that of the first one divisible into parts keeps its row with NULL
    codes and error and has no share in codebooks and sums.
    """
    rows = scratch(vectors.select("vec_id", "label", "v"), "vectors")
    books = fit_codebooks(rows, parts, entries, rounds)
    coded = encode(rows, books).drop("v")
    return with_label_error(coded, "codes"), books
