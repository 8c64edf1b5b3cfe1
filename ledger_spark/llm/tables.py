"""Reading tables, scratch tables on shared storage, and batches of texts."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledger_spark.session import shared_folder

# Rows that Spark hands to Python at once, where the session leaves it open: by default they are ten
# thousand, which is too much room for long texts on either side.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ROWS_AT_ONCE = 1024
# Without it the shuffle files of a write that has ended lie on the disks until the driver happens to
# collect its garbage, so that those of several writes add up.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Let the session hand over texts in small batches; what it sets itself is kept."""
    if spark.conf.get(ARROW_ROWS, None) is None:
        spark.conf.set(ARROW_ROWS, ROWS_AT_ONCE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, names: list[str]) -> list[str]:
    """For each name one that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    mark = "_"
    while any(f"{mark}{name}".lower() in taken for name in names):
        mark += "_"
    return [f"{mark}{name}" for name in names]


def scratch_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows written to the shared folder and read again, and the path of the files, for
    ``discard``. Shuffle files of the write go with its end."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def scratch(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: later steps start from files
    that every executor sees, not from a long lineage."""
    return scratch_at(df, name)[0]


def share(spark: SparkSession, model) -> Broadcast:
    """A model of bounded size for all tasks, pickled with its classes; see ``shared``."""
    small_batches(spark)
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def shared(broadcast: Broadcast):
    return pickle.loads(broadcast.value)


def pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in slices whose texts hold about ``limit`` bytes, at least one row each."""
    for batch in batches:
        start, size = 0, 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
        for row, length in enumerate(lengths.to_pylist()):
            if size and size + length > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if start < batch.num_rows:
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()


def from_text(
    df: DataFrame,
    text_column: str,
    added: str,
    start: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
    limit: int = 4_000_000,
) -> DataFrame:
    """``df`` with columns computed from a text column, all rows and other columns as they are.

    ``added`` is their schema as DDL, ``start`` is called once a task and gives the function from
    texts to arrays. Columns of these names are replaced. No shuffle; texts come in slices.
    """
    new = StructType.fromDDL(added)
    rows = df.drop(*new.fieldNames())
    kinds = to_arrow_schema(new)
    at = rows.columns.index(text_column)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in pieces(batches, at, limit):
            made = compute(batch.column(at).to_pylist())
            names = batch.schema.names + kinds.names
            yield pa.RecordBatch.from_arrays(
                batch.columns + [a.cast(k) for a, k in zip(made, kinds.types, strict=True)], names
            )

    return rows.mapInArrow(run, StructType(rows.schema.fields + new.fields))
