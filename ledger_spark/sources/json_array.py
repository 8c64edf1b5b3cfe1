"""The objects of JSON arrays, one file read by as many tasks as it has blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledger_spark.session import staged

# Whether a piece begins inside a string depends on all pieces before it. Both cases are counted.
OUTSIDE, INSIDE = 0, 1


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _counted(value: Column) -> dict[str, Column]:
    """Quotes of a piece that ends before a closing brace, and by how much it moves the depth if it
    begins outside or inside a string. A quote after a backslash ends no string."""
    bare = F.regexp_replace(value, r"(?s)\\.", "")
    quotes = _count(bare, '"')
    opened = lambda text: _count(F.regexp_replace(text, '"[^"]*("|$)', ""), "{")
    later = F.regexp_replace(bare, '^[^"]*("|$)', "")
    even = (quotes % 2 == 0).cast("long")
    return {
        "comillas": quotes.cast("long"),
        "fuera": opened(bare) - even,
        "dentro": opened(later) - (1 - even),
    }


def _pieces(spark: SparkSession, path) -> DataFrame:
    """The text between closing braces with its place, its counts, and within its block of the file:
    quotes before it, and depth after it for either beginning of the block."""
    meta = F.col("_metadata")
    read = spark.read.option("lineSep", "}").text(path).select(
        meta["file_path"].alias("archivo"),
        meta["file_size"].alias("largo"),
        meta["file_block_start"].alias("bloque"),
        F.monotonically_increasing_id().alias("orden"),
        "value",
    )
    block = Window.partitionBy("archivo", "bloque").orderBy("orden")
    before = F.coalesce(F.sum("comillas").over(block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sofar = block.rowsBetween(Window.unboundedPreceding, 0)
    moved = read.withColumns(_counted(F.col("value"))).withColumn("antes", before)
    inside = F.col("antes") % 2 == 1
    return moved.withColumns(
        {
            f"hondo_{OUTSIDE}": F.sum(F.when(inside, F.col("dentro")).otherwise(F.col("fuera"))).over(sofar),
            f"hondo_{INSIDE}": F.sum(F.when(inside, F.col("fuera")).otherwise(F.col("dentro"))).over(sofar),
        }
    ).drop("fuera", "dentro")


def _blocks(pieces: DataFrame) -> DataFrame:
    """For each block: whether it begins inside a string, the depth it begins with, and whether it holds
    the end of a file whose last byte is no closing brace."""
    last = lambda c: F.max_by(c, "orden")
    totals = pieces.groupBy("archivo", "bloque").agg(
        F.sum("comillas").alias("comillas"),
        last(f"hondo_{OUTSIDE}").alias("fuera"),
        last(f"hondo_{INSIDE}").alias("dentro"),
        F.max("orden").alias("ultimo"),
        F.sum(F.octet_length("value") + F.lit(1)).alias("bytes"),
        F.max("largo").alias("largo"),
    )
    file = Window.partitionBy("archivo")
    earlier = file.orderBy("bloque").rowsBetween(Window.unboundedPreceding, -1)
    entered = (F.coalesce(F.sum("comillas").over(earlier), F.lit(0)) % 2).alias("entrada")
    # A byte order mark is three bytes that the reader leaves out.
    missing = F.col("largo") - F.sum("bytes").over(file)
    is_last = F.col("bloque") == F.max("bloque").over(file)
    begun = totals.select("*", entered, (is_last & ~missing.isin(0, 3)).alias("abierto"))
    gained = F.when(F.col("entrada") == INSIDE, F.col("dentro")).otherwise(F.col("fuera"))
    depth = F.coalesce(F.sum(gained).over(earlier), F.lit(0))
    return begun.select(
        F.col("archivo").alias("_archivo"),
        F.col("bloque").alias("_bloque"),
        "entrada",
        depth.alias("base"),
        F.when(F.col("abierto"), F.col("ultimo")).alias("_abierto"),
    )


def read_json_array(spark: SparkSession, path) -> DataFrame:
    """(archivo, fila, texto): the objects of the arrays in the files, numbered from zero in each file.

    Files are cut at closing braces, so that every block of a file is a task of its own. Sums over
    the pieces of a block, and over the blocks of a file, tell which of these braces end an object of
    the array: those outside strings at depth zero. Only pieces of one object come together. A file may
    hold several arrays. What stands between objects and is no comma or bracket goes to the next one; an object that the file does not end
    keeps its text as it is, so neither parses. A file without objects has no rows.
    """
    pieces = staged(_pieces(spark, path), "json-pieces")
    starts = _blocks(pieces)
    at = (F.col("archivo") == F.col("_archivo")) & (F.col("bloque") == F.col("_bloque"))
    deep = F.when(F.col("entrada") == INSIDE, F.col(f"hondo_{INSIDE}")).otherwise(F.col(f"hondo_{OUTSIDE}"))
    outside = (F.col("entrada") + F.col("antes") + F.col("comillas")) % 2 == 0
    open_end = F.coalesce(F.col("orden") == F.col("_abierto"), F.lit(False))
    placed = pieces.join(starts, at).select(
        "archivo",
        "bloque",
        "orden",
        F.when(open_end, F.col("value")).otherwise(F.concat("value", F.lit("}"))).alias("value"),
        (outside & (F.col("base") + deep == 0) & ~open_end).cast("long").alias("termina"),
    )
    ended = placed.groupBy("archivo", "bloque").agg(F.sum("termina").alias("objetos"))
    earlier = Window.partitionBy("archivo").orderBy("bloque").rowsBetween(Window.unboundedPreceding, -1)
    ended = ended.select(
        F.col("archivo").alias("_archivo"),
        F.col("bloque").alias("_bloque"),
        F.coalesce(F.sum("objetos").over(earlier), F.lit(0)).alias("previos"),
    )
    before = Window.partitionBy("archivo", "bloque").orderBy("orden")
    before = F.sum("termina").over(before.rowsBetween(Window.unboundedPreceding, -1))
    numbered = placed.withColumn("_n", F.coalesce(before, F.lit(0))).join(ended, at)
    found = numbered.groupBy("archivo", (F.col("previos") + F.col("_n")).alias("fila")).agg(
        F.sort_array(F.collect_list(F.struct("bloque", "orden", "value"))).alias("_partes")
    )
    text = F.array_join(F.col("_partes")["value"], "")
    text = F.regexp_replace(text, r"^[\x{FEFF}\s,\[\]]*", "")
    return found.select("archivo", "fila", text.alias("texto")).where(F.col("texto") != "")
