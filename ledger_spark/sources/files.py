"""Readers of the delivered files: explicit schemas, bad rows kept, plain names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger_spark.schemas import (
    CORRUPT,
    MONTHLY_EXPENSES_FIXED,
    ROSTER_FILE,
    ROSTER_NAMES,
)
from ledger_spark.sources.json_array import read_json_array

RECORD = "map<string, string>"


def read_delimited(
    spark: SparkSession, path, schema: T.StructType, sep: str = "|", **options
) -> DataFrame:
    """Delimited text with a header. A row that does not fit the schema keeps
    its text in ``_corrupt_record``, for the import to reject. Every field is
    parsed whatever the query selects, so that a short row is always noticed. A
    file whose header has other names or another order is refused."""
    return (
        spark.read.schema(T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]))
        .options(sep=sep, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .options(columnPruning=False, enforceSchema=False, **options)
        .csv(path)
    )


def read_roster(spark: SparkSession, path) -> DataFrame:
    """Unit roster with columns cbu, consorcio, numero, piso, departamento."""
    return read_delimited(spark, path, ROSTER_FILE).withColumnsRenamed(ROSTER_NAMES)


def parse_roster_lines(lines: DataFrame, column: str = "linea") -> DataFrame:
    """The roster from lines already held as a text column."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ROSTER_FILE)
    row = F.from_csv(F.col(column), ddl, {"sep": "|"})
    return lines.select(row.alias("r")).select("r.*").withColumnsRenamed(ROSTER_NAMES)


def read_monthly_expenses(
    spark: SparkSession, path, json_lines: bool = False, large: bool = False
) -> DataFrame:
    """Monthly expense records with their source position.

    ``path`` may name many files; they are read in parallel. A pretty-printed
    array is one task; with ``large`` it is cut at its objects by many tasks, and
    an object that cannot be read is rejected alone. ``posicion`` orders the
    records of one load as they stand in the files: by file, by place of the
    split in it, then by row of the split.
    """
    if large:
        objects = read_json_array(spark, path).select(
            F.struct("archivo", F.lit(0).cast("bigint").alias("bloque"), "fila").alias("posicion"),
            F.col("texto").alias("value"),
            F.from_json("texto", RECORD).alias("campos"),
        )
        return _readable(objects)
    files = spark.read.text(path, wholetext=not json_lines)
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    if json_lines:
        lines = files.where(F.trim("value") != "").select(
            F.struct(
                file.alias("archivo"),
                block.alias("bloque"),
                F.monotonically_increasing_id().alias("fila"),
            ).alias("posicion"),
            "value",
            F.from_json("value", RECORD).alias("campos"),
        )
    else:
        lines = files.select(
            file.alias("archivo"),
            "value",
            F.posexplode_outer(F.from_json("value", f"array<{RECORD}>")).alias("fila", "campos"),
        ).select(
            F.struct(
                "archivo",
                F.lit(0).cast("bigint").alias("bloque"),
                F.coalesce("fila", F.lit(0)).cast("bigint").alias("fila"),
            ).alias("posicion"),
            "value",
            "campos",
        )
    return _readable(lines)


def _readable(lines: DataFrame) -> DataFrame:
    corrupt = F.when(F.col("campos").isNull(), F.col("value")).alias(CORRUPT)
    return lines.select("posicion", corrupt, "campos").transform(plain_expense_names)


def parse_monthly_expenses(records: DataFrame, column: str = "registro") -> DataFrame:
    """Monthly expense records from JSON objects held as a text column; other
    columns stay."""
    others = [c for c in records.columns if c != column]
    fields = F.from_json(F.col(column), RECORD).alias("campos")
    return records.select(*others, fields).transform(plain_expense_names)


def plain_expense_names(records: DataFrame) -> DataFrame:
    """oid, consorcio, periodo, and every other key of the record with its text in the
    map ``rubros``: a category nobody has seen yet is a line like any other."""
    fields = F.col("campos")
    names = {
        "oid": F.get_json_object(fields["_id"], "$.$oid"),
        "consorcio": fields["Nombre del consorcio"],
        "periodo": fields["Mes"],
        "rubros": F.map_filter(fields, lambda k, _: ~k.isin(*MONTHLY_EXPENSES_FIXED)),
    }
    return records.withColumns(names).drop("campos")


def json_field(text, field: str, kind: str):
    """One typed field of a JSON object held as text."""
    return F.from_json(text, f"`{field}` {kind}")[field]
