"""Curated ledger tables as Parquet, laid out by the keys the reports read.

A load writes folders of its own and, as its last step, one row that names the folders of which every
table now consists. Readers follow the last such row: a load is there as a whole or not at all, one
that was cut off is invisible and may simply be run again, and a report that has begun goes on with
the folders it began with.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger_spark import schemas
from ledger_spark.session import discard
from ledger_spark.tables import LedgerTables

PAYMENT_MONTH = "mes_de_pago"
# Payments without an account, apart from the others so that matching them again moves only them.
PENDING = "pago_pendiente"
# Folders of every table after a load; the row with the highest number counts.
VERSION = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("carga", T.StringType()),
        T.StructField("tablas", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    ]
)


@dataclass(frozen=True)
class Layout:
    schema: T.StructType
    sort: list[str]
    partition: list[str] = field(default_factory=list)


# Partition columns only where reports select by period; sort columns give
# Parquet row groups narrow key ranges, so filters on them skip row groups.
LAYOUTS = {
    "consorcio": Layout(schemas.BUILDING, ["id_consorcio"]),
    "expensa_consorcio": Layout(schemas.CHARGE, ["id_consorcio", "periodo"]),
    "gasto": Layout(schemas.EXPENSE_LINE, ["id_consorcio"], ["mes"]),
    "persona": Layout(schemas.PERSON, ["es_inquilino", "apellido", "nombre"]),
    "unidad_funcional": Layout(schemas.UNIT, ["id_consorcio", "departamento"]),
    "uf_persona": Layout(schemas.UNIT_PERSON, ["id_persona"]),
    "persona_cuenta": Layout(schemas.ACCOUNT, ["id_persona"]),
    "pago": Layout(schemas.PAYMENT, ["fecha_de_pago", "id_pago"], [PAYMENT_MONTH]),
    PENDING: Layout(
        T.StructType([*schemas.PAYMENT.fields, T.StructField(PAYMENT_MONTH, T.DateType())]),
        ["fecha_de_pago", "id_pago"],
    ),
    "cotizacion": Layout(schemas.QUOTE, ["fecha"]),
    "proveedor": Layout(schemas.SUPPLIER, ["nombre"]),
}


def _hashed(column: T.StructField) -> list[Column]:
    """What of a column goes into a row's hash, which passes over NULLs and takes no maps."""
    value = F.col(column.name)
    if isinstance(column.dataType, (T.MapType, T.ArrayType, T.StructType)):
        value = F.to_json(F.struct(value))
    return [value.isNull(), value]


class LedgerStore:
    """Tables below one root folder on the cluster's shared storage; one load at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # While a load runs: its name, and the folders of every table with what it has written.
        self._load: str | None = None
        self._folders: dict[str, list[str]] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _latest(self) -> tuple[int, dict[str, list[str]]]:
        """Number of the last version and its folders; 0 and none while nothing has been loaded."""
        try:
            rows = self.spark.read.schema(VERSION).parquet(self.path("versiones"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        last = rows.orderBy(F.desc("version")).first()
        return (last["version"], last["tablas"]) if last else (0, {})

    @contextmanager
    def load(self, step: str, *delivered: DataFrame) -> Iterator[list[DataFrame]]:
        """Run a load: gives the delivered rows, read once; what is written inside appears at the end.

        The rows are staged next to the tables, so that every use of them sees the same rows, even
        after an executor is lost. Their number and digest name the load: the same rows delivered
        again write their rejects over those of the first time.
        """
        if self._load is not None:
            raise RuntimeError(f"{self._load} is still running")
        version, folders = self._latest()
        staged = [self.staged(step, df) for df in delivered]
        try:
            self._load = "-".join([step, *[df.digest for df in staged]])
            self._version, self._folders = version, dict(folders)
            yield staged
            if self._folders != folders:
                row = [(version + 1, self._load, self._folders)]
                pointer = self.spark.createDataFrame(row, VERSION).coalesce(1)
                pointer.write.mode("append").parquet(self.path("versiones"))
        finally:
            self._load, self._folders = None, {}
            for df in staged:
                discard(self.spark, df.staged_at)

    def _curated(self, name: str, df: DataFrame) -> DataFrame:
        """The table's columns and types, sorted within files.

        The rebalance hint gathers each partition value into few files, and
        lets AQE split a value that holds most of the rows.
        """
        layout = LAYOUTS[name]
        if name in ("pago", PENDING):
            df = df.withColumn(PAYMENT_MONTH, F.trunc("fecha_de_pago", "month"))
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.schema]
        extra = [c for c in layout.partition if c not in layout.schema.fieldNames()]
        rows = df.select(*columns, *extra).hint("rebalance", *layout.partition)
        return rows.sortWithinPartitions(*layout.partition, *layout.sort)

    def write(
        self, name: str, df: DataFrame, mode: str = "append", staged: bool = False
    ) -> None:
        """Add rows to (or, with ``overwrite``, replace) a table; outside a load, a load by itself.

        The rows may be computed from the table: they go into a folder of their own. Payments
        without an account go to ``PENDING``; ``staged`` rows come from files already and need not
        be written down before they are told apart.
        """
        if self._load is None:
            with self.load(f"{name}-{uuid.uuid4().hex}"):
                self.write(name, df, mode, staged)
        elif name == "pago":
            rows, account = df if staged else self._rows_in_files(name, df), F.col("id_persona_cuenta")
            self._write(name, rows.where(account.isNotNull()), mode)
            self._write(PENDING, rows.where(account.isNull()), mode)
            if not staged:
                discard(self.spark, rows.staged_at)
        else:
            self._write(name, df, mode)

    def _write(self, name: str, df: DataFrame, mode: str) -> None:
        held = self._folders.get(name, []) if mode == "append" else []
        # A load that was cut off and is run again finds its folder and writes over it.
        folder = f"{name}/carga={self._load}-{self._version + 1}-{len(held)}"
        seen = Observation()
        rows = self._curated(name, df).observe(seen, F.count(F.lit(1)).alias("filas"))
        writer = rows.write.mode("overwrite").partitionBy(*LAYOUTS[name].partition)
        writer.parquet(self.path(folder))
        if seen.get["filas"]:
            self._folders[name] = [*held, folder]
        else:
            discard(self.spark, self.path(folder))
            self._folders[name] = held

    def staged(self, name: str, df: DataFrame) -> DataFrame:
        """The rows written next to the tables once and read back. ``staged_at`` names the folder,
        ``digest`` tells their number and their content in any order."""
        seen = Observation()
        each = F.xxhash64(*[x for f in df.schema for x in _hashed(f)]).cast("decimal(38,0)")
        sums = [F.count(F.lit(1)).alias("filas"), F.sum(each).alias("suma")]
        rows = self._rows_in_files(name, df.observe(seen, *sums))
        rows.digest = f"{seen.get['filas']}-{int(seen.get['suma'] or 0) % (1 << 64):016x}"
        return rows

    def _rows_in_files(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/_staging/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        rows = self.spark.read.schema(df.schema).parquet(path)
        rows.staged_at = path
        return rows

    def write_rejected(self, name: str, df: DataFrame) -> None:
        """The rejects of the load that is running, in place of those of its earlier runs."""
        df.write.mode("overwrite").parquet(f"{self.root}/_rechazos/{name}/carga={self._load}")

    def rejected(self, name: str) -> DataFrame:
        """The rejects of every load of a table, with the load in ``carga``."""
        return self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/_rechazos/{name}")

    def _parquet(self, name: str, folders: list[str]) -> DataFrame:
        layout = LAYOUTS[name]
        extra = [c for c in layout.partition if c not in layout.schema.fieldNames()]
        schema = T.StructType(layout.schema.fields + [T.StructField(c, T.DateType()) for c in extra])
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.path(name))
        return rows.parquet(*map(self.path, folders)).select(*schema.names)

    def read(self, name: str, folders: dict[str, list[str]] | None = None) -> DataFrame:
        """The table; without rows while nothing has been loaded. Payments are those with and
        without an account. ``folders`` are those of one version, by default the last."""
        if folders is None:
            folders = self._folders if self._load is not None else self._latest()[1]
        rows = self._parquet(name, folders.get(name, []))
        if name == "pago" and folders.get(PENDING):
            rows = rows.unionByName(self._parquet(PENDING, folders[PENDING]))
        return rows

    def payments(
        self,
        since: datetime.date | None = None,
        until: datetime.date | None = None,
        folders: dict[str, list[str]] | None = None,
    ) -> DataFrame:
        """Payments of a date range; months outside it are never listed or read."""
        rows = self.read("pago", folders)
        if since is not None:
            rows = rows.where(F.col("fecha_de_pago") >= F.lit(since)).where(
                F.col(PAYMENT_MONTH) >= F.lit(since.replace(day=1))
            )
        if until is not None:
            rows = rows.where(F.col("fecha_de_pago") <= F.lit(until)).where(
                F.col(PAYMENT_MONTH) <= F.lit(until.replace(day=1))
            )
        return rows.drop(PAYMENT_MONTH)

    def tables(
        self, since: datetime.date | None = None, until: datetime.date | None = None
    ) -> LedgerTables:
        """All tables, of one version."""
        folders = self._latest()[1]
        return LedgerTables(
            buildings=self.read("consorcio", folders),
            charges=self.read("expensa_consorcio", folders),
            expense_lines=self.read("gasto", folders),
            people=self.read("persona", folders),
            units=self.read("unidad_funcional", folders),
            unit_people=self.read("uf_persona", folders),
            accounts=self.read("persona_cuenta", folders),
            payments=self.payments(since, until, folders),
        )

