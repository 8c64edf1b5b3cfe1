"""Building-expense ledger analytics on Spark DataFrames."""

from ledger_spark.tables import LedgerTables

__all__ = ["LedgerTables"]
