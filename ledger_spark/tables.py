"""The set of ledger tables a report reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class LedgerTables:
    buildings: DataFrame
    charges: DataFrame
    expense_lines: DataFrame
    people: DataFrame
    units: DataFrame
    unit_people: DataFrame
    accounts: DataFrame
    payments: DataFrame
