"""Months with the largest expenses and incomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_spark.schemas import TOTAL


def top5_expense_income(expense_lines: DataFrame, payments: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` highest months of each kind; ties by month."""

    def highest(rows: DataFrame, month, kind: str) -> DataFrame:
        return (
            rows.groupBy(month.alias("mes"))
            .agg(F.sum("importe").cast(TOTAL).alias("importe"))
            .orderBy(F.desc("importe"), "mes")
            .limit(n)
            .select(F.lit(kind).alias("tipo"), "mes", "importe")
        )

    return highest(expense_lines, F.col("mes"), "gasto").unionByName(
        highest(payments, F.trunc("fecha_de_pago", "month"), "ingreso")
    )
