"""Amounts whose decimal mark only the rest of their file can tell.

``1.234`` is one thousand in one file and nothing readable in another. Each amount that can be read in
one way only votes for its decimal mark, by file and column; the others follow the majority.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger_spark.functions.amounts import AMOUNT_PATTERN, parse_amount
from ledger_spark.operators.spread import lookup_join
from ledger_spark.schemas import MONEY

# Fixed patterns of amounts without two decimals, of which the first three can be read in one way.
WHOLE = r"^-?[0-9]+$"
TENTHS = r"^-?[0-9][0-9.,]*[.,][0-9]$"
GROUPS = r"^-?[0-9]{1,3}(?:(?:\.[0-9]{3}){2,}|(?:,[0-9]{3}){2,})$"
OPEN = r"^-?[0-9]{1,3}[.,][0-9]{3}$"

VOTES = {",": "votos_coma", ".": "votos_punto"}
UNREADABLE, AMBIGUOUS = "importe ilegible", "importe ambiguo"


def decimal_mark(text: Column) -> Column:
    """The decimal mark that the text shows beyond doubt: one before two digits or one. Else NULL."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(AMOUNT_PATTERN), F.substring(trimmed, -3, 1)).when(
        trimmed.rlike(TENTHS), F.substring(trimmed, -2, 1)
    )


def _digits(trimmed: Column, scale: str) -> Column:
    """All digits as one number, times the scale."""
    number = F.translate(trimmed, ".,", "").try_cast("decimal(16,0)")
    return (number * F.lit(scale).cast("decimal(2,1)")).cast(MONEY)


def amounts_by_vote(rows: DataFrame, text: str, by: list[str]) -> DataFrame:
    """``rows`` with ``importe``, ``motivo`` where there is none, and the votes of the row's file.

    ``by`` names what one writer filled in: the file and the column. An amount of one separator before
    three digits is whole where more amounts of its ``by`` have the other decimal mark than have this
    one. Otherwise it is ambiguous: three decimals are no money, and a tie is no majority. A NULL text
    is unreadable; rows stay all, and NULL is a value of ``by`` like any other.

    Votes are added up in the tasks and are one row per ``by``, so a file of a third of all rows is no
    hot task; the rows themselves meet only their file's votes.
    """
    mark = decimal_mark(F.col(text))
    key = F.struct(*by)
    votes = rows.groupBy(key.alias("_by")).agg(
        *[F.count(F.when(mark == m, 1)).alias(name) for m, name in VOTES.items()]
    )
    told = lookup_join(rows.withColumn("_by", key), votes, "_by", "left_outer").drop("_by")
    trimmed = F.trim(F.col(text))
    comma, point = (F.col(name) for name in VOTES.values())
    other_wins = F.when(trimmed.contains("."), comma > point).otherwise(point > comma)
    whole = trimmed.rlike(WHOLE) | trimmed.rlike(GROUPS) | (trimmed.rlike(OPEN) & other_wins)
    amount = (
        F.when(trimmed.rlike(AMOUNT_PATTERN), parse_amount(F.col(text)))
        .when(trimmed.rlike(TENTHS), _digits(trimmed, "0.1"))
        .when(whole, _digits(trimmed, "1.0"))
    )
    reason = F.when(F.col("importe").isNull(), F.when(trimmed.rlike(OPEN), AMBIGUOUS).otherwise(UNREADABLE))
    named = told.withColumn("importe", amount).withColumn("motivo", reason)
    return named.select(*rows.columns, "importe", "motivo", *VOTES.values())
