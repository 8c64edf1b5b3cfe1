"""Decimal money expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledger_spark.schemas import MONEY, PERCENT

# Fixed pattern: digits and separators, ending in a separator and two decimals.
AMOUNT_PATTERN = r"^-?[0-9][0-9.,]*[.,][0-9]{2}$"


def parse_amount(text: Column) -> Column:
    """Decimal value of an amount whose separators follow no single locale.

    The last separator is the decimal mark and is followed by two digits;
    every earlier separator groups digits. ``1,234.56``, ``7.890,12`` and
    ``345,678,90`` all read: without separators the digits are the cents. Text
    of another shape gives NULL, never an error.
    """
    trimmed = F.trim(text)
    cents = F.translate(trimmed, ".,", "").try_cast("decimal(18,0)")
    amount = (cents * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)
    return F.when(trimmed.rlike(AMOUNT_PATTERN), amount)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def parse_percent(text: Column) -> Column:
    """A percentage with up to two decimals after either mark, with or without the sign: ``4,5``,
    ``10``, ``3.25 %``. Other text gives NULL."""
    bare = F.trim(F.regexp_replace(text, "%$", ""))
    number = F.translate(bare, ",", ".").try_cast(PERCENT)
    return F.when(bare.rlike(r"^[0-9]{1,3}(?:[.,][0-9]{0,2})?$"), number)


def at_least_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0).cast(MONEY))


def percent_of(amount: Column, percent: Column) -> Column:
    """``amount * percent / 100`` without division, hence without rounding."""
    return amount * percent * F.lit("0.01").cast("decimal(3,2)")
