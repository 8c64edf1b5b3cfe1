"""Text and month expressions. All are built-in expressions inside codegen."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names as written in the expense files, in calendar order.
MONTHS = [
    "enero",
    "febrero",
    "marzo",
    "abril",
    "mayo",
    "junio",
    "julio",
    "agosto",
    "septiembre",
    "octubre",
    "noviembre",
    "diciembre",
]


def normalise(text: Column) -> Column:
    """Lower case without surrounding blanks, so that equal labels compare equal."""
    return F.lower(F.trim(text))


def _months() -> Column:
    return F.array(*[F.lit(name) for name in MONTHS])


def month_number(text: Column) -> Column:
    """1–12 for a month name in any case or padding, NULL for anything else."""
    return F.nullif(F.array_position(_months(), normalise(text)), F.lit(0)).cast("int")


def month_name(number: Column) -> Column:
    return F.try_element_at(_months(), number)


def month_start(year: int | Column, text: Column) -> Column:
    """First day of the named month; NULL where the name is no month."""
    year = year if isinstance(year, Column) else F.lit(year)
    return F.make_date(year, month_number(text), F.lit(1))


def short_text(value: Column, length: int = 20) -> Column:
    """Any scalar as text of at most ``length`` characters."""
    return F.substring(value.cast("string"), 1, length)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))
