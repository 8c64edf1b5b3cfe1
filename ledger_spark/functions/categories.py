"""Expense category expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDINARY = "ordinario"
EXTRAORDINARY = "extraordinario"

# Fixed value: label prefix of extraordinary expenses.
EXTRAORDINARY_PREFIX = "EXTRAORDINARIO"


def category_name(label: Column) -> Column:
    """``SERVICIOS PUBLICOS-Agua`` → ``SERVICIOS PUBLICOS``."""
    return F.trim(F.split(label, "-", 2)[0])


def category_detail(label: Column) -> Column:
    """``SERVICIOS PUBLICOS-Agua`` → ``Agua``; NULL without a dash."""
    return F.trim(F.try_element_at(F.split(label, "-", 2), F.lit(2)))


def expense_class(label: Column) -> Column:
    return F.when(label.startswith(EXTRAORDINARY_PREFIX), EXTRAORDINARY).otherwise(ORDINARY)
