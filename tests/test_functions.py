from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledger_spark.functions.amounts import at_least_zero, or_zero, parse_amount, parse_percent
from ledger_spark.functions.categories import category_detail, category_name, expense_class
from ledger_spark.functions.text import (
    MONTHS,
    blank_to_null,
    month_name,
    month_number,
    month_start,
    normalise,
    short_text,
)


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in sorted(df.select("i", expression(F.col("t"))).collect())]


def styles(cents: int) -> list[str]:
    english = f"{cents // 100:,}.{cents % 100:02d}"
    return [
        english,
        english.translate(str.maketrans(",.", ".,")),
        english.replace(".", ","),
        english.replace(",", "").replace(".", ","),
    ]


def test_amounts_of_every_style(spark):
    texts = ["1,234.56", "7.890,12", "345,678,90", "0,00", " 1.5,25 ", "1234567.89"]
    want = ["1234.56", "7890.12", "345678.90", "0.00", "15.25", "1234567.89"]
    assert values(spark, texts, parse_amount) == [Decimal(w) for w in want]


def test_other_text_is_no_amount(spark):
    texts = ["", "abc", "12", "1.234", "1,2", ",00", "1,00x", None, "9" * 30 + ",00"]
    assert values(spark, texts, parse_amount) == [None] * len(texts)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=10**16), min_size=1, max_size=40))
def test_formatted_amounts_read_back(spark, cents):
    texts = [text for c in cents for text in styles(c)]
    want = [Decimal(c).scaleb(-2) for c in cents for _ in range(4)]
    assert values(spark, texts, parse_amount) == want


def test_months(spark):
    texts = ["mayo ", " MAYO", "Septiembre", "may", "", None]
    assert values(spark, texts, month_number) == [5, 5, 9, None, None, None]
    starts = values(spark, texts, lambda c: month_start(2025, c))
    assert [str(s) for s in starts] == ["2025-05-01"] * 2 + ["2025-09-01"] + ["None"] * 3
    assert values(spark, MONTHS, lambda c: month_name(month_number(c))) == MONTHS


def test_percentages(spark):
    texts = ["4,5", "10", "3.25 %", "100,00", "7.", "mucho", "5.000,00", "1,234", "-1", "", None]
    want = [Decimal(x) for x in ("4.5", "10", "3.25", "100", "7")] + [None] * 6
    assert values(spark, texts, parse_percent) == want


def test_normalise_strips_blanks_only(spark):
    assert values(spark, [" Abril ", "\tabril"], normalise) == ["abril", "\tabril"]


def test_defaults_and_clamp(spark):
    amount = lambda e: values(spark, [None, "0", "-1.5", "2"], lambda c: e(c.cast("decimal(18,2)")))
    assert amount(or_zero) == [0, 0, Decimal("-1.5"), 2]
    assert amount(at_least_zero) == [0, 0, 0, 2]


def test_money_rounds_half_away_from_zero(spark):
    rounded = values(spark, ["0.125", "-0.125"], lambda c: c.cast("decimal(9,3)").cast("decimal(18,2)"))
    assert rounded == [Decimal("0.13"), Decimal("-0.13")]


def test_text_helpers(spark):
    assert values(spark, ["x" * 30], short_text) == ["x" * 20]
    assert values(spark, [" ", " a "], blank_to_null) == [None, "a"]


@pytest.mark.parametrize(
    "label, want",
    [
        ("SERVICIOS PUBLICOS-Agua", ("SERVICIOS PUBLICOS", "Agua", "ordinario")),
        ("EXTRAORDINARIO-Obras", ("EXTRAORDINARIO", "Obras", "extraordinario")),
        ("LIMPIEZA", ("LIMPIEZA", None, "ordinario")),
    ],
)
def test_categories(spark, label, want):
    got = tuple(
        values(spark, [label], f)[0] for f in (category_name, category_detail, expense_class)
    )
    assert got == want
