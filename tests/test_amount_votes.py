"""Amounts that follow the majority of their file, against plain Python."""

import random
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledger_spark.operators.amount_votes import AMBIGUOUS, UNREADABLE, amounts_by_vote

SCHEMA = "archivo string, texto string, n int"


def plain(rows):
    """Each text by its own shape; only one separator before three digits asks the file."""

    def shape(text):
        body = (text or "").strip()
        bare = body.removeprefix("-")
        if not re.fullmatch("[0-9][0-9.,]*", bare):
            return None, None, None
        parts = re.split("[.,]", bare)
        marks = re.findall("[.,]", bare)
        number = Decimal(("-" if body != bare else "") + "".join(parts))
        last = len(parts[-1])
        if not marks:
            return number, None, None
        if last in (1, 2):
            return number / 10**last, marks[-1], None
        fits = len(parts[0]) <= 3 and all(len(p) == 3 for p in parts[1:]) and len(set(marks)) == 1
        if fits and len(marks) > 1:
            return number, None, None
        return (number if fits else None), None, marks[0] if fits else None

    votes = Counter()
    for file, text, _ in rows:
        votes[file, shape(text)[1]] += 1
    out = {}
    for file, text, n in rows:
        amount, _, asks = shape(text)
        comma, point = votes[file, ","], votes[file, "."]
        reason = None if amount is not None else UNREADABLE
        if asks and not (comma > point if asks == "." else point > comma):
            amount, reason = None, AMBIGUOUS
        out[n] = (amount, reason, comma, point)
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = amounts_by_vote(df, "texto", ["archivo"])
    assert got.columns == [*df.columns, "importe", "motivo", "votos_coma", "votos_punto"]
    found = {r["n"]: (r["importe"], r["motivo"], r["votos_coma"], r["votos_punto"]) for r in got.collect()}
    assert found == plain(rows)
    return found


def test_every_shape(spark):
    texts = ["1.234", "1,234", "12", "-7", "1.234,56", "1,234.56", "345,678,90", "12,5", "1.234.567", "1,234,567"]
    texts += ["1.234,567", "12.3456", "1234.567", "", None, "abc", "1,,2", " 2.500 ", "-1.000", ".5", "0,50", "1.2.3"]
    files = {"a": "9,99", "b": "9.99", "c": None, None: "3,10"}
    rows = [(f, t, 0) for f, vote in files.items() for t in [*texts, *[vote] * 9]]
    rows = [(f, t, n) for n, (f, t, _) in enumerate(rows)]
    found = check(spark, rows)
    first = {f: next(n for g, t, n in rows if g == f and t == "1.234") for f in files}
    assert found[first["a"]][0] == 1234 and found[first["b"]][1] == AMBIGUOUS
    assert found[first[None]][0] == 1234


def test_a_tie_and_no_vote_are_no_majority(spark):
    found = check(spark, [("a", "1,10", 0), ("a", "1.10", 1), ("a", "1.234", 2), ("b", "1.234", 3), ("b", "12", 4)])
    assert found[2][1] == found[3][1] == AMBIGUOUS and found[4][0] == 12


def test_random_files(spark):
    pick = random.Random(5)
    alphabet = ["1", "23", "456", "78", ".", ",", "-", " "]
    rows = [
        (pick.choice("abc"), "".join(pick.choices(alphabet, k=pick.randint(1, 6))).strip(), n)
        for n in range(3000)
    ]
    check(spark, rows)


@pytest.mark.parametrize("text", ["9" * 30, "9" * 30 + ",50", "9" * 17])
def test_amounts_too_large_are_unreadable(spark, text):
    row = amounts_by_vote(spark.createDataFrame([("a", text, 1)], SCHEMA), "texto", ["archivo"]).first()
    assert row["importe"] is None and row["motivo"] == UNREADABLE


def test_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert amounts_by_vote(none, "texto", ["archivo"]).collect() == []


def test_one_file_of_most_rows_is_counted_before_the_exchange(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("archivo"),
        F.lit("1,50").alias("texto"),
        F.col("id").cast("int").alias("n"),
    )
    read = amounts_by_vote(df, "texto", ["archivo"])
    assert read.where("importe = 1.5").count() == 1000
    plan = read._jdf.queryExecution().toString()
    assert "partial_count" in plan and "Python" not in plan
