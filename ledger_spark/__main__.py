"""Run one step of the ledger: ``spark-submit ... -m ledger_spark <step> --root DIR``."""

from __future__ import annotations

import argparse
import datetime
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ledger_spark.operators.protect import (
    PERSONAL_COLUMNS,
    decrypt_columns,
    encrypt_columns,
    protected_owners,
)
from ledger_spark.plans import monthly
from ledger_spark.plans.cash_flow import weekly_cash_flow
from ledger_spark.plans.charges import undated, unit_statement
from ledger_spark.plans.collections import collections_month_dept, collections_type_period
from ledger_spark.plans.delinquency import top_delinquent_owners
from ledger_spark.plans.imports import charge_reconciliation
from ledger_spark.plans.intervals import payment_intervals
from ledger_spark.plans.rankings import top5_expense_income
from ledger_spark.session import SETTINGS
from ledger_spark.sources.store import LedgerStore
from ledger_spark.tables import LedgerTables

LOADS = {
    "load-roster": lambda store, a: monthly.load_roster(store, a.file),
    "load-units": lambda store, a: monthly.load_units(store, a.file),
    "load-people": lambda store, a: monthly.load_people(store, a.file, a.roster),
    "load-suppliers": lambda store, a: monthly.load_suppliers(store, a.file),
    "load-services": lambda store, a: monthly.load_services(
        store, a.file, a.year, a.json_lines, a.repeated, a.large
    ),
    "load-payments": lambda store, a: monthly.load_payments(store, a.file),
    "load-quotes": lambda store, a: monthly.load_quotes(store, a.file, a.sequence),
    "rematch-payments": lambda store, a: monthly.rematch_payments(store),
    "generate-charges": lambda store, a: monthly.generate_charges(store),
}


def _key(args: argparse.Namespace) -> str:
    return Path(args.key_file).read_text().strip()


def _delinquent(tables: LedgerTables, a: argparse.Namespace) -> DataFrame:
    """The report, with digests of the personal columns where an audience is named that may not
    read them."""
    report = top_delinquent_owners(
        tables, a.cutoff, a.building, a.extra, a.periods, a.top or 3, a.dedup
    )
    if not a.audience:
        return report
    pepper = Path(a.pepper_file).read_text().strip()
    return protected_owners(report, a.audience, a.clear.split(","), pepper)


REPORTS = {
    "top-delinquent-owners": _delinquent,
    "weekly-cash-flow": lambda t, a: weekly_cash_flow(t, a.since, a.until, a.building),
    "collections-month-dept": lambda t, a: collections_month_dept(
        t, a.year, a.departments.split(","), a.building
    ),
    "collections-type-period": lambda t, a: collections_type_period(t),
    "top5-expense-income": lambda t, a: top5_expense_income(t.expense_lines, t.payments, a.top or 5),
    "payment-intervals": lambda t, a: payment_intervals(t),
    "protected-owners": lambda t, a: protected_owners(
        t.people, a.audience, a.clear.split(","), Path(a.pepper_file).read_text().strip()
    ),
    "encrypted-owners": lambda t, a: encrypt_columns(t.people, PERSONAL_COLUMNS, _key(a)),
    "decrypted-owners": lambda t, a: decrypt_columns(
        t.people.sparkSession.read.schema(t.people.schema).parquet(a.file),
        PERSONAL_COLUMNS,
        _key(a),
    ),
    "unit-statement": lambda t, a: unit_statement(
        t.units, t.charges, t.payments, t.accounts, t.unit_people, since=a.since, until=a.until
    ),
    "charge-reconciliation": lambda t, a: charge_reconciliation(t.expense_lines, t.charges),
    "undated": lambda t, a: undated(t.charges, t.payments),
}

# Options of each step besides --root; reports also take --out.
OPTIONS = {
    "load-roster": ["file"],
    "load-units": ["file"],
    "load-people": ["file", "roster"],
    "load-suppliers": ["file"],
    "load-services": ["file", "year", "json_lines", "repeated", "large"],
    "load-payments": ["file"],
    "load-quotes": ["file", "sequence"],
    "top-delinquent-owners": [
        "cutoff", "building", "extra", "periods", "top", "dedup", "audience", "clear", "pepper_file"
    ],
    "encrypted-owners": ["key_file"],
    "decrypted-owners": ["file", "key_file"],
    "weekly-cash-flow": ["since", "until", "building"],
    "collections-month-dept": ["year", "departments", "building"],
    "top5-expense-income": ["top"],
    "protected-owners": ["audience", "clear", "pepper_file"],
    "unit-statement": ["since", "until"],
}


def _tables(store: LedgerStore, args: argparse.Namespace) -> LedgerTables:
    """The tables, with the payments that the report counts; a statement counts all."""
    since = until = None
    if args.step == "top-delinquent-owners":
        until = args.cutoff
    elif args.step == "weekly-cash-flow":
        since, until = args.since, args.until
    elif args.step == "collections-month-dept" and args.year:
        since, until = datetime.date(args.year, 1, 1), datetime.date(args.year, 12, 31)
    return store.tables(since, until)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledger_spark")
    parser.add_argument("step", choices=[*LOADS, *REPORTS])
    parser.add_argument("--root", required=True, help="folder of the ledger tables")
    parser.add_argument("--file", help="file, folder or glob to load")
    parser.add_argument("--roster", help="unit roster, for load-people")
    parser.add_argument("--json-lines", action="store_true")
    parser.add_argument("--large", action="store_true", help="read an array by many tasks")
    parser.add_argument("--repeated", choices=["keep_last", "reject"], default="keep_last")
    parser.add_argument("--out", help="folder to write the report to; shown when absent")
    parser.add_argument("--year", type=int)
    parser.add_argument("--departments", default="A,B,C,D,E")
    parser.add_argument("--building")
    parser.add_argument("--periods")
    parser.add_argument("--extra", action="store_true", help="include extraordinary expenses")
    parser.add_argument("--dedup", action="store_true")
    parser.add_argument("--top", type=int)
    parser.add_argument("--sequence", type=int, help="load number, for load-quotes")
    parser.add_argument("--audience", default="", help="who will read the people or the report")
    parser.add_argument("--clear", default="", help="audiences that may read personal data")
    parser.add_argument("--key-file", help="file with the key of the encryption")
    parser.add_argument("--pepper-file", help="file with the secret of the digests")
    for date in ("--cutoff", "--since", "--until"):
        parser.add_argument(date, type=datetime.date.fromisoformat)
    return parser


def run(spark: SparkSession, arguments: list[str] | None = None) -> DataFrame | None:
    parser = _parser()
    args = parser.parse_args(arguments)
    allowed = {"step", "root", *OPTIONS.get(args.step, []), *(["out"] if args.step in REPORTS else [])}
    for name, value in vars(args).items():
        if name not in allowed and value != parser.get_default(name):
            parser.error(f"{args.step} has no --{name.replace('_', '-')}")
    store = LedgerStore(spark, args.root)
    if args.step in LOADS:
        LOADS[args.step](store, args)
        return None
    report = REPORTS[args.step](_tables(store, args), args)
    if args.out:
        report.write.mode("overwrite").parquet(args.out)
    return report


def main() -> None:
    builder = SparkSession.builder.appName("ledger_spark")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    report = run(spark)
    if report is not None and "--out" not in sys.argv:
        print("|".join(report.columns))
        for row in report.toLocalIterator():  # every row; one partition at a time
            print("|".join("" if value is None else str(value) for value in row))


if __name__ == "__main__":
    main()
