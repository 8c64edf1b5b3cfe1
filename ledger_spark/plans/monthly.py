"""The monthly chain over stored tables: load the files, match payments, charge.

Every step can be repeated: rows stored already are not added again, and a step that was cut off has
changed nothing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledger_spark import schemas
from ledger_spark.operators.quality import Split
from ledger_spark.operators.upsert import replace_rows
from ledger_spark.plans import imports
from ledger_spark.sources.files import read_delimited, read_monthly_expenses, read_roster
from ledger_spark.sources.store import PENDING, LedgerStore


def _save(store: LedgerStore, name: str, result: Split) -> None:
    store.write(name, result.accepted)
    store.write_rejected(name, result.rejected)


def load_roster(store: LedgerStore, path) -> None:
    """Buildings of the unit roster, and its units where they are not known yet."""
    with store.load("roster", read_roster(store.spark, path)) as [roster]:
        names = roster.select(F.col("consorcio").alias("nombre"))
        _save(store, "consorcio", imports.import_buildings(names, store.read("consorcio")))
        units = imports.import_units(roster, store.read("unidad_funcional"))
        _save(store, "unidad_funcional", units)


def load_units(store: LedgerStore, path) -> None:
    """Units with their percentages, from a delimited export; known units are updated."""
    with store.load("units", read_delimited(store.spark, path, schemas.UNIT_FILE)) as [raw]:
        names = raw.select(F.col("consorcio").alias("nombre"))
        _save(store, "consorcio", imports.import_buildings(names, store.read("consorcio")))
        accepted, rejected = imports.import_units(raw)
        units = replace_rows(store.read("unidad_funcional"), accepted, ["id_uf"])
        store.write("unidad_funcional", units, mode="overwrite")
        store.write_rejected("unidad_funcional", rejected)


def load_people(store: LedgerStore, people_path, roster_path) -> None:
    """People, their accounts, and which unit each account stands for."""
    files = [
        read_delimited(store.spark, people_path, schemas.PERSON_FILE),
        read_roster(store.spark, roster_path),
    ]
    with store.load("people", *files) as [raw, roster]:
        _save(store, "persona", imports.import_people(raw, store.read("persona")))
        _save(store, "persona_cuenta", imports.import_accounts(raw, store.read("persona_cuenta")))
        links = imports.import_unit_people(
            roster,
            store.read("persona_cuenta"),
            store.read("unidad_funcional"),
            store.read("uf_persona"),
        )
        _save(store, "uf_persona", links)


def load_suppliers(store: LedgerStore, path) -> None:
    with store.load("suppliers", read_delimited(store.spark, path, schemas.SUPPLIER)) as [raw]:
        _save(store, "proveedor", imports.import_suppliers(raw, store.read("proveedor")))


def load_services(
    store: LedgerStore,
    path,
    year: int,
    json_lines: bool = False,
    repeated: str = "keep_last",
    large: bool = False,
) -> None:
    """Monthly expense records of one year."""
    records = read_monthly_expenses(store.spark, path, json_lines, large)
    with store.load(f"services-{year}", records) as [raw]:
        result = imports.import_services(raw, year, store.read("gasto"), repeated)
        _save(store, "gasto", result)


def load_payments(store: LedgerStore, path) -> None:
    """Bank payments; those of unknown accounts are kept to be matched again."""
    with store.load("payments", read_delimited(store.spark, path, schemas.PAYMENT_FILE)) as [raw]:
        accounts, known = store.read("persona_cuenta"), store.read("pago")
        _save(store, "pago", imports.import_payments(raw, accounts, known))


def load_quotes(store: LedgerStore, path, sequence: int) -> None:
    quotes = read_delimited(store.spark, path, schemas.QUOTE_FILE)
    with store.load(f"quotes-{sequence}", quotes) as [raw]:
        _save(store, "cotizacion", imports.import_quotes(raw, sequence, store.read("cotizacion")))


def rematch_payments(store: LedgerStore) -> None:
    """Match the payments without an account again; only they are read and moved."""
    accounts = store.read("persona_cuenta")
    found = imports.match_payments(store.read(PENDING), accounts)
    with store.load("rematch", found) as [matched]:
        known = F.col("id_persona_cuenta").isNotNull()
        if not matched.where(known).isEmpty():
            store.write(PENDING, matched.where(~known), mode="overwrite")
            store.write("pago", matched.where(known), staged=True)


def generate_charges(store: LedgerStore) -> None:
    """Charge what the expense lines add to the charges made so far."""
    fresh = imports.generate_charges(store.read("gasto"), store.read("expensa_consorcio"))
    store.write("expensa_consorcio", fresh)
