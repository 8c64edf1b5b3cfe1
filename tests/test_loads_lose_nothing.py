"""Loads account for every row, and reports keep to what they were asked for."""

import datetime
import json
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_sources_and_imports import bank
from test_store_and_chain import ledger, load  # noqa: F401

from ledger_spark import schemas
from ledger_spark.operators.spread import lookup_join
from ledger_spark.plans import charges as charging
from ledger_spark.plans import imports
from ledger_spark.sources import files

ACCOUNTS = "id_persona_cuenta string, id_persona string, cbu string"


def records(spark, tmp_path, *objects, name="r.json"):
    (tmp_path / name).write_text(json.dumps(list(objects)))
    return files.read_monthly_expenses(spark, str(tmp_path / name))


def record(month="abril", **amounts):
    return {"Nombre del consorcio": "Rivera", "Mes": month} | amounts


def test_unknown_categories_are_lines(spark, tmp_path):
    found = records(spark, tmp_path, record(**{"SERVICIOS PUBLICOS-Gas": "900,00", "EXTRAORDINARIO-X": "5,00"}))
    accepted, rejected = imports.import_services(found, 2025)
    assert rows(accepted, "categoria", "detalle", "clase", "importe") == [
        ("EXTRAORDINARIO", "X", "extraordinario", Decimal("5.00")),
        ("SERVICIOS PUBLICOS", "Gas", "ordinario", Decimal("900.00")),
    ]
    assert rejected.count() == 0


def test_a_broken_file_is_rejected_with_its_text(spark, tmp_path):
    (tmp_path / "broken.json").write_text("[{oops")
    found = files.read_monthly_expenses(spark, str(tmp_path / "broken.json"))
    accepted, rejected = imports.import_services(found, 2025)
    assert accepted.count() == 0
    assert rows(rejected, "motivo", schemas.CORRUPT) == [("linea ilegible", "[{oops")]


def test_equal_keys_of_other_content_are_rejected(spark):
    accounts = spark.createDataFrame([("a1", "p1", "111")], ACCOUNTS)
    raw = bank(
        spark,
        (1, "01/04/2025", "111", "50,00"),
        (1, "01/04/2025", "222", "999,00"),
        (1, "01/04/2025", "222", "999,00"),
        (2, "99/04/2025", "111", "siete"),
    )
    accepted, rejected = imports.import_payments(raw, accounts)
    assert accepted.count() == 1
    told = rows(rejected, "id_pago", "motivo", "fecha_texto", "importe_texto")
    assert told == [(1, "clave repetida", None, None), (2, "fecha ilegible", "99/04/2025", "siete")]
    other = bank(spark, (1, "01/04/2025", "111", "70,00"), (3, "01/04/2025", "111", "1,00"))
    again = imports.import_payments(other, accounts, accepted)
    assert rows(again.accepted, "id_pago") == [(3,)]
    assert rows(again.rejected, "id_pago", "motivo") == [(1, "clave ya cargada")]


def test_late_lines_are_charged_and_totals_agree(spark, tmp_path):
    first = imports.import_services(records(spark, tmp_path, record(LIMPIEZA="1.000,00")), 2025).accepted
    charges = imports.generate_charges(first)
    late = records(spark, tmp_path, record(LIMPIEZA="7.000,00", SEGUROS="300,00"), name="late.json")
    accepted, rejected = imports.import_services(late, 2025, first)
    assert rows(rejected, "categoria", "valor", "motivo") == [("LIMPIEZA", "7000.00", "clave ya cargada")]
    lines = first.unionByName(accepted)
    assert imports.charge_reconciliation(lines, charges).count() == 1
    added = imports.generate_charges(lines, charges)
    assert rows(added, "id_expensa_consorcio", "total_ordinarios") == [
        ("rivera|2025-04|ajuste|1", Decimal("300.00"))
    ]
    charges = charges.unionByName(added)
    assert imports.charge_reconciliation(lines, charges).count() == 0
    assert imports.generate_charges(lines, charges).count() == 0


def test_rows_without_a_date_do_not_stop_the_monthly_results(spark):
    day = datetime.date(2025, 4, 1)
    units = spark.createDataFrame([("u", "b", Decimal("10.00"))], "id_uf string, id_consorcio string, porcentaje_de_prorrateo decimal(5,2)")
    charged = spark.createDataFrame([("b", day, Decimal(100)), ("b", None, Decimal(7))], "id_consorcio string, mes date, total_ordinarios decimal(18,2)")
    charged = charged.withColumn("total_extraordinarios", F.lit(None).cast(schemas.MONEY))
    paid = spark.createDataFrame([("a", day, Decimal(4)), ("a", None, Decimal(2))], "id_persona_cuenta string, fecha_de_pago date, importe decimal(18,2)")
    accounts = spark.createDataFrame([("a", "p", "1")], ACCOUNTS)
    people = spark.createDataFrame([("u", "p")], "id_uf string, id_persona string")
    assert rows(charging.unit_charges(units, charged), "cargo") == [(Decimal("10.00"),)]
    statement = charging.unit_statement(units, charged, paid, accounts, people)
    assert rows(statement, "saldo_final") == [(Decimal("6.00"),)]
    assert rows(charging.undated(charged, paid)) == [("expensas", 1, Decimal(7)), ("pagos", 1, Decimal(2))]


def test_documents_keep_their_letter(spark):
    people = [("a", "b", d, None, None, str(i), "0") for i, d in enumerate(["M11", "f 11", "1.1-1", "x?"])]
    raw = spark.createDataFrame(people, schemas.PERSON_FILE)
    accepted, rejected = imports.import_people(raw)
    assert rows(accepted, "id_persona") == [("111",), ("F11",), ("M11",)]
    assert rows(rejected, "motivo") == [("documento ilegible",)]


def test_quotes_loaded_twice_are_there_once(spark):
    raw = spark.createDataFrame([("usd", "01/05/2025", "1,00", "2,00"), ("usd", "01/05/2025", "1,00", "3,00")], schemas.QUOTE_FILE)
    first = imports.import_quotes(raw, 1).accepted
    assert first.count() == 2
    assert imports.import_quotes(raw, 1, first).accepted.count() == 0
    assert rows(imports.quotes_latest(first), "venta") == [(Decimal("3.00"),)]


def test_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "p.csv").write_text("apellido|nombre|dni|email|telefono|cbu|es_inquilino\nperez|ana|11|||1|0\n")
    with pytest.raises(Exception, match="CSV header"):
        files.read_delimited(spark, str(tmp_path / "p.csv"), schemas.PERSON_FILE).collect()


def test_a_statement_shows_months_but_counts_all(ledger):  # noqa: F811
    load(ledger)
    whole = {(r.id_uf, r.mes): r for r in ledger("unit-statement").collect()}
    shown = ledger("unit-statement", "--since", "2025-05-01").collect()
    assert shown and all(r.mes >= datetime.date(2025, 5, 1) for r in shown)
    assert all(whole[r.id_uf, r.mes] == r for r in shown)


def test_options_of_other_steps_are_refused(ledger):  # noqa: F811
    with pytest.raises(SystemExit):
        ledger("top-delinquent-owners", "--cutoff", "2025-05-31", "--since", "2025-04-01")
    with pytest.raises(SystemExit):
        ledger("unit-statement", "--year", "2024")


def test_the_step_that_reconciles(ledger):  # noqa: F811
    load(ledger)
    assert ledger("charge-reconciliation").count() == 0
    assert ledger("undated").count() == 0


def test_a_hot_key_of_another_type_is_split(spark):
    left = spark.range(1000).select((F.col("id") % 3).cast("int").alias("k"))
    lookup = spark.range(3).select(F.col("id").alias("k")).groupBy("k").count()
    joined = lookup_join(left, lookup, "k")
    assert joined.count() == 1000
    assert "_digest" in joined._jdf.queryExecution().toString()
