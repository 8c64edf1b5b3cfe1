import datetime
import json
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledger_spark import schemas
from ledger_spark.operators import reshape
from ledger_spark.operators.quality import duplicate_keys, split_rejects
from ledger_spark.operators.upsert import idempotent_upsert, keep_latest
from ledger_spark.plans import imports
from ledger_spark.sources import files

ROSTER = """CVU/CBU|Nombre del consorcio|nroUnidadFuncional|piso|departamento
1111111111111111111111|Rivera|1|PB|A
2222222222222222222222|Rivera|2|PB|B
3333333333333333333333|Los Tilos|1|1|A
4444444444444444444444|Los Tilos|x|1|B
|Los Tilos|3|2|C
"""

RECORDS = [
    {
        "_id": {"$oid": "a1"},
        "Nombre del consorcio": "Rivera",
        "Mes": "abril",
        "BANCARIOS": "1,500.25",
        "LIMPIEZA": "2.000,50",
        "SERVICIOS PUBLICOS-Agua": "345,678,90",
    },
    {
        "Nombre del consorcio": "Rivera ",
        "Mes": "mayo ",
        "LIMPIEZA": "10,00",
        "EXTRAORDINARIO-Obras": "70.000,00",
        "SEGUROS": "roto",
    },
    {"_id": {"$oid": "a3"}},
    {"Nombre del consorcio": "Rivera", "Mes": "ABRIL", "LIMPIEZA": "3.000,00"},
]


@pytest.fixture
def roster_path(tmp_path):
    path = tmp_path / "roster.csv"
    path.write_text(ROSTER)
    return str(path)


@pytest.fixture
def records_path(tmp_path):
    path = tmp_path / "expenses.json"
    path.write_text(json.dumps(RECORDS, indent=2))
    return str(path)


def test_roster_is_typed_and_keeps_long_account_numbers(spark, roster_path):
    roster = files.read_roster(spark, roster_path)
    assert roster.columns[:5] == ["cbu", "consorcio", "numero", "piso", "departamento"]
    good = roster.where(F.col("numero").isNotNull())
    assert rows(good, "cbu", "consorcio", "numero")[1] == ("1111111111111111111111", "Rivera", 1)
    bad = roster.where(F.col("numero").isNull()).select(schemas.CORRUPT).collect()
    assert [r[0] for r in bad] == ["4444444444444444444444|Los Tilos|x|1|B"]


def test_roster_lines_read_like_the_file(spark, roster_path):
    lines = spark.createDataFrame([(line,) for line in ROSTER.splitlines()[1:4]], "linea string")
    parsed = files.parse_roster_lines(lines)
    from_file = files.read_roster(spark, roster_path).drop(schemas.CORRUPT)
    assert set(rows(parsed)) <= set(rows(from_file))


def test_roster_dimensions(spark, roster_path):
    roster = files.read_roster(spark, roster_path)
    assert rows(reshape.roster_buildings(roster)) == [("Los Tilos",), ("Rivera",)]
    assert reshape.roster_units(roster).count() == 5
    assert reshape.roster_accounts(roster).count() == 4


@pytest.mark.parametrize("json_lines", [False, True])
def test_monthly_records(spark, tmp_path, records_path, json_lines):
    if json_lines:
        path = tmp_path / "lines.json"
        path.write_text("\n".join(json.dumps(r) for r in RECORDS))
        records_path = str(path)
    records = files.read_monthly_expenses(spark, records_path, json_lines)
    ordered = records.orderBy("posicion").select("oid", "consorcio", "periodo", F.col("rubros")["LIMPIEZA"]).collect()
    assert [tuple(r) for r in ordered] == [
        ("a1", "Rivera", "abril", "2.000,50"),
        (None, "Rivera ", "mayo ", "10,00"),
        ("a3", None, None, None),
        (None, "Rivera", "ABRIL", "3.000,00"),
    ]


def test_services_keep_the_last_record_and_report_the_rest(spark, records_path):
    records = files.read_monthly_expenses(spark, records_path)
    accepted, rejected = imports.import_services(records, 2025)
    got = rows(accepted, F.col("mes").cast("string"), "categoria", "detalle", "clase", "importe")
    assert got == [
        ("2025-04-01", "LIMPIEZA", None, "ordinario", Decimal("3000.00")),
        ("2025-05-01", "EXTRAORDINARIO", "Obras", "extraordinario", Decimal("70000.00")),
        ("2025-05-01", "LIMPIEZA", None, "ordinario", Decimal("10.00")),
    ]
    assert rows(rejected, "motivo", "valor") == [
        ("importe ilegible", "roto"),
        ("registro reemplazado", None),
        ("sin consorcio", None),
    ]
    again = imports.import_services(records, 2025, accepted)
    assert again.accepted.count() == 0


def test_services_may_reject_repeated_months(spark, records_path):
    records = files.read_monthly_expenses(spark, records_path)
    accepted, rejected = imports.import_services(records, 2025, repeated="reject")
    assert rows(accepted, "categoria") == [("EXTRAORDINARIO",), ("LIMPIEZA",)]
    assert rows(rejected.groupBy("motivo").count()) == [
        ("importe ilegible", 1),
        ("registro repetido", 2),
        ("sin consorcio", 1),
    ]
    with pytest.raises(ValueError):
        imports.import_services(records, 2025, repeated="other")


def test_duplicate_records_are_reported(spark, records_path):
    records = files.read_monthly_expenses(spark, records_path)
    keyed = records.withColumn("periodo", F.lower(F.trim("periodo")))
    complete = keyed.where(F.col("consorcio").isNotNull())
    assert rows(duplicate_keys(complete, ["consorcio", "periodo"])) == [("Rivera", "abril", 2)]


def test_long_lines_sum_to_the_wide_record(spark):
    wide = spark.createDataFrame([(1, 10, None, 5), (2, 1, 2, 3)], "id int, a int, b int, c int")
    long = reshape.wide_to_long(wide, ["id"], ["a", "b", "c", "absent"])
    assert rows(long.groupBy("id").agg(F.sum("valor"), F.count("*"))) == [(1, 15, 2), (2, 6, 3)]


def test_lots_with_different_columns(spark):
    both = reshape.combine_lots(
        spark.createDataFrame([(1, "x")], "id int, a string"),
        spark.createDataFrame([(2, "y")], "id int, b string"),
    )
    assert rows(both, "id", "a", "b") == [(1, "x", None), (2, None, "y")]


def test_split_rejects_names_the_first_broken_rule(spark):
    df = spark.createDataFrame([(1, 5), (None, 0), (2, None)], "id int, v int")
    accepted, rejected = split_rejects(df, {"no id": F.col("id").isNotNull(), "low": F.col("v") > 1})
    assert rows(accepted) == [(1, 5)]
    assert rows(rejected) == [(None, 0, "no id"), (2, None, "low")]


def test_keep_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, "y")], "k string, n int, v string")
    assert rows(keep_latest(df, ["k"], "n")) == [("a", 3, "z"), ("b", 2, "y")]


def test_upsert_is_idempotent(spark):
    stored = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], "k string, seq int, v string")
    lot = spark.createDataFrame([("b", 2, "new"), ("c", 1, "new")], "k string, seq int, v string")
    for mode, b in (("keep_existing", ("b", 1, "old")), ("newest_wins", ("b", 2, "new"))):
        once = idempotent_upsert(stored, lot, ["k"], mode, "seq")
        assert rows(once) == [("a", 1, "old"), b, ("c", 1, "new")]
        assert rows(idempotent_upsert(once, lot, ["k"], mode, "seq")) == rows(once)
    with pytest.raises(ValueError):
        idempotent_upsert(stored, lot, ["k"], "other")
    with pytest.raises(ValueError):
        idempotent_upsert(stored, lot, ["k"], "newest_wins")


def test_null_keys_are_loaded_once(spark):
    stored = spark.createDataFrame([("a", None)], "k string, d string")
    assert imports.new_rows(stored, stored, ["k", "d"]).count() == 0


PEOPLE = [
    (" ana ", "PEREZ", "11.111.111", "Ana@Example.org ", "55501", "1111111111111111111111", "0"),
    ("Ana", "Perez", "11111111", "ana@example.org", "55501", "1111111111111111111111", "0"),
    ("Leo", "Gomez", "22222222", None, "", "3333333333333333333333", "1"),
    ("Sin", "Documento", " ", None, None, None, "0"),
    ("Tipo", "Raro", "33", None, None, None, "quizas"),
]


def test_people(spark):
    raw = spark.createDataFrame(PEOPLE, schemas.PERSON_FILE)
    accepted, rejected = imports.import_people(raw)
    assert rows(accepted, "id_persona", "nombre", "apellido", "email", "telefono", "es_inquilino") == [
        ("11111111", "Ana", "Perez", "ana@example.org", "55501", 0),
        ("22222222", "Leo", "Gomez", None, None, 1),
    ]
    assert rows(rejected, "motivo") == [("sin documento",), ("tipo de persona",)]


def test_unit_links(spark, roster_path):
    roster = files.read_roster(spark, roster_path)
    units, bad_units = imports.import_units(roster)
    line = "4444444444444444444444|Los Tilos|x|1|B"
    assert rows(bad_units, "motivo", schemas.CORRUPT) == [("linea ilegible", line)]
    accounts = imports.import_accounts(spark.createDataFrame(PEOPLE, schemas.PERSON_FILE)).accepted
    links, rejected = imports.import_unit_people(roster, accounts, units)
    assert rows(links) == [("los tilos|1", "22222222"), ("rivera|1", "11111111")]
    assert rows(rejected, "motivo") == [
        ("cuenta desconocida",),
        ("cuenta desconocida",),
        ("linea ilegible",),
    ]


def test_unit_percentages_and_suppliers(spark):
    raw = spark.createDataFrame(
        [
            ("Rivera", 1, "PB", "a", "3,25"),
            ("Rivera", 2, " ", "b", None),
            ("Rivera", 3, "1", "c", "mucho"),
            ("Rivera", 4, "1", "d", "5.000,00"),
        ],
        schemas.UNIT_FILE,
    )
    units, unreadable = imports.import_units(raw)
    assert rows(unreadable, "numero", "motivo") == [
        (3, "porcentaje ilegible"),
        (4, "porcentaje ilegible"),
    ]
    assert rows(units, "id_uf", "piso", "departamento", "porcentaje_de_prorrateo") == [
        ("rivera|1", "PB", "A", Decimal("3.25")),
        ("rivera|2", None, "B", None),
    ]
    suppliers = spark.createDataFrame([("luz sa ", "luz", "Rivera"), ("", "x", "y")], schemas.SUPPLIER)
    accepted, rejected = imports.import_suppliers(suppliers)
    assert rows(accepted) == [("LUZ SA", "luz", "rivera")] and rejected.count() == 1


def bank(spark, *lines):
    return spark.createDataFrame(list(lines), schemas.PAYMENT_FILE)


def test_payments_are_matched_kept_and_rematched(spark):
    accounts = spark.createDataFrame(
        [("a1", "p1", "111"), ("a2", "p1", "111"), ("a3", "p3", "333")],
        "id_persona_cuenta string, id_persona string, cbu string",
    )
    raw = bank(
        spark,
        (1, "01/04/2025", "111", "1.500,00"),
        (1, "01/04/2025", "111", "1.500,00"),
        (2, "02/04/2025", "222", "10,00"),
        (3, "31/02/2025", "111", "10,00"),
        (4, "03/04/2025", None, "7,00"),
        (5, "03/04/2025", "111", "siete"),
    )
    early = accounts.where("cbu <> '333'")
    accepted, rejected = imports.import_payments(raw, early)
    assert rows(accepted, "id_pago", "importe", "estado") == [
        (1, Decimal("1500.00"), "asociado"),
        (2, Decimal("10.00"), "no asociado"),
        (4, Decimal("7.00"), "no asociado"),
    ]
    assert rows(rejected, "id_pago", "motivo") == [(3, "fecha ilegible"), (5, "importe ilegible")]
    later = accounts.union(spark.createDataFrame([("a9", "p9", "222")], accounts.schema))
    again = imports.rematch_payments(accepted, later)
    assert rows(again, "id_pago", "id_persona_cuenta", "estado") == [
        (1, "a2", "asociado"),
        (2, "a9", "asociado"),
        (4, None, "no asociado"),
    ]


def test_quotes_latest(spark):
    day = datetime.date(2025, 5, 1)
    quotes = spark.createDataFrame(
        [("USD", day, None, None, 1), ("USD", day, None, None, 4), ("EUR", day, None, None, 2)],
        schemas.QUOTE,
    )
    assert rows(imports.quotes_latest(quotes), "moneda", "secuencia") == [("EUR", 2), ("USD", 4)]


def test_quotes_of_two_loads(spark):
    first = spark.createDataFrame(
        [("usd", "01/05/2025", "1.150,00", "1.170,50"), ("usd", "mal", None, "1,00")], schemas.QUOTE_FILE
    )
    second = spark.createDataFrame([("USD", "01/05/2025", None, "1.180,00")], schemas.QUOTE_FILE)
    loads = [imports.import_quotes(raw, i) for i, raw in enumerate((first, second))]
    assert rows(loads[0].rejected, "motivo") == [("fecha ilegible",)]
    both = loads[0].accepted.unionByName(loads[1].accepted)
    assert rows(imports.quotes_latest(both), "moneda", "venta") == [("USD", Decimal("1180.00"))]


def test_a_short_line_is_rejected_with_its_text(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("nombre|apellido|dni|email|telefono|cbu|es_inquilino\nana|perez|11|||1|0\nleo|gomez\n")
    raw = files.read_delimited(spark, str(path), schemas.PERSON_FILE)
    accepted, rejected = imports.import_people(raw)
    assert rows(accepted, "dni") == [("11",)]
    assert rows(rejected, "motivo", schemas.CORRUPT) == [("linea ilegible", "leo|gomez")]
