import datetime
import hashlib
import json
from decimal import Decimal

import pytest
from conftest import rows

from ledger_spark.__main__ import run
from ledger_spark.plans import imports, monthly
from ledger_spark.session import shared_folder
from ledger_spark.sources.store import LedgerStore

UNITS = """consorcio|numero|piso|departamento|porcentaje
Rivera|1|PB|A|10,00
Rivera|2|PB|B|5.50
Los Tilos|1|1|A|20,00
"""
ROSTER = """CVU/CBU|Nombre del consorcio|nroUnidadFuncional|piso|departamento
111|Rivera|1|PB|A
222|Rivera|2|PB|B
333|Los Tilos|1|1|A
"""
PEOPLE = """nombre|apellido|dni|email|telefono|cbu|es_inquilino
ana|perez|11|ana@example.org|555|111|0
leo|gomez|22|||222|0
"""
LATE_PEOPLE = """nombre|apellido|dni|email|telefono|cbu|es_inquilino
eva|vidal|33|||333|0
"""
PAYMENTS = """id_pago|fecha|cbu_origen|importe
1|10/04/2025|111|50,00
2|12/05/2025|333|1.000,00
3|20/04/2025|999|7,00
4|99/04/2025|111|7,00
"""
RECORDS = [
    {"Nombre del consorcio": "Rivera", "Mes": "abril", "LIMPIEZA": "1.000,00", "EXTRAORDINARIO-Obras": "500,00"},
    {"Nombre del consorcio": "Los Tilos", "Mes": "mayo ", "SEGUROS": "10,000.00"},
    {"_id": {"$oid": "x"}},
]


@pytest.fixture
def ledger(spark, tmp_path):
    def step(name, *more):
        return run(spark, [name, "--root", str(tmp_path / "ledger"), *more])

    def file(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    step.file = file
    step.store = LedgerStore(spark, str(tmp_path / "ledger"))
    return step


def load(ledger):
    ledger("load-units", "--file", ledger.file("units.csv", UNITS))
    roster = ledger.file("roster.csv", ROSTER)
    ledger("load-roster", "--file", roster)
    ledger("load-people", "--file", ledger.file("people.csv", PEOPLE), "--roster", roster)
    ledger("load-services", "--file", ledger.file("s.json", json.dumps(RECORDS)), "--year", "2025")
    ledger("load-payments", "--file", ledger.file("payments.csv", PAYMENTS))
    ledger("generate-charges")
    return roster


def sizes(store):
    names = ["consorcio", "unidad_funcional", "persona", "persona_cuenta", "uf_persona", "gasto", "pago", "expensa_consorcio"]
    return [store.read(n).count() for n in names]


def test_chain_reports_and_rematch(ledger):
    roster = load(ledger)
    assert sizes(ledger.store) == [2, 3, 2, 2, 2, 3, 3, 2]
    top = ledger("top-delinquent-owners", "--cutoff", "2025-05-31", "--extra")
    assert [(r.apellido, float(r.DeudaEsperada), float(r.Morosidad)) for r in top.collect()] == [
        ("Perez", 150.0, 100.0),
        ("Gomez", 82.5, 82.5),
    ]

    late = ledger.file("late.csv", LATE_PEOPLE)
    ledger("load-people", "--file", late, "--roster", roster)
    ledger("rematch-payments")
    assert rows(ledger.store.read("pago"), "id_pago", "id_persona_cuenta", "estado") == [
        (1, "111", "asociado"),
        (2, "333", "asociado"),
        (3, None, "no asociado"),
    ]
    top = ledger("top-delinquent-owners", "--cutoff", "2025-05-31", "--top", "1")
    assert [(r.apellido, float(r.Pagos), float(r.Morosidad)) for r in top.collect()] == [
        ("Vidal", 1000.0, 1000.0)
    ]


def test_repeated_loads_add_nothing(ledger):
    load(ledger)
    before = sizes(ledger.store)
    load(ledger)
    assert sizes(ledger.store) == before


def test_every_report_runs(ledger, tmp_path):
    load(ledger)
    out = str(tmp_path / "out")
    assert ledger("weekly-cash-flow").count() == 3
    assert ledger("collections-month-dept", "--year", "2025", "--out", out).count() == 1
    assert ledger("collections-type-period").count() == 1
    assert ledger("top5-expense-income", "--top", "1").count() == 2
    assert ledger("payment-intervals").count() == 1
    assert ledger("unit-statement").count() == 3


def test_protected_report_and_encryption_steps(ledger, tmp_path):
    load(ledger)
    pepper, key = ledger.file("pepper", "p\n"), ledger.file("key", "0123456789abcdef\n")
    report = ["top-delinquent-owners", "--cutoff", "2025-05-31", "--pepper-file", pepper, "--clear", "general"]
    hidden = ledger(*report, "--audience", "reportes").collect()
    assert hashlib.sha256(b"p11").hexdigest() in [r.dni for r in hidden]
    assert "11" in [r.dni for r in ledger(*report, "--audience", "general").collect()]
    out = str(tmp_path / "encrypted")
    ledger("encrypted-owners", "--key-file", key, "--out", out)
    people = ledger.store.read("persona")
    assert not {r.dni for r in ledger.store.spark.read.parquet(out).collect()} & {"11", "22"}
    assert rows(ledger("decrypted-owners", "--file", out, "--key-file", key)) == rows(people)


def test_payments_read_only_the_months_asked_for(ledger):
    load(ledger)
    day = datetime.date(2025, 4, 30)
    april = ledger.store.payments(datetime.date(2025, 4, 1), day)
    assert rows(april, "id_pago", "importe") == [(1, Decimal("50.00")), (3, Decimal("7.00"))]
    plan = april._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mes_de_pago" in plan


def test_only_changed_months_are_rewritten(ledger):
    load(ledger)
    path = "/mes_de_pago=2025-04-01/"
    files = lambda: sorted(f for f in ledger.store.read("pago").inputFiles() if path in f)
    before = files()
    ledger("load-people", "--file", ledger.file("l.csv", LATE_PEOPLE), "--roster", ledger.file("r.csv", ROSTER))
    ledger("rematch-payments")
    assert before and files() == before


def test_loaded_units_are_updated(ledger):
    load(ledger)
    changed = UNITS.replace("5.50", "6,25").replace("Los Tilos|1", "Los Tilos|2")
    ledger("load-units", "--file", ledger.file("changed.csv", changed))
    assert rows(ledger.store.read("unidad_funcional"), "id_uf", "porcentaje_de_prorrateo") == [
        ("los tilos|1", Decimal("20.00")),
        ("los tilos|2", Decimal("20.00")),
        ("rivera|1", Decimal("10.00")),
        ("rivera|2", Decimal("6.25")),
    ]


def test_quotes_and_protected_people(ledger, tmp_path):
    load(ledger)
    quotes = ledger.file("q.csv", "moneda|fecha|compra|venta\nusd|02/05/2025|1.100,00|1.150,00\n")
    ledger("load-quotes", "--file", quotes, "--sequence", "1")
    assert rows(ledger.store.read("cotizacion"), "moneda", "venta") == [("USD", Decimal("1150.00"))]
    pepper = ledger.file("pepper", "secret")
    seen = {
        audience: ledger(
            "protected-owners", "--audience", audience, "--clear", "general", "--pepper-file", pepper
        )
        for audience in ("general", "reportes")
    }
    assert rows(seen["general"], "dni") == [("11",), ("22",)]
    assert all(len(dni) == 64 for (dni,) in rows(seen["reportes"], "dni"))


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == named.rstrip("/") if named else "ledger-spark" in folder


def test_rejects_of_a_repeated_load_are_there_once(ledger):
    load(ledger)
    before = rows(ledger.store.rejected("pago"), "id_pago", "motivo", "carga")
    assert [r[:2] for r in before] == [(4, "fecha ilegible")]
    ledger("load-payments", "--file", ledger.file("again.csv", PAYMENTS))
    assert rows(ledger.store.rejected("pago"), "id_pago", "motivo", "carga") == before


def test_a_load_that_is_cut_off_is_invisible(ledger):
    store, roster = ledger.store, ledger.file("roster.csv", ROSTER)
    people = store.spark.createDataFrame([("p", "1")], "id_persona string, dni string")
    people = people.selectExpr("*", *[f"null {c}" for c in ("nombre", "apellido", "email", "telefono", "es_inquilino")])
    with pytest.raises(ZeroDivisionError), store.load("people") as _:
        store.write("persona", people)
        assert store.read("persona").count() == 1  # its own rows are seen inside
        raise ZeroDivisionError
    assert store.read("persona").count() == 0
    with pytest.raises(RuntimeError), store.load("a"), store.load("b"):
        pass
    with store.load("people") as _:
        store.write("persona", people)
    reader = store.tables()
    store.write("persona", people.withColumn("dni", people.id_persona), mode="overwrite")
    assert rows(reader.people, "dni") == [("1",)]  # goes on with the version it began with
    assert rows(store.read("persona"), "dni") == [("p",)]
    ledger("load-roster", "--file", roster)
    assert sizes(store)[:3] == [2, 3, 1]


def test_matching_again_moves_pending_payments_only(ledger):
    load(ledger)
    store = ledger.store
    version = store._latest()
    ledger("rematch-payments")
    assert store._latest() == version  # nothing found, nothing written
    ledger("load-people", "--file", ledger.file("l.csv", LATE_PEOPLE), "--roster", ledger.file("r.csv", ROSTER))
    ledger("rematch-payments")
    old, new = version[1], store._latest()[1]
    assert new["pago"][:-1] == old["pago"] and new["pago_pendiente"] != old["pago_pendiente"]
    added = store._parquet("pago", new["pago"][-1:])
    assert rows(added, "id_pago") == [(2,)]
    assert rows(store._parquet("pago_pendiente", new["pago_pendiente"]), "id_pago") == [(3,)]


def test_rows_are_told_apart_without_text_and_rematched_ones_written_down_once(spark, tmp_path, monkeypatch):
    store = LedgerStore(spark, str(tmp_path))
    schema = "a string, b string, m map<string, int>"
    lots = [[(None, "x", None), ("y", "z", {"k": 1})], [("y", "z", {"k": 1}), (None, "x", None)], [("x", None, None), ("y", "z", {"k": 1})], [(None, "x", None), ("y", "z", {"k": 2})]]
    first, turned, moved, other = [store.staged("lot", spark.createDataFrame(lot, schema)).digest for lot in lots]
    assert first == turned and len({first, moved, other}) == 3
    plain = store.staged("lot", spark.createDataFrame([(1, "x")], "n int, t string"))
    assert plain.digest.startswith("1-")
    day = datetime.date(2025, 4, 1)
    pago = [(i, None, Decimal(i), day, cbu, "no asociado") for i, cbu in enumerate(["1", "2", "1"])]
    store.write("pago", spark.createDataFrame(
        [(str(i), who, x, d, c, e) for i, who, x, d, c, e in pago],
        "id_pago string, id_persona_cuenta string, importe decimal(18,2), fecha_de_pago date, cbu_origen string, estado string",
    ))
    store.write("persona_cuenta", spark.createDataFrame([("1", "p", "1")], "id_persona_cuenta string, id_persona string, cbu string"))
    written, real = [], LedgerStore._rows_in_files
    monkeypatch.setattr(LedgerStore, "_rows_in_files", lambda self, name, df: written.append(name) or real(self, name, df))
    monthly.rematch_payments(store)
    assert written == ["rematch"]
    got = store.read("pago").select("id_pago", "id_persona_cuenta", "estado").collect()
    assert sorted(map(tuple, got), key=str) == [(0, "1", "asociado"), (1, None, "no asociado"), (2, "1", "asociado")]


def test_rejects_are_looked_for_among_repeated_keys(spark):
    rows_ = [("a", 1), ("a", 1), ("b", 1), ("b", 2), ("b", 2), ("c", None), ("c", 3)]
    split = imports._one_per_key(spark.createDataFrame(rows_, "k string, v int"), "k")
    assert sorted(map(tuple, split.accepted.collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert sorted((r.k, r.v) for r in split.rejected.collect()) == [("b", 1), ("c", None)]
    plan = split.rejected._jdf.queryExecution().optimizedPlan().toString()
    assert "min(" not in plan and "_filas" in plan
