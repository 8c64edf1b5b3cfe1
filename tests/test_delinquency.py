import datetime
from decimal import Decimal

import pytest

from ledger_spark.plans.delinquency import delinquency, top_delinquent_owners
from ledger_spark.tables import LedgerTables

CUTOFF = datetime.date(2025, 4, 30)
MONEY = "decimal(18,2)"


def d(text):
    return None if text is None else Decimal(text)


@pytest.fixture(scope="module")
def tables(spark):
    people = [
        (1, "Ana", "Perez", "11", "ana@example.org", "5550001", 0),
        (2, "Leo", "Gomez", "22", "leo@example.org", "5550002", 0),
        (3, "Tom", "Tenant", "33", None, None, 1),
        (4, "Eva", "Vidal", "44", None, None, 0),
        (5, "Sin", "Cargo", "55", None, None, 0),
    ]
    units = [
        (10, 1, "4.00"),
        (11, 1, "6.00"),
        (12, 1, None),
        (13, 1, "5.00"),
        (14, 1, "2.50"),
        (20, 2, "10.00"),
        (30, 3, "9.00"),
    ]
    links = [(10, 1), (11, 1), (12, 2), (13, 3), (14, 4), (20, 1), (30, 5)]
    charges = [
        (1, " Abril ", "1000", "500"),
        (1, "mayo ", "2000", None),
        (2, "abril", "3000", None),
        (3, None, "800", None),
    ]
    payments = [
        (1, "30", "2025-04-30"),
        (1, "20", "2025-05-01"),
        (2, "15", "2025-04-01"),
        (None, "99", "2025-04-01"),
        (3, "40", "2025-04-01"),
    ]
    day = datetime.date.fromisoformat
    return LedgerTables(
        buildings=spark.createDataFrame([(1, "Norte"), (2, "Sur"), (3, "Este")], "id_consorcio int, nombre string"),
        charges=spark.createDataFrame(
            [(b, p, d(o), d(e)) for b, p, o, e in charges],
            f"id_consorcio int, periodo string, total_ordinarios {MONEY}, total_extraordinarios {MONEY}",
        ),
        expense_lines=None,
        people=spark.createDataFrame(
            people,
            "id_persona int, nombre string, apellido string, dni string, email string, telefono string, es_inquilino int",
        ),
        units=spark.createDataFrame(
            [(u, b, d(p)) for u, b, p in units],
            "id_uf int, id_consorcio int, porcentaje_de_prorrateo decimal(5,2)",
        ),
        unit_people=spark.createDataFrame(links, "id_uf int, id_persona int"),
        accounts=spark.createDataFrame([(i, i) for i in range(1, 6)], "id_persona_cuenta int, id_persona int"),
        payments=spark.createDataFrame(
            [(a, d(m), day(f)) for a, m, f in payments],
            f"id_persona_cuenta int, importe {MONEY}, fecha_de_pago date",
        ),
    )


def report(df):
    return [(r.Consorcio, r.apellido, float(r.DeudaEsperada), float(r.Pagos), float(r.Morosidad)) for r in df.collect()]


WORKED = dict(include_extra=True, periods="ABRIL , mayo", n=10)


def test_worked_example(tables):
    assert report(top_delinquent_owners(tables, CUTOFF, **WORKED)) == [
        ("Norte", "Perez", 350.0, 60.0, 290.0),
        ("Sur", "Perez", 300.0, 30.0, 270.0),
        ("Norte", "Vidal", 87.5, 0.0, 87.5),
        ("Norte", "Gomez", 0.0, 15.0, 0.0),
    ]


def test_dedup_counts_a_payment_once_per_building(tables):
    got = report(top_delinquent_owners(tables, CUTOFF, dedup=True, **WORKED))
    assert got[0] == ("Norte", "Perez", 350.0, 30.0, 320.0)


def test_larger_n_extends_the_list(tables):
    lists = [report(top_delinquent_owners(tables, CUTOFF, **(WORKED | {"n": n}))) for n in (1, 2, 3, 4)]
    for shorter, longer in zip(lists, lists[1:]):
        assert longer[: len(shorter)] == shorter


def test_default_covers_every_named_period(tables):
    listed = report(delinquency(tables, CUTOFF, include_extra=True, periods="abril,mayo").orderBy("id_persona", "id_consorcio"))
    default = report(delinquency(tables, CUTOFF, include_extra=True).orderBy("id_persona", "id_consorcio"))
    assert default == listed


def test_one_building_without_extraordinary(tables):
    got = report(top_delinquent_owners(tables, CUTOFF, building=2))
    assert got == [("Sur", "Perez", 300.0, 30.0, 270.0)]
    only_april = report(top_delinquent_owners(tables, CUTOFF, building=1, periods="abril"))
    assert only_april[0] == ("Norte", "Perez", 100.0, 60.0, 40.0)


def test_columns(tables):
    df = top_delinquent_owners(tables, CUTOFF)
    assert df.columns == [
        "Consorcio", "apellido", "nombre", "dni", "email", "telefono", "DeudaEsperada", "Pagos", "Morosidad",
    ]
    assert dict(df.dtypes)["Morosidad"] == MONEY


def test_cutoff_is_required(tables):
    with pytest.raises(ValueError):
        top_delinquent_owners(tables, None)


def test_unknown_period_gives_nothing(tables):
    assert report(top_delinquent_owners(tables, CUTOFF, periods="brumario")) == []
