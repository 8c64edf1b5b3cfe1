import hashlib
import hmac

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledger_spark.operators import membership, protect
from ledger_spark.operators.periods import charges_in_periods, period_set

PEOPLE = [(1, "11", "a@example.org", None), (2, "22", None, "555")]
KEY = "0123456789abcdef"


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, "id_persona int, dni string, email string, telefono string")


def test_digests_unless_clear(people):
    assert rows(protect.protected_owners(people, "general", ["general"], "p")) == PEOPLE
    hidden = rows(protect.protected_owners(people, "reportes", ["general"], "p"))
    assert hidden[0][1] == hashlib.sha256(b"p11").hexdigest()
    assert hidden[0][3] is None and hidden[1][2] is None


def test_encryption_round_trip(people):
    hidden = protect.encrypt_columns(people, ["dni", "email"], KEY)
    assert hidden.where(F.col("dni") == "11").count() == 0
    assert rows(protect.decrypt_columns(hidden, ["dni", "email"], KEY)) == PEOPLE


@pytest.mark.parametrize("key", ["k", "ñandú", "x" * 64, "y" * 200])
def test_keyed_digests_are_hmac(spark, key):
    values = ["11", "", "café \U0001f600", "z" * 1000, None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(protect.keyed_digest(F.col("v"), key)).collect()]
    want = [
        v if v is None else hmac.new(key.encode(), v.encode(), hashlib.sha256).hexdigest() for v in values
    ]
    assert got == want


def test_a_pepper_is_no_key_but_a_key_is(spark):
    """Of a pepper in front, "a" + "bc" and "ab" + "c" are one text."""
    df = spark.createDataFrame([("bc", "c")], "x string, y string")
    assert df.where(protect.digest(F.col("x"), "a") == protect.digest(F.col("y"), "ab")).count() == 1
    same = protect.keyed_digest(F.col("x"), "a") == protect.keyed_digest(F.col("y"), "ab")
    assert df.where(same).count() == 0


KEYS = {1: "old", 2: "new", 3: "newest"}


def _digest(value, number):
    return hmac.new(KEYS[number].encode(), value.encode(), hashlib.sha256).hexdigest()


def test_one_view_across_keys(spark):
    lot = lambda vs: spark.createDataFrame([(v, i) for i, v in enumerate(vs)], "v string, n int")
    old = protect.keyed_columns(lot(["a", "b", None, "a", "gone"]), ["v"], KEYS, 1)
    new = protect.keyed_columns(lot(["a", "c"]), ["v"], KEYS, 2)
    known = lot(["a", "b", "c", "a", None])
    bridge = protect.key_bridge(known, "v", KEYS, 1, 2)
    assert bridge.count() == 3
    got = protect.under_new_key(old.unionByName(new), "v", bridge)
    assert got.columns == ["v", "n", "clave"]
    assert sorted(got.collect(), key=str) == sorted(
        [
            (_digest("a", 2), 0, 2),
            (_digest("b", 2), 1, 2),
            (None, 2, 1),
            (_digest("a", 2), 3, 2),
            (_digest("gone", 1), 4, 1),
            (_digest("a", 2), 0, 2),
            (_digest("c", 2), 1, 2),
        ],
        key=str,
    )
    # The next change goes on from there.
    again = protect.under_new_key(got, "v", protect.key_bridge(known, "v", KEYS, 2, 3))
    assert {r["clave"] for r in again.where("v IS NOT NULL").collect()} == {1, 3}
    # No value and no key is in the view, and an empty bridge moves nothing.
    none = protect.under_new_key(old, "v", bridge.limit(0))
    assert sorted(none.collect(), key=str) == sorted(old.collect(), key=str)


def test_every_row_of_a_frequent_digest_moves_without_python(spark):
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v"), "id"
    )
    hidden = protect.keyed_columns(rows, ["v"], KEYS, 1)
    bridge = protect.key_bridge(rows, "v", KEYS, 1, 2)
    view = protect.under_new_key(hidden, "v", bridge)
    assert view.count() == 300 and view.where("clave = 2").count() == 300
    plan = view._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


ROLES = ["general", "operativo", "bancario", "sistemas"]
MASTER = ["importar_unidades", "importar_personas"]
BANK = ["importar_pagos", "actualizar_cotizaciones"]
REPORTS = ["flujo_semanal", "recaudacion", "morosidad"]


def test_permission_matrix(spark):
    may = {o: {"general", "operativo"} for o in MASTER} | {o: {"bancario"} for o in BANK}
    may |= {o: set(ROLES) for o in REPORTS}
    statements = [(r, o, "GRANT" if r in roles else "DENY") for o, roles in may.items() for r in ROLES]
    statements += [("sistemas", "importar_pagos", "GRANT")]  # a denial outweighs it
    permissions = spark.createDataFrame(statements, "rol string, objeto string, accion string")
    got = {(r, o): allowed for r, o, allowed in rows(membership.effective_access(permissions))}
    assert got == {(r, o): r in roles for o, roles in may.items() for r in ROLES}


def test_access_of_users_by_kind_and_schema(spark):
    statements = [
        ("general", "cargas", "unidades", "EXECUTE", "GRANT"),
        ("general", "cargas", None, "ALTER", "DENY"),  # leaves EXECUTE alone
        ("general", "informes", None, "EXECUTE", "GRANT"),
        ("bancario", "cargas", "unidades", "EXECUTE", "DENY"),
        ("bancario", "informes", "flujo", "EXECUTE", "GRANT"),
        ("bancario", "otros", "suelto", "EXECUTE", "GRANT"),  # not a listed object
    ]
    permissions = spark.createDataFrame(
        statements * 2, "rol string, esquema string, objeto string, permiso string, accion string"
    )
    members = spark.createDataFrame(
        [("general", "ana"), ("general", "ana"), ("general", "leo"), ("bancario", "leo"), ("x", "eva")],
        "rol string, miembro string",
    )
    objects = spark.createDataFrame(
        [("cargas", "unidades"), ("cargas", "pagos"), ("informes", "flujo"), ("informes", "deuda")],
        "esquema string, objeto string",
    )
    got = rows(membership.effective_access_users(permissions, members, objects))
    assert got == [
        ("ana", "cargas", "pagos", "ALTER", False),
        ("ana", "cargas", "unidades", "ALTER", False),
        ("ana", "cargas", "unidades", "EXECUTE", True),
        ("ana", "informes", "deuda", "EXECUTE", True),
        ("ana", "informes", "flujo", "EXECUTE", True),
        ("leo", "cargas", "pagos", "ALTER", False),
        ("leo", "cargas", "unidades", "ALTER", False),
        ("leo", "cargas", "unidades", "EXECUTE", False),
        ("leo", "informes", "deuda", "EXECUTE", True),
        ("leo", "informes", "flujo", "EXECUTE", True),
        ("leo", "otros", "suelto", "EXECUTE", True),
    ]


def test_membership(spark):
    desired = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "rol string, miembro string")
    present = spark.createDataFrame([("b", "y"), ("b", "y")], "rol string, miembro string")
    assert rows(membership.missing_members(desired, present)) == [("a", "x")]
    assert rows(membership.exists_in(desired, present, ["rol", "miembro"])) == [("b", "y")]
    assert rows(membership.in_list(desired, "rol", ["b", "c"])) == [("b", "y")]


def test_period_sets(spark):
    charges = spark.createDataFrame(
        [(1, " Abril"), (1, "abril "), (2, "mayo"), (2, None)], "id_consorcio int, periodo string"
    )
    assert rows(period_set(charges)) == [("abril",), ("mayo",)]
    assert rows(period_set(charges, building=2)) == [("mayo",)]
    assert rows(period_set(charges, " Mayo,MAYO, junio")) == [("junio",), ("mayo",)]
    assert rows(charges_in_periods(charges, "ABRIL")) == [(1, " Abril"), (1, "abril ")]
    assert charges_in_periods(charges).count() == 3
    assert charges_in_periods(charges, building=2).count() == 1
