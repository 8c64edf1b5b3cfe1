"""Shares to the cent, settled charges, spells, values as of a day, nested roles and cut account
numbers against plain Python on awkward rows, and their plans."""

import datetime
import hashlib
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_plans import plan_of, settings

from ledger_spark.operators.as_of import as_of
from ledger_spark.operators.closure import reachable
from ledger_spark.operators.membership import effective_access_nested
from ledger_spark.plans import allocation
from ledger_spark.plans.allocation import debt_by_age, payment_allocation
from ledger_spark.plans.apportion import unit_charges_exact
from ledger_spark.plans.currency import payments_in_currency, without_quote
from ledger_spark.plans.imports import match_rounded
from ledger_spark.plans.intervals import unpaid_spells
from ledger_spark.schemas import CHARGE
from ledger_spark.tables import LedgerTables

UNITS = "id_uf string, id_consorcio string, porcentaje_de_prorrateo decimal(5,2)"
CENT = Decimal("0.01")


def month(n):
    return datetime.date(2024 + n // 12, n % 12 + 1, 1)


def charges_of(spark, charged):
    """From (building, month, ordinary, extraordinary)."""
    made = [(str(i), b, "x", m, o, e) for i, (b, m, o, e) in enumerate(charged)]
    return spark.createDataFrame(made, CHARGE)


def apportioned(units, charged):
    totals = {}
    for building, m, ordinary, extra in charged:
        if m is not None:
            key = building, m
            totals[key] = totals.get(key, 0) + int(((ordinary or 0) + (extra or 0)) * 100)
    out = []
    for (building, m), total in totals.items():
        mine = [(u, max(int((p or 0) * 100), 0)) for u, b, p in units if b == building]
        weights = mine if any(w for _, w in mine) else [(u, 1) for u, _ in mine]
        whole = sum(w for _, w in weights)
        parts = [(abs(total) * w // whole, abs(total) * w % whole, w, u) for u, w in weights]
        left = abs(total) - sum(p[0] for p in parts)
        order = sorted(parts, key=lambda p: (-p[1], p[2], hashlib.md5(p[3].encode()).hexdigest()))
        for n, (cents, _, _, unit) in enumerate(order):
            value = (cents + (n < left)) * (1 if total >= 0 else -1)
            out.append((unit, building, m, Decimal(value) * CENT))
    return sorted(out)


def test_shares_add_up_to_the_cent(spark):
    pick = random.Random(4)
    shares = [Decimal("1.11"), Decimal("3.07"), Decimal("0.01"), Decimal("0"), None]
    units = [(f"a{i}", "a", pick.choice(shares)) for i in range(700)]
    units += [(f"b{i}", "b", None) for i in range(7)] + [("c1", "c", Decimal("100")), ("d1", "d", Decimal("-1"))]
    charged = [("a", month(i), Decimal(pick.randint(-9, 10**7)) * CENT, None) for i in range(14)]
    charged += [("a", month(3), None, Decimal("77.77")), ("b", month(0), Decimal("100"), None)]
    charged += [("b", month(1), Decimal("-0.05"), None), ("c", month(0), Decimal("9999999999999999.99"), None)]
    charged += [("d", month(2), Decimal("1.01"), None), ("none", month(2), Decimal("5"), None)]
    charged += [("a", None, Decimal("5"), None), ("b", month(5), None, None)]
    got = unit_charges_exact(spark.createDataFrame(units, UNITS), charges_of(spark, charged))
    found = sorted(tuple(r) for r in got.collect())
    assert found == apportioned(units, charged)
    sums = {}
    for _, building, m, value in found:
        sums[building, m] = sums.get((building, m), 0) + value
    for building, m, ordinary, extra in charged:
        if building in "abcd" and m not in (None, month(3)):
            assert sums[building, m] == (ordinary or 0) + (extra or 0)


def test_shares_of_nothing(spark):
    units, charges = spark.createDataFrame([], UNITS), charges_of(spark, [("a", month(0), Decimal(1), None)])
    assert unit_charges_exact(units, charges).count() == 0
    some = spark.createDataFrame([("u", "a", Decimal(1))], UNITS)
    assert unit_charges_exact(some, charges.limit(0)).count() == 0


def test_units_of_a_large_building_are_numbered_in_many_tasks(spark):
    """No window runs over the units of a building, and month rows are not shuffled."""
    units = spark.range(10).selectExpr("cast(id as string) id_uf", "'a' id_consorcio", "1.00 porcentaje_de_prorrateo")
    with settings(spark, adaptive__enabled="false"):
        plan = plan_of(unit_charges_exact(units, charges_of(spark, [("a", month(0), Decimal(1), None)])))
    by = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert len(by) == 1 and "_range" in by[0].split("row_number()")[1]
    last = plan[: plan.index("Exchange")]
    assert "Generate inline" in last and "Window" not in last


def ledger_of(spark, units, owners, payments):
    """Units (id, building, percent); owners (unit, person); payments (person, day, amount)."""
    empty = spark.range(0)
    accounts = sorted({p for _, p in owners})
    money = [(f"k{p}" if p else None, d, Decimal(a) if a is not None else None) for p, d, a in payments]
    return LedgerTables(
        buildings=empty,
        charges=empty,
        expense_lines=empty,
        people=empty,
        units=spark.createDataFrame([(u, b, None if p is None else Decimal(p)) for u, b, p in units], UNITS),
        unit_people=spark.createDataFrame(owners, "id_uf string, id_persona string"),
        accounts=spark.createDataFrame(
            [(f"k{p}", p) for p in accounts], "id_persona_cuenta string, id_persona string"
        ),
        payments=spark.createDataFrame(
            money, "id_persona_cuenta string, fecha_de_pago date, importe decimal(18,2)"
        ),
    )


def random_ledger(spark):
    pick = random.Random(8)
    units = [(f"u{i}", pick.choice("ab"), pick.choice([None, "0", "10", "33.33", "7.77"])) for i in range(30)]
    owners = [(u, f"p{pick.randrange(20)}") for u, _, _ in units] + [("u1", "p1"), ("u1", "p1")]
    charged = [
        (b, month(i), Decimal(pick.choice([0, -500, 12345, 99999, 400])) * CENT, pick.choice([None, Decimal(3)]))
        for b in "ab"
        for i in range(9)
    ] + [("a", None, Decimal(50), None)]
    start = datetime.date(2023, 12, 20)
    payments = [
        (
            pick.choice([f"p{pick.randrange(20)}", "p1"]),
            start + datetime.timedelta(pick.randrange(300)),
            pick.choice(["10", "55.5", "0.01", "-4", "0", "120", None]),
        )
        for _ in range(250)
    ] + [(None, start, "9"), ("p2", None, "8")]
    return units, owners, charged, payments


def movements(units, owners, charged, payments, until=None):
    """Per unit the amounts charged by month and paid by day, credits and takings-back turned round."""
    first = {}
    for unit, person in owners:
        first[person] = min(unit, first.get(person, unit))
    out = {u: ({}, {}) for u, _, _ in units}

    def add(unit, side, day, amount):
        if amount > 0:
            out[unit][side][day] = out[unit][side].get(day, 0) + amount

    totals = {}
    for building, m, ordinary, extra in charged:
        if m is not None and (until is None or m <= until):
            totals[building, m] = totals.get((building, m), 0) + (ordinary or 0) + (extra or 0)
    for unit, building, percent in units:
        for (b, m), total in totals.items():
            if b == building:
                share = (total * Decimal(percent or 0) * CENT).quantize(CENT, ROUND_HALF_UP)
                add(unit, int(share < 0), m, abs(share))
    paid = {}
    for person, day, amount in payments:
        if person in first and day is not None and (until is None or day <= until):
            key = first[person], day
            paid[key] = paid.get(key, 0) + Decimal(amount or 0)
    for (unit, day), amount in paid.items():
        add(unit, int(amount > 0), day if amount > 0 else day.replace(day=1), abs(amount))
    return out


def settled(charges, payments):
    """Oldest charges first, by hand; and what stays open of each."""
    open_, out = dict(charges), []
    for day in sorted(payments):
        left = payments[day]
        for m in sorted(open_):
            part = min(left, open_[m])
            if part > 0:
                out.append((m, day, part))
                left, open_[m] = left - part, open_[m] - part
    return out, open_


def test_payments_settle_the_oldest_charge(spark):
    units, owners, charged, payments = random_ledger(spark)
    got = payment_allocation(ledger_of(spark, units, owners, payments), charges_of(spark, charged))
    want = []
    for unit, (charges, paid) in movements(units, owners, charged, payments).items():
        want += [(unit, *x) for x in settled(charges, paid)[0]]
    assert sorted(map(tuple, got.select("id_uf", "mes", "fecha", "importe").collect())) == sorted(want)
    assert len(want) > 100


def test_open_debt_by_age(spark):
    cutoff = datetime.date(2024, 6, 10)
    units, owners, charged, payments = random_ledger(spark)
    building = {u: b for u, b, _ in units}
    found = {}
    for unit, (charges, paid) in movements(units, owners, charged, payments, cutoff).items():
        ages = {}
        for m, amount in settled(charges, paid)[1].items():
            days = (cutoff - m).days
            name = next((n for most, n in ((30, "0-30"), (60, "31-60"), (90, "61-90")) if days <= most), "mas de 90")
            if amount > 0:
                ages[name] = ages.get(name, 0) + amount
        for name, amount in ages.items():
            n, total = found.get((building[unit], name), (0, 0))
            found[building[unit], name] = (n + 1, total + amount)
    got = debt_by_age(ledger_of(spark, units, owners, payments), charges_of(spark, charged), cutoff)
    columns = ("id_consorcio", "antiguedad", "unidades", "deuda")
    assert rows(got, *columns) == sorted((*k, *v) for k, v in found.items())


def test_month_rows_of_a_unit_are_not_moved(spark):
    units, owners, charged, payments = random_ledger(spark)
    tables, charges = ledger_of(spark, units, owners, payments), charges_of(spark, charged)
    with settings(spark, adaptive__enabled="false"):
        for df in (payment_allocation(tables, charges), unpaid_spells(tables, charges)):
            plan = plan_of(df)
            assert "Exchange" not in plan[: plan.index("Generate")]


def test_spells_without_payment(spark):
    units, owners, charged, payments = random_ledger(spark)
    until = datetime.date(2024, 8, 15)
    first = {}
    for unit, person in owners:
        first[person] = min(unit, first.get(person, unit))
    paid = {(first[p], d.replace(day=1)) for p, d, _ in payments if p in first and d and d <= until}
    want = []
    for unit, building, _ in units:
        months = sorted({m for b, m, _, _ in charged if b == building and m and m <= until})
        run = []
        for m in [*months, None]:
            if m is not None and (unit, m) not in paid:
                run.append(m)
            elif run:
                want.append((unit, run[0], run[-1], len(run), run[-1] == months[-1]))
                run = []
    got = unpaid_spells(ledger_of(spark, units, owners, payments), charges_of(spark, charged), until)
    assert rows(got, "id_uf", "desde", "hasta", "meses", "abierto") == sorted(want)
    assert any(w[4] for w in want) and any(not w[4] for w in want)


def test_value_as_of_a_day(spark):
    pick = random.Random(6)
    start = datetime.date(2023, 11, 25)
    days = [start + datetime.timedelta(pick.randrange(400)) for _ in range(60)]
    steps = {(pick.choice("xy"), d): i for i, d in enumerate(days)}
    asked = [(i, pick.choice(["x", "y", "z", None]), pick.choice([*days, start - datetime.timedelta(9), None])) for i in range(500)]
    asked += [(1000 + i, "x", days[0]) for i in range(500)]
    known = spark.createDataFrame([(k, d, v) for (k, d), v in steps.items()], "k string, t date, v int")
    rows_ = spark.createDataFrame(asked, "id int, k string, t date")

    def value(k, t):
        found = [(d, v) for (kind, d), v in steps.items() if t and kind == k and d <= t]
        return max(found) if found else (None, None)

    want = [(i, k, t, *value(k, t)) for i, k, t in asked]
    for block in ("month", "week", "year"):
        got = as_of(rows_, known, "t", ["k"], ["v"], block)
        assert got.columns == ["id", "k", "t", "vigente_desde", "v"]
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_one_day_and_currency_of_most_payments_is_split(spark):
    """The rows of a hot day meet one row, and adaptive execution may split them."""
    rows_ = spark.range(200_000).select(
        F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id") % 300).cast("int").alias("n"), "id"
    )
    payments = rows_.select(
        "id", F.date_add(F.lit(datetime.date(2024, 1, 1)), F.col("n")).alias("fecha_de_pago"),
        F.lit(1).cast("decimal(18,2)").alias("importe"),
    )
    quotes = spark.range(30).select(
        F.lit("USD").alias("moneda"),
        F.date_add(F.lit(datetime.date(2024, 1, 3)), (F.col("id") * 10).cast("int")).alias("fecha"),
        (F.col("id") % 7).cast("decimal(18,2)").alias("venta"),
        F.lit(1).alias("secuencia"),
    )
    skew = {
        "adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
        "adaptive__skewJoin__skewedPartitionFactor": "1.5",
        "adaptive__advisoryPartitionSizeInBytes": "64k",
        "autoBroadcastJoinThreshold": "-1",
        "adaptive__autoBroadcastJoinThreshold": "-1",
    }
    with settings(spark, **skew):
        converted = payments_in_currency(payments, quotes, ["USD"])
        assert converted.agg(F.count("id"), F.count_distinct("id")).first() == (200_000, 200_000)
        plan = (seen := converted.groupBy("id").count()).collect() and plan_of(seen)
    assert "skew=true" in plan
    early = without_quote(converted).orderBy("fecha_de_pago").collect()
    assert [r.fecha_de_pago.day for r in early] == [1]
    zero = converted.where("venta = 0").select("importe_en_moneda").distinct().collect()
    assert [r[0] for r in zero] == [None]


def test_reachable_with_circles(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 4), (5, 6), (None, 1), (2, None), (1, 2)]
    start = [("a", 1), ("b", 3), ("c", 9), ("d", 5), ("d", 6), (None, 1), ("e", None)]
    got = reachable(
        spark.createDataFrame(start, "origen string, nodo int"),
        spark.createDataFrame(edges, "nodo int, destino int"),
    )
    assert rows(got, "origen", "nodo", "distancia") == sorted(
        [("a", 1, 1), ("a", 2, 2), ("a", 3, 3), ("a", 4, 4)]
        + [("b", 3, 1), ("b", 1, 2), ("b", 4, 2), ("b", 2, 3)]
        + [("c", 9, 1), ("d", 5, 1), ("d", 6, 1)]
    )


def test_denials_are_inherited(spark):
    schema = "rol string, esquema string, objeto string, permiso string, accion string"
    permissions = spark.createDataFrame(
        [
            ("all", "rep", None, "EXECUTE", "GRANT"),
            ("staff", "rep", "six", "EXECUTE", "DENY"),
            ("bank", "rep", "six", "EXECUTE", "GRANT"),
            ("bank", "imp", "pay", "EXECUTE", "GRANT"),
        ],
        schema,
    )
    nested = spark.createDataFrame([("bank", "staff"), ("staff", "all"), ("all", "bank")], "rol string, dentro_de string")
    members = spark.createDataFrame([("bank", "ann"), ("other", "bob")], "rol string, miembro string")
    objects = spark.createDataFrame([("rep", "one"), ("rep", "six"), ("imp", "pay")], "esquema string, objeto string")
    got = effective_access_nested(permissions, members, objects, nested)
    assert rows(got, "miembro", "objeto", "permitido", "distancia") == [
        ("ann", "one", True, 3),
        ("ann", "pay", True, 1),
        ("ann", "six", False, 1),
    ]
    alone = effective_access_nested(permissions, members, objects, nested.limit(0))
    assert rows(alone, "objeto", "permitido", "distancia") == [("pay", True, 1), ("six", True, 1)]


def test_nested_roles_are_followed_by_doubled_steps_and_met_by_bits(spark):
    """Chains and a circle longer than a few doublings, more objects than a word has bits, NULLs and
    members of several roles, against a plain search."""
    schema = "rol string, esquema string, objeto string, permiso string, accion string"
    inner = [(f"r{i}", f"r{i + 1}") for i in range(21)] + [("r21", "r3"), ("r5", "r9"), ("r2", "r2"), (None, "r1"), ("r4", None)]
    stated = [(f"r{i}", f"s{j % 3}", f"o{j}", "ALTER" if j % 2 else None, "DENY" if i == j else "GRANT") for i in (0, 7, 13, 21) for j in range(0, 90, 1 + i)]
    stated += [("r9", "s1", None, "ALTER", "GRANT"), ("r9", None, "loose", "ALTER", "GRANT"), (None, "s1", "o1", "ALTER", "DENY")]
    belongs = [("r0", "ann"), ("r6", "ann"), ("r13", "bob"), ("r13", "bob"), ("away", "eve"), (None, "nil"), ("r1", None)]
    things = [(f"s{j % 3}", f"o{j}") for j in range(0, 90, 10)]
    seen = {}
    for role, who in belongs:
        if role is None or who is None:
            continue
        now, steps = {role}, 1
        while now:
            for r in now:
                seen.setdefault((who, r), []).append(steps)
            steps += 1
            now = {b for a, b in inner if a in now and b} - {r for w, r in seen if w == who and min(seen[w, r]) < steps - 25}
            if steps > 30:
                break
    want = {}
    for (who, r), steps in seen.items():
        for role, e, o, p, action in stated:
            for schema_, thing in [(e, o)] if o is not None else [t for t in things if t[0] == e]:
                if role == r:
                    want.setdefault((who, schema_, thing, p), []).append((min(steps), action))
    key = lambda t: [(v is not None, v) for v in t]
    want = sorted([(*k, all(a == "GRANT" for _, a in v), min(d for d, _ in v)) for k, v in want.items()], key=key)
    got = effective_access_nested(
        spark.createDataFrame(stated, schema),
        spark.createDataFrame(belongs, "rol string, miembro string"),
        spark.createDataFrame(things, "esquema string, objeto string"),
        spark.createDataFrame(inner, "rol string, dentro_de string"),
    )
    # What is shuffled past the members are words, not objects.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan.partition("Generate inline(_celdas")[2]
    assert rows(got) == want


def test_account_numbers_cut_by_a_spreadsheet(spark):
    accounts = [
        ("whole", "1111111111111111111111"),
        ("near1", "2222222222222221111111"),
        ("near2", "2222222222222229999999"),
        ("zeros", "3333333333333330000000"),
        ("other", "3333333333333335555555"),
        ("short", "111111111111111"),
        ("none", None),
    ]
    asked = {  # number: account, candidates
        "1111111111111111111111": ("whole", 1),
        "1111111111111110000000": ("whole", 1),
        "2222222222222220000000": (None, 2),
        "2222222222222229999999": ("near2", 1),
        "3333333333333330000000": ("zeros", 1),
        "4444444444444440000000": (None, 0),
        "1111111111111111111112": (None, 0),
        "111111110000000": ("short", 1),
        "0000000": (None, 0),
        None: (None, None),
    }
    known = spark.createDataFrame([(k, k, c) for k, c in accounts], "id_persona_cuenta string, id_persona string, cbu string")
    payments = spark.createDataFrame([(i, n) for i, n in enumerate(asked)] * 2, "id_pago long, cbu_origen string")
    got = match_rounded(payments, known).collect()
    assert len(got) == 2 * len(asked)
    for r in got:
        account, count = asked[r.cbu_origen]
        assert (r.id_persona_cuenta, r.candidatos) == (account, count)
        assert r.estado == ("asociado" if account else "ambiguo" if (count or 0) > 1 else "no asociado")


@pytest.mark.parametrize("folder", ["hdfs://x/y", None])
def test_local_warehouse_is_refused_on_a_cluster(folder):
    from ledger_spark.session import shared_folder

    class Cluster:
        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "file:/tmp/x"}[name] or default

        class sparkContext:  # noqa: N801
            master = "yarn"

    if folder:
        assert shared_folder(Cluster) == folder
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Cluster)


def one_unit(spark, rows):
    """Twelve months of 100.00 a month at a full share, 150.00 paid and 20.00 paid in the next month."""
    months = [datetime.date(2024, m, 1) for m in range(1, 13)]
    charged = [("b", m, Decimal("100.00"), None) for m in months]
    payments = [("p", months[0], Decimal("150.00")), ("p", months[1], Decimal("20.00"))]
    owners = [(rows[0][0], "p")]
    return ledger_of(spark, rows, owners, payments), charges_of(spark, charged)


def test_only_what_can_be_settled_becomes_rows(spark):
    units = [("u", "b", Decimal("100.00")), ("v", "b", Decimal("100.00"))]
    tables, charges = one_unit(spark, units)
    once, _ = allocation._movements(tables, charges, True, None, None, settling=True)
    short = allocation._settled_ahead(once)
    assert [(r["id_uf"], len(r["movimientos"])) for r in short.collect()] == [("u", 4)]
    got = payment_allocation(tables, charges).select("id_uf", "mes", "fecha", "importe")
    jan, feb = datetime.date(2024, 1, 1), datetime.date(2024, 2, 1)
    want = [("u", jan, jan, 100), ("u", feb, jan, 50), ("u", feb, feb, 20)]
    assert sorted(map(tuple, got.collect())) == want


def test_debt_of_ages_is_summed_within_the_row(spark):
    tables, charges = one_unit(spark, [("u", "b", Decimal("100.00"))])
    with settings(spark, adaptive__enabled="false"):
        plan = plan_of(debt_by_age(tables, charges, datetime.date(2024, 12, 31)))
    above = plan[: plan.index("Generate inline")]
    assert "Window" not in above and "Sort" not in above


def test_rows_of_one_unit_share_one_line(spark):
    twice = [("u", "b", Decimal("50.00")), ("u", "b", Decimal("50.00"))]
    tables, charges = one_unit(spark, twice)
    got = payment_allocation(tables, charges).select("id_uf", "mes", "fecha", "importe")
    # Both rows are charged and credited, on one line.
    months = [datetime.date(2024, m, 1) for m in (1, 2, 3, 4)]
    want = [("u", m, months[0], 100) for m in months[:3]] + [("u", months[3], months[1], 40)]
    assert sorted(map(tuple, got.collect())) == want
    cutoff = datetime.date(2024, 12, 30)
    found = rows(debt_by_age(tables, charges, cutoff), "id_consorcio", "antiguedad", "unidades", "deuda")
    assert found == [("b", "0-30", 1, 100), ("b", "31-60", 1, 100), ("b", "61-90", 1, 100), ("b", "mas de 90", 1, 560)]
