"""Reports and charges against a plain Python reading of their definitions."""

import datetime
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows

from ledger_spark.plans.cash_flow import weekly_cash_flow
from ledger_spark.plans.charges import charge_rollup, unit_charges, unit_statement
from ledger_spark.plans.collections import collections_month_dept, collections_type_period
from ledger_spark.plans.intervals import payment_days, payment_intervals
from ledger_spark.plans.payers import account_units
from ledger_spark.plans.rankings import top5_expense_income
from ledger_spark.tables import LedgerTables

MONEY = "decimal(18,2)"
CENT = Decimal("0.01")
DEPARTMENTS = ["A", "B", "C"]
START = datetime.date(2024, 11, 1)


def cents(value):
    return Decimal(value).quantize(CENT, ROUND_HALF_UP)


class Case:
    """Random ledger in which account 1 makes most payments, many on one day."""

    def __init__(self):
        rng = random.Random(7)
        self.units = {
            u: (u % 3, DEPARTMENTS[u % 3 - 1], None if u == 5 else Decimal(rng.randint(0, 2000)).scaleb(-2))
            for u in range(1, 13)
        }
        self.links = [(u, (u + 2) // 3) for u in self.units] + [(4, 1)]
        self.accounts = {a: 1 + (a - 1) % 4 for a in range(1, 6)}
        self.payments = []
        for _ in range(300):
            account = 1 if rng.random() < 0.6 else rng.choice([2, 3, 4, 5, None])
            day = 3 if rng.random() < 0.3 else rng.randint(0, 150)
            self.payments.append(
                (account, START + datetime.timedelta(days=day), Decimal(rng.randint(1, 99999)).scaleb(-2))
            )
        self.lines = []
        for b in range(3):
            for m in range(4):
                for clase in ("ordinario", "extraordinario"):
                    for _ in range(rng.randint(0, 3)):
                        month = datetime.date(2024 + (10 + m) // 12, (10 + m) % 12 + 1, 1)
                        self.lines.append((b, month, clase, Decimal(rng.randint(1, 9999999)).scaleb(-2)))

    def unit_of(self, account):
        if account is None:
            return None
        owned = [u for u, p in self.links if p == self.accounts[account]]
        return min(owned) if owned else None

    def credited(self):
        return [(self.unit_of(a), day, x) for a, day, x in self.payments if self.unit_of(a)]


@pytest.fixture(scope="module")
def case():
    return Case()


@pytest.fixture(scope="module")
def tables(spark, case):
    lines = spark.createDataFrame(case.lines, f"id_consorcio int, mes date, clase string, importe {MONEY}")
    return LedgerTables(
        buildings=None,
        charges=charge_rollup(lines),
        expense_lines=lines,
        people=None,
        units=spark.createDataFrame(
            [(u, b, dep, pct) for u, (b, dep, pct) in case.units.items()],
            "id_uf int, id_consorcio int, departamento string, porcentaje_de_prorrateo decimal(5,2)",
        ),
        unit_people=spark.createDataFrame(case.links, "id_uf int, id_persona int"),
        accounts=spark.createDataFrame(
            list(case.accounts.items()), "id_persona_cuenta int, id_persona int"
        ),
        payments=spark.createDataFrame(
            case.payments, f"id_persona_cuenta int, fecha_de_pago date, importe {MONEY}"
        ),
    )


def totals(case):
    out = defaultdict(lambda: [None, None])
    for b, month, clase, x in case.lines:
        i = 0 if clase == "ordinario" else 1
        out[b, month][i] = (out[b, month][i] or 0) + x
    return out


def test_charge_rollup(case, tables):
    want = sorted(
        ((b, m, o, e) for (b, m), (o, e) in totals(case).items()),
        key=lambda r: [(v is not None, v) for v in r],
    )
    assert rows(tables.charges) == want


def test_account_units(case, tables):
    got = rows(account_units(tables.accounts, tables.unit_people, tables.units))
    assert got == sorted((a, case.unit_of(a), *case.units[case.unit_of(a)][:2]) for a in case.accounts if case.unit_of(a))


def shares(case, extra=True):
    out = {}
    for (b, month), (o, e) in totals(case).items():
        total = (o or 0) + ((e or 0) if extra else 0)
        for u, (ub, _, pct) in case.units.items():
            if ub == b:
                out[u, month] = cents(total * (pct or 0) * CENT)
    return out


@pytest.mark.parametrize("extra", [True, False])
def test_unit_charges(case, tables, extra):
    got = rows(unit_charges(tables.units, tables.charges, extra), "id_uf", "mes", "cargo")
    assert got == sorted((u, m, x) for (u, m), x in shares(case, extra).items())


def test_unit_statement(case, tables):
    charged, paid = shares(case), defaultdict(Decimal)
    for u, day, x in case.credited():
        paid[u, day.replace(day=1)] += x
    want, balance = [], defaultdict(Decimal)
    for u, month in sorted(set(charged) | set(paid)):
        before = balance[u]
        c, p = charged.get((u, month), Decimal(0)), paid.get((u, month), Decimal(0))
        balance[u] = before + c - p
        want.append((u, month, before, c, p, balance[u]))
    got = unit_statement(
        tables.units, tables.charges, tables.payments, tables.accounts, tables.unit_people
    )
    assert rows(got) == want


def week(day):
    return day - datetime.timedelta(days=day.weekday())


@pytest.mark.parametrize("building, since, until", [(None, None, None), (1, None, None), (0, datetime.date(2024, 11, 20), datetime.date(2025, 2, 1))])
def test_weekly_cash_flow(case, tables, building, since, until):
    paid = (
        [(day, x) for _, day, x in case.payments]
        if building is None
        else [(day, x) for u, day, x in case.credited() if case.units[u][0] == building]
    )
    sums = defaultdict(Decimal)
    for day, x in paid:
        if (since is None or day >= since) and (until is None or day <= until):
            sums[week(day)] += x
    want, running = [], Decimal(0)
    for monday in sorted(sums):
        running += sums[monday]
        want.append((monday, sums[monday], running, cents(sum(sums.values()) / len(sums))))
    assert rows(weekly_cash_flow(tables, since, until, building)) == want


@pytest.mark.parametrize("building", [None, 2])
def test_collections_month_dept(case, tables, building):
    sums = defaultdict(Decimal)
    for u, day, x in case.credited():
        if day.year == 2025 and building in (None, case.units[u][0]):
            sums[day.month, case.units[u][1]] += x
    want = [(m, *[sums.get((m, d)) for d in DEPARTMENTS]) for m in sorted({m for m, _ in sums})]
    assert rows(collections_month_dept(tables, 2025, DEPARTMENTS, building)) == want


def test_collections_type_period(case, tables):
    paid = defaultdict(Decimal)
    for u, day, x in case.credited():
        paid[case.units[u][0], day.year, day.month] += x
    want = []
    for (b, y, m), x in sorted(paid.items()):
        o, e = totals(case).get((b, datetime.date(y, m, 1)), (None, None))
        total = (o or 0) + (e or 0)
        part = cents(x * (o or 0) / total) if total else None
        want.append((b, y, m, x, part, None if part is None else x - part))
    assert rows(collections_type_period(tables)) == want


def test_top5(case, tables):
    def best(pairs):
        sums = defaultdict(Decimal)
        for month, x in pairs:
            sums[month] += x
        return sorted(sums.items(), key=lambda r: (-r[1], r[0]))[:2]

    want = [("gasto", *r) for r in best((m, x) for _, m, _, x in case.lines)]
    want += [("ingreso", *r) for r in best((d.replace(day=1), x) for _, d, x in case.payments)]
    got = top5_expense_income(tables.expense_lines, tables.payments, 2)
    assert [tuple(r) for r in got.collect()] == want


@pytest.mark.parametrize("copies", [3, 10_000])
def test_payment_intervals(case, tables, copies):
    dates = defaultdict(list)
    for u, day, _ in case.credited():
        dates[u].append(day)
    want = []
    for u, days in dates.items():
        days.sort()
        for before, day in zip([None, *days], days):
            want.append((u, day, before, None if before is None else (day - before).days))
    want.sort(key=lambda r: [(v is not None, v) for v in r])
    assert rows(payment_intervals(tables, copies_per_task=copies)) == want


def test_payment_days(case, tables):
    counts = defaultdict(int)
    for u, day, _ in case.credited():
        counts[u, day] += 1
    want = []
    for (u, day), n in sorted(counts.items()):
        days = sorted(d for v, d in counts if v == u)
        i = days.index(day)
        want.append((u, day, n, days[i - 1] if i else None, days[i + 1] if i + 1 < len(days) else None))
    assert rows(payment_days(tables)) == want
