"""What the plans must and must not contain."""

import contextlib
import datetime
import decimal
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledger_spark.workload.queries import QUERIES
from ledger_spark.operators.spread import lookup_join
from ledger_spark.operators.upsert import keep_latest, new_rows
from ledger_spark.plans.charges import charge_rollup, unit_charges, unit_statement
from ledger_spark.plans.delinquency import delinquency
from ledger_spark.plans.imports import match_payments
from ledger_spark.sources.store import LedgerStore
from ledger_spark.tables import LedgerTables
from ledger_spark.workload import views

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    names = {"spark.sql." + k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_cutoff_and_columns_reach_the_scan(spark):
    plan = plan_of(delinquency(views.ledger(spark, SF), datetime.date(1996, 12, 31)))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_shipdate" in line)
    assert "l_shipdate,1996" in scan.replace("1997", "1996") and "PushedFilters: [IsNotNull(l_shipdate)" in scan
    assert "l_quantity" not in scan


def test_latest_row_is_limited_before_the_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(keep_latest(df, ["k"], "id"))
    assert re.search(r"Exchange hashpartitioning\(k.*\n.*WindowGroupLimit.*Partial", plan)


def test_statement_months_are_not_shuffled(spark, tmp_path):
    tables = views.ledger(spark, SF)
    lines = tables.expense_lines.withColumn("id_expensa_consorcio", F.lit(None))
    store = LedgerStore(spark, str(tmp_path))
    store.write("expensa_consorcio", charge_rollup(lines).withColumns(
        {"id_expensa_consorcio": F.lit(None), "periodo": F.lit(None)}
    ))
    df = unit_statement(
        tables.units.withColumn("id_consorcio", F.col("id_consorcio").cast("string")),
        store.read("expensa_consorcio"),
        tables.payments,
        tables.accounts,
        tables.unit_people,
    )
    above, _, below = plan_of(df).partition("Generate explode")
    assert below and "Exchange" not in above


def test_statement_months_are_not_sorted_and_running_sums_not_broadcast(spark):
    day, money = datetime.date, decimal.Decimal
    units = [(1, 7, money("10.00")), (2, 7, None), (3, None, money("5.00")), (4, 8, money("33.33")), (5, 7, money("10.00")), (6, 7, money("1.00")), (6, 8, money("2.00")), (None, 7, money("1.00"))]
    charges = [(7, 2, "100.05", None), (7, 4, "-33.33", "1.11"), (8, 4, "9.99", None), (None, 4, "5.00", None), (7, None, "8.00", None)]
    charges = [(b, m and day(2025, m, 1), money(o), e and money(e)) for b, m, o, e in charges]
    paid = [(1, 1, "3.00"), (1, 3, "4.50"), (1, 4, "-1.00"), (1, 6, None), (3, 5, "2.00"), (6, 4, "7.00"), (9, 4, "7.00")]
    paid = [(p, day(2025, m, 15), x and money(x)) for p, m, x in paid]
    accounts = [(p, p) for p in (1, 3, 6, 9)]
    df = unit_statement(
        spark.createDataFrame(units, "id_uf long, id_consorcio int, porcentaje_de_prorrateo decimal(5,2)"),
        spark.createDataFrame(charges, "id_consorcio long, mes date, total_ordinarios decimal(18,2), total_extraordinarios decimal(18,2)"),
        spark.createDataFrame(paid, "id_persona_cuenta long, fecha_de_pago date, importe decimal(18,2)"),
        spark.createDataFrame(accounts, "id_persona_cuenta long, id_persona long"),
        spark.createDataFrame([(p, p) for p, _ in accounts], "id_uf long, id_persona long"),
    )
    above, _, below = plan_of(df).partition("Generate explode")
    assert below and "Window" not in above and "Sort" not in above
    assert "SortMergeJoin [_clave" in below.partition("Exchange")[0]
    want = []
    for ids, shares in (({1}, {7: "10.00"}), ({2}, {7: "0.00"}), ({3}, {}), ({4}, {8: "33.33"}), ({5}, {7: "10.00"}), ({None}, {7: "1.00"})):
        (unit,) = ids
        by_month = {}
        for b, m, o, e in charges:
            if m and b in shares:
                share = (o + (e or 0)) * money(shares[b]) / 100
                by_month[m] = [share.quantize(money("0.01"), decimal.ROUND_HALF_UP), money(0)]
        for p, d, x in paid:
            if p == unit:
                by_month.setdefault(d.replace(day=1), [money(0), money(0)])[1] += x or 0
        balance = money(0)
        for m, (charge, payment) in sorted(by_month.items()):
            want.append((unit, m, balance, charge, payment, balance + charge - payment))
            balance += charge - payment
    got = rows(df)
    assert [r for r in got if r[0] != 6] == sorted(want, key=lambda r: [(v is not None, v) for v in r])
    # Two units of one id: the rows of both, with the payments of the id in each.
    assert sorted((r[1].month, r[3], r[4]) for r in got if r[0] == 6) == [
        (2, money("1.00"), 0), (4, money("-0.32"), 7), (4, money("0.20"), 7)
    ]


def test_stored_rows_are_only_scanned_past_a_small_load(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    spark.createDataFrame([(5,), (2000,)], "id bigint").write.parquet(str(tmp_path / "load"))
    load = spark.read.parquet(str(tmp_path / "load"))
    fresh = new_rows(stored, load, ["id"])
    assert rows(fresh) == [(2000,)]
    assert "hashpartitioning" not in final_plan(fresh)


@pytest.mark.parametrize("kind", ["bigint", "int", "decimal(20,0)"])
def test_lookup_join_matches_keys_of_other_types(spark, kind):
    left = spark.range(5).withColumnRenamed("id", "k")
    lookup = spark.range(3).select(F.col("id").cast(kind).alias("k"), F.lit("x").alias("v"))
    assert lookup_join(left, lookup, "k").count() == 3
    assert lookup_join(left, lookup, "k", "left").where("v is null").count() == 2


@pytest.fixture
def small_skew_limits(spark):
    """Adaptive execution as on a cluster, with limits that suit a small fixture."""
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="50KB",
    ):
        yield


def final_plan(df) -> str:
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def hot(spark, rows, key):
    """Ids 0..n spread over 16 map tasks; a third of them share key 0."""
    ids = spark.range(0, rows, 1, 16).withColumnRenamed("id", "n")
    return ids.withColumn(key, F.when(F.col("n") % 3 == 0, 0).otherwise(F.col("n")))


def test_a_hot_account_number_is_split(spark, small_skew_limits):
    payments = hot(spark, 200_000, "k").select(
        F.col("n").alias("id_pago"), F.col("k").cast("string").alias("cbu_origen")
    )
    accounts = payments.select(
        F.col("cbu_origen").alias("cbu"),
        F.col("cbu_origen").alias("id_persona_cuenta"),
        F.col("cbu_origen").alias("id_persona"),
    ).distinct()
    df = match_payments(payments, accounts).select("id_pago", "estado")
    assert "SortMergeJoin(skew=true)" in final_plan(df)
    assert rows(df.groupBy("estado").count()) == [("asociado", 200_000)]


def test_a_hot_building_is_split(spark, small_skew_limits):
    units = hot(spark, 200_000, "id_consorcio").select(
        F.col("n").alias("id_uf"),
        "id_consorcio",
        F.lit("1.00").cast("decimal(5,2)").alias("porcentaje_de_prorrateo"),
    )
    buildings = units.select("id_consorcio", F.lit("x").alias("nombre")).distinct()
    money = F.lit("100").cast("decimal(18,2)")
    charges = buildings.select(
        "id_consorcio",
        F.lit("abril").alias("periodo"),
        F.make_date(F.lit(2025), F.lit(4), F.lit(1)).alias("mes"),
        money.alias("total_ordinarios"),
        money.alias("total_extraordinarios"),
    )
    people = units.select(
        F.col("id_uf").alias("id_persona"),
        F.lit(0).alias("es_inquilino"),
        *[F.lit(c).alias(c) for c in ("apellido", "nombre", "dni", "email", "telefono")],
    )
    tables = LedgerTables(
        buildings=buildings,
        charges=charges,
        expense_lines=None,
        people=people,
        units=units,
        unit_people=units.select("id_uf", F.col("id_uf").alias("id_persona")),
        accounts=units.select(
            F.col("id_uf").alias("id_persona_cuenta"), F.col("id_uf").alias("id_persona")
        ),
        payments=units.select(
            F.col("id_uf").alias("id_persona_cuenta"),
            F.make_date(F.lit(2025), F.lit(4), F.lit(1)).alias("fecha_de_pago"),
            money.alias("importe"),
        ),
    )
    owed = delinquency(tables, datetime.date(2025, 4, 30)).select("id_persona", "Morosidad")
    assert "SortMergeJoin(skew=true) [id_consorcio" in final_plan(owed)
    charged = unit_charges(units, charges).select("id_uf", "cargo")
    assert "SortMergeJoin(skew=true) [id_consorcio" in final_plan(charged)
    assert rows(charged.groupBy("cargo").count()) == [(2, 200_000)]


@pytest.mark.parametrize("kind", ["string", "decimal(9,2)", "double", "bigint"])
def test_lookup_join_matches_keys_that_are_written_otherwise(spark, kind):
    left = spark.createDataFrame([(7,), (8,), (9,)], "k int")
    keys = "'007', '8'" if kind == "string" else "7, 8"
    lookup = spark.sql(f"SELECT CAST(k AS {kind}) AS k, 1 AS v FROM (SELECT explode(array({keys})) AS k)")
    assert lookup_join(left, lookup, "k").count() == 2
    assert lookup_join(lookup, left, "k").count() == 2
    assert lookup_join(left, lookup, "k", "left").where("v is null").count() == 1
