"""Every operator run over the driver's tables.

A query returns text, bigint, double and boolean columns only (`portable`), so
that its values compare across engines; the operators themselves work on
decimals and dates.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledger_spark.functions.amounts import parse_amount
from ledger_spark.functions import categories
from ledger_spark.functions.text import month_name, month_number, month_start, normalise
from ledger_spark.operators import membership, protect, quality, reshape, upsert
from ledger_spark.operators.amount_votes import amounts_by_vote as read_by_vote
from ledger_spark.operators import periods as period_sets
from ledger_spark.plans import allocation, apportion, cash_flow, collections, currency, imports
from ledger_spark.plans import intervals, monthly, rankings, respelled
from ledger_spark.plans import charges as charging
from ledger_spark.plans import delinquency as debts
from ledger_spark.schemas import EXPENSE_CATEGORIES, MONEY, ROSTER_NAMES
from ledger_spark.session import shared_folder
from ledger_spark.sources import files
from ledger_spark.sources.store import PAYMENT_MONTH, LedgerStore
from ledger_spark.workload import views
from ledger_spark.workload.views import DEPARTMENTS, ledger, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

CUTOFF = datetime.date(1996, 12, 31)
PEPPER = "not-a-secret"
AES_KEY = "0123456789abcdef"
DIGEST_KEYS = {1: "clave-vieja", 2: "clave-nueva"}


def portable(df: DataFrame) -> DataFrame:
    def cast(field: T.StructField):
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            return F.col(field.name).cast("double")
        if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(field.name).cast("bigint")
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(field.name).cast("date").cast("string")
        return F.col(field.name)

    return df.select(*[cast(f).alias(f.name) for f in df.schema])


def query(function: Query) -> Query:
    QUERIES[function.__name__] = lambda spark, sf_dir: portable(function(spark, sf_dir))
    return function


# ---- delinquency -------------------------------------------------------


@query
def top_delinquent_owners(spark, sf_dir):
    return debts.top_delinquent_owners(ledger(spark, sf_dir), CUTOFF, include_extra=True, n=10)


@query
def top_delinquent_owners_listed(spark, sf_dir):
    return debts.top_delinquent_owners(ledger(spark, sf_dir), CUTOFF, periods=" Enero ,FEBRERO")


@query
def top_delinquent_owners_building(spark, sf_dir):
    return debts.top_delinquent_owners(
        ledger(spark, sf_dir), CUTOFF, building=7, include_extra=True, periods="marzo,abril , mayo", n=5
    )


@query
def top_delinquent_owners_dedup(spark, sf_dir):
    return debts.top_delinquent_owners(ledger(spark, sf_dir), CUTOFF, include_extra=True, n=10, dedup=True)


@query
def owner_delinquency(spark, sf_dir):
    """The report before its top-n: every owner and building."""
    return debts.delinquency(ledger(spark, sf_dir), CUTOFF, include_extra=True)


@query
def period_set(spark, sf_dir):
    charges = views.charges(spark, sf_dir)
    default = period_sets.period_set(charges).select(F.lit("default").alias("origen"), "periodo")
    listed = period_sets.period_set(charges, " Enero,enero ,MARZO,otro").select(
        F.lit("lista").alias("origen"), "periodo"
    )
    return default.unionByName(listed)


@query
def listed_charges(spark, sf_dir):
    return period_sets.charges_in_periods(views.charges(spark, sf_dir), " Enero,MARZO ,otro")


@query
def top_delinquent_owners_protected(spark, sf_dir):
    """The report for an audience that may not read personal data."""
    report = debts.top_delinquent_owners(ledger(spark, sf_dir), CUTOFF, include_extra=True, n=10)
    return protect.protected_owners(report, "reportes", ["general"], PEPPER)


# ---- cleaning ----------------------------------------------------------


def _styles(amount):
    """The same amount as text in the four separator styles of the files."""
    return _restyled(F.format_number(amount, 2))


def _restyled(english):
    return {
        "coma_punto": english,
        "punto_coma": F.translate(english, ",.", ".,"),
        "coma_coma": F.translate(english, ".", ","),
        "solo_coma": F.translate(F.translate(english, ",", ""), ".", ","),
    }


@query
def expense_amount_parse(spark, sf_dir):
    english = F.format_number(F.col("l_extendedprice").cast(MONEY), 2)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", english.alias("english")
    )
    texts = lines.withColumns(_restyled(F.col("english"))).drop("english")
    return texts.withColumns(
        {name: parse_amount(F.col(name)) for name in texts.columns if name[:2] != "l_"}
    )


@query
def amounts_by_vote(spark, sf_dir):
    """Payments as files of their suppliers: every third line without decimals; a third of the files
    with commas between thousands, a third with points, and a third of them never with decimals."""
    price = F.col("l_extendedprice").cast(MONEY)
    style = F.col("l_suppkey") % 3
    short = (F.col("l_linenumber") % 3 == 0) | (style == 2)
    english = F.when(short, F.format_number(F.floor(price), 0)).otherwise(F.format_number(price, 2))
    turned = F.translate(english, ",.", ".,")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("archivo"),
        F.when(style == 0, english).otherwise(turned).alias("texto"),
        "l_orderkey",
        "l_linenumber",
    )
    return read_by_vote(lines, "texto", ["archivo"])


@query
def month_normalise(spark, sf_dir):
    """Padded and capitalised month names of every order, back to the month."""
    padded = F.concat(F.lit(" "), F.initcap(month_name(F.month("o_orderdate"))), F.lit("  "))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        normalise(padded).alias("periodo"),
        month_number(padded).alias("nro_mes"),
        month_start(F.year("o_orderdate"), padded).alias("mes"),
    )


def _monthly_records(spark, sf_dir) -> DataFrame:
    """Monthly expense records of every building and month as JSON text.

    Orders become the categories by priority (the unpaid ones an extraordinary
    expense). Amounts mix the four styles and month names carry blanks, as in
    the files. A first record of each month is replaced by a second one.
    """
    lines = views.expense_lines(spark, sf_dir).join(
        views.buildings(spark, sf_dir), "id_consorcio"
    )
    lines = lines.withColumn("anio", F.year("mes"))
    by_class = lines.groupBy("nombre", "anio", "periodo").agg(
        F.sum(F.when(F.col("clase") == "ordinario", F.col("importe"))).alias("ordinario"),
        F.sum(F.when(F.col("clase") == "extraordinario", F.col("importe"))).alias("extraordinario"),
        F.max("importe").alias("mayor"),
        F.min("importe").alias("menor"),
    )
    ordinary, extra = _styles(F.col("ordinario")), _styles(F.col("extraordinario"))
    largest, smallest = _styles(F.col("mayor")), _styles(F.col("menor"))
    final = F.struct(
        F.concat(F.col("nombre"), F.lit(" ")).alias("Nombre del consorcio"),
        F.concat(F.initcap("periodo"), F.lit(" ")).alias("Mes"),
        ordinary["coma_coma"].alias("LIMPIEZA"),
        largest["punto_coma"].alias("SERVICIOS PUBLICOS-Agua"),
        smallest["solo_coma"].alias("SERVICIOS PUBLICOS-Luz"),
        extra["coma_punto"].alias("EXTRAORDINARIO-Obras"),
        smallest["solo_coma"].alias("EXTRAORDINARIO-Ascensor"),  # a category not seen before
    )
    draft = F.struct(
        F.col("nombre").alias("Nombre del consorcio"),
        F.col("periodo").alias("Mes"),
        smallest["coma_punto"].alias("LIMPIEZA"),
    )
    empty = F.struct(F.struct(F.lit("0").alias("$oid")).alias("_id"))
    numbered = by_class.select(
        "anio",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("posicion"), F.to_json(draft).alias("registro")),
                F.struct(F.lit(1).alias("posicion"), F.to_json(final).alias("registro")),
                F.struct(F.lit(2).alias("posicion"), F.to_json(empty).alias("registro")),
            )
        ).alias("r"),
    )
    return files.parse_monthly_expenses(numbered.select("anio", "r.*"))


@query
def import_services(spark, sf_dir):
    """Accepted expense lines and rejected records of the monthly JSON records."""
    accepted, rejected = imports.import_services(_monthly_records(spark, sf_dir), "anio")
    lost = rejected.groupBy("motivo").agg(F.count(F.lit(1)).alias("filas"))
    return (
        accepted.select(F.lit("aceptado").alias("estado"), "*", F.lit(1).alias("filas"))
        .drop("id_expensa_consorcio")
        .unionByName(
            lost.select(F.col("motivo").alias("estado"), "filas"), allowMissingColumns=True
        )
    )


@query
def json_field_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", files.json_field(F.col("props"), "k", "bigint").alias("k")
    )


@query
def objects_of_arrays(spark, sf_dir):
    """Events delivered as pretty-printed arrays of a thousand objects, nested and with braces and
    quotes in strings, several arrays to a file; read again by the blocks of the files."""
    folder = f"{shared_folder(spark)}/arrays-{uuid.uuid4().hex}"
    record = F.struct(
        "event_id",
        "user_id",
        F.from_json("props", "k bigint").alias("props"),
        F.concat(F.lit('}{"'), "event_type", F.lit('\\"},')).alias("nota"),
    )
    written = table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 1000).alias("lote"), F.to_json(record, {"pretty": "true"}).alias("objeto")
    )
    arrays = written.groupBy("lote").agg(F.array_join(F.collect_list("objeto"), ",\n").alias("objetos"))
    arrays.select(F.concat(F.lit("[ "), "objetos", F.lit(" ]"))).write.text(folder)
    found = files.read_json_array(spark, folder)
    kind = "event_id bigint, user_id bigint, props struct<k: bigint>, nota string"
    read = found.select(F.from_json("texto", kind).alias("o"))
    return read.select("o.event_id", "o.user_id", F.col("o.props.k").alias("k"), "o.nota")


def _wide_expenses(spark, sf_dir) -> DataFrame:
    """One record per building and month, one text amount per order priority."""
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    names = {
        "1-URGENT": "SERVICIOS PUBLICOS-Agua",
        "2-HIGH": "SERVICIOS PUBLICOS-Luz",
        "3-MEDIUM": "LIMPIEZA",
        "4-NOT SPECIFIED": "SEGUROS",
        "5-LOW": "EXTRAORDINARIO-Obras",
    }
    wide = (
        orders.groupBy(
            F.col("c_nationkey").cast("bigint").alias("id_consorcio"),
            F.trunc(F.col("o_orderdate").cast("date"), "month").alias("mes"),
        )
        .pivot("o_orderpriority", list(names))
        .agg(F.sum(F.col("o_totalprice").cast(MONEY)))
        .withColumnsRenamed(names)
    )
    return wide.withColumns({c: _styles(F.col(c))["punto_coma"] for c in names.values()})


@query
def expense_unpivot(spark, sf_dir):
    lines = reshape.wide_to_long(
        _wide_expenses(spark, sf_dir), ["id_consorcio", "mes"], EXPENSE_CATEGORIES
    )
    return lines.withColumn("valor", parse_amount(F.col("valor")))


@query
def expense_class(spark, sf_dir):
    lines = reshape.wide_to_long(
        _wide_expenses(spark, sf_dir), ["id_consorcio", "mes"], EXPENSE_CATEGORIES
    )
    label = F.col("rotulo")
    return lines.groupBy(
        categories.category_name(label).alias("categoria"),
        categories.category_detail(label).alias("detalle"),
        categories.expense_class(label).alias("clase"),
    ).agg(F.count(F.lit(1)).alias("lineas"), F.sum(parse_amount(F.col("valor"))).alias("importe"))


@query
def lots_union(spark, sf_dir):
    """Two lots with different columns in one table."""
    lines = views.expense_lines(spark, sf_dir)
    ordinary = (
        lines.where(F.col("clase") == "ordinario")
        .groupBy("id_consorcio", "periodo")
        .agg(F.sum("importe").alias("ordinario"))
    )
    extra = (
        lines.where(F.col("clase") == "extraordinario")
        .groupBy("id_consorcio", "periodo")
        .agg(F.sum("importe").alias("extraordinario"))
    )
    return reshape.combine_lots(ordinary, extra)


def _roster_lines(spark, sf_dir) -> DataFrame:
    """Every unit as a line of the roster file."""
    units = views.units(spark, sf_dir).join(views.unit_people(spark, sf_dir), "id_uf")
    named = units.join(views.buildings(spark, sf_dir), "id_consorcio")
    return named.select(
        F.concat_ws(
            "|",
            F.lpad(F.col("id_persona").cast("string"), 22, "0"),
            "nombre",
            F.col("id_uf").cast("string"),
            F.lit("PB"),
            "departamento",
        ).alias("linea")
    )


def _roster(spark, sf_dir) -> DataFrame:
    return files.parse_roster_lines(_roster_lines(spark, sf_dir))


@query
def roster_parse(spark, sf_dir):
    return _roster(spark, sf_dir)


@query
def roster_dimensions(spark, sf_dir):
    roster = _roster(spark, sf_dir)

    def size(kind, rows):
        return rows.groupBy("consorcio").agg(F.count(F.lit(1)).alias("filas")).withColumn(
            "dimension", F.lit(kind)
        )

    return (
        size("consorcio", reshape.roster_buildings(roster))
        .unionByName(size("unidad", reshape.roster_units(roster)))
        .unionByName(size("cuenta", reshape.roster_accounts(roster)))
    )


@query
def roster_uniqueness(spark, sf_dir):
    """Accounts named by several units, which a roster must not have."""
    return quality.duplicate_keys(_roster(spark, sf_dir), ["cbu"])


@query
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def keep_latest(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return upsert.keep_latest(
        lines,
        ["l_orderkey", "l_linenumber"],
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    )


@query
def reject_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    accepted, rejected = quality.split_rejects(
        events,
        {
            "sin usuario": F.col("user_id").isNotNull(),
            "evento de error": F.col("event_type") != "error",
            "valor bajo": F.col("value") >= 5,
        },
    )
    return accepted.withColumn("motivo", F.lit(None).cast("string")).unionByName(rejected)


# ---- imports -----------------------------------------------------------


@query
def import_buildings(spark, sf_dir):
    """Buildings named by the customers, some of them stored already."""
    raw = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.concat(F.lit(" "), F.col("n_name")).alias("nombre"), "n_regionkey")
    )
    stored = imports.import_buildings(raw.where(F.col("n_regionkey") == 0)).accepted
    return imports.import_buildings(raw.select("nombre"), stored).accepted


@query
def import_units(spark, sf_dir):
    share = F.col("porcentaje_de_prorrateo")
    raw = (
        views.units(spark, sf_dir)
        .join(views.buildings(spark, sf_dir), "id_consorcio")
        .select(
            F.col("nombre").alias("consorcio"),
            F.col("id_uf").alias("numero"),
            F.lit("PB").alias("piso"),
            F.lower("departamento").alias("departamento"),
            _styles(share)["solo_coma"].alias("porcentaje"),
        )
    )
    return imports.import_units(raw).accepted


def _raw_people(spark, sf_dir) -> DataFrame:
    """The people file: one row per order, so most people are repeated."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit(" "), "c_mktsegment").alias("nombre"),
        F.concat(F.upper("c_name"), F.lit(" ")).alias("apellido"),
        F.concat(F.lit("DNI "), F.format_number("c_custkey", 0)).alias("dni"),
        F.concat(F.lower("c_name"), F.lit("@EXAMPLE.org")).alias("email"),
        F.lit(" ").alias("telefono"),
        F.lpad(F.col("c_custkey").cast("string"), 22, "0").alias("cbu"),
        F.when(F.col("c_acctbal") < 0, "?")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "1")
        .otherwise("0")
        .alias("es_inquilino"),
    )


@query
def import_people(spark, sf_dir):
    accepted, rejected = imports.import_people(_raw_people(spark, sf_dir))
    lost = rejected.groupBy("dni", "motivo").agg(F.count(F.lit(1)).alias("filas"))
    return accepted.unionByName(lost, allowMissingColumns=True)


def _registered(spark, sf_dir) -> DataFrame:
    """Every customer as registered, and once more for each of their pending orders: every third time
    with another digit, another letter or another document under the same e-mail."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey"),
        (F.col("c_custkey") * 7919 + 10_000_000).alias("documento"),
        F.translate("c_name", "#0123456789", " abcdefghij").alias("apellido"),
        F.col("c_mktsegment").alias("nombre"),
        F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
    )
    first = customer.select(F.lit(-1).alias("caso"), F.lit(0).alias("n"), "*")
    again = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(
        (F.col("o_orderkey") % 3).cast("int").alias("caso"),
        (F.col("o_orderkey") % 7).cast("int").alias("n"),
        F.col("o_custkey").alias("c_custkey"),
    )
    everyone = first.union(again.join(customer, "c_custkey").select("caso", "n", *customer.columns))
    caso, n, document = F.col("caso"), F.col("n"), F.col("documento").cast("string")
    dni = (
        F.when(caso == 0, F.concat(document, n.cast("string")))
        .when(caso == 1, F.concat(F.lit("9"), F.substring(document, 2, 20)))
        .when(caso == 2, F.concat(F.lit("M"), F.reverse(document)))
        .otherwise(document)
    )
    return everyone.select(
        dni.alias("id_persona"),
        dni.alias("dni"),
        F.when(caso == 1, F.initcap(F.substring("nombre", 2, 20))).otherwise(F.col("nombre")).alias("nombre"),
        F.when((caso == 2) & (n > 3), F.concat("apellido", F.lit("k"))).otherwise(F.col("apellido")).alias("apellido"),
        F.when((caso == -1) | (caso == 2), F.col("email")).alias("email"),
    ).distinct()


@query
def similar_people(spark, sf_dir):
    """People who may be registered twice under another spelling."""
    return respelled.similar_people(_registered(spark, sf_dir))


@query
def people_groups(spark, sf_dir):
    """The same people in groups."""
    return respelled.people_groups(_registered(spark, sf_dir))


@query
def import_unit_people(spark, sf_dir):
    """Links for the known accounts, and the roster rows of unknown ones."""
    roster = _roster(spark, sf_dir)
    accounts = imports.import_accounts(_known_people(spark, sf_dir)).accepted
    accepted, rejected = imports.import_unit_people(
        roster, accounts, imports.import_units(roster).accepted
    )
    return accepted.unionByName(rejected.drop("cbu"), allowMissingColumns=True)


def _known_people(spark, sf_dir) -> DataFrame:
    """People whose account is already registered: those without an overdraft."""
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("string").alias("dni"),
        F.lpad(F.col("c_custkey").cast("string"), 22, "0").alias("cbu"),
    )


@query
def import_suppliers(spark, sf_dir):
    raw = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lower("s_name"), F.lit(" ")).alias("nombre"),
            F.lit("servicios").alias("rubro"),
            F.col("n_name").alias("consorcio"),
        )
    )
    return imports.import_suppliers(raw).accepted


def _bank_export(spark, sf_dir) -> DataFrame:
    """Every order's line items as bank transfers, numbered by their order."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    per_order = lines.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("fecha"),
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("importe"),
    )
    return per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("id_pago"),
        F.date_format("fecha", "dd/MM/yyyy").alias("fecha"),
        F.lpad(F.col("o_custkey").cast("string"), 22, "0").alias("cbu_origen"),
        _styles(F.col("importe"))["punto_coma"].alias("importe"),
    )


def _imported_payments(spark, sf_dir) -> DataFrame:
    accounts = views.accounts(spark, sf_dir).join(
        table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0),
        F.col("id_persona") == F.col("c_custkey"),
        "left_semi",
    )
    return imports.import_payments(_bank_export(spark, sf_dir), accounts).accepted


@query
def import_payments(spark, sf_dir):
    return _imported_payments(spark, sf_dir)


@query
def unmatched_payments(spark, sf_dir):
    return _imported_payments(spark, sf_dir).where(F.col("estado") == imports.UNMATCHED)


@query
def rounded_payments(spark, sf_dir):
    """The bank export after a spreadsheet wrote zeros over the last seven digits of the account
    numbers. An account number is a third of the customer's key and what tells the three apart, which
    is lost for customers in debt only."""
    customer = table(spark, sf_dir, "customer")
    group = F.lpad(F.floor(F.col("c_custkey") / 3).cast("string"), 14, "0")
    last = (F.col("c_custkey") % 3).cast("string")
    in_debt = F.col("c_acctbal") < 0
    cbu = F.concat(
        group, F.when(in_debt, "9").otherwise(last), F.lit("123456"), F.when(in_debt, last).otherwise("7")
    )
    accounts = customer.select(
        F.col("c_custkey").alias("id_persona_cuenta"),
        F.col("c_custkey").alias("id_persona"),
        cbu.alias("cbu"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id_pago"), F.col("o_custkey").alias("id_persona"), "o_orderstatus"
    )
    delivered = F.when(F.col("o_orderstatus") == "P", F.col("cbu")).otherwise(
        F.concat(F.substring("cbu", 1, 15), F.lit("0000000"))
    )
    payments = orders.join(accounts.select("id_persona", "cbu"), "id_persona").select(
        "id_pago", delivered.alias("cbu_origen")
    )
    return imports.match_rounded(payments, accounts)


@query
def rematch_payments(spark, sf_dir):
    """The same payments once every account is registered."""
    return imports.rematch_payments(
        _imported_payments(spark, sf_dir), views.accounts(spark, sf_dir)
    )


@query
def chain_payments(spark, sf_dir):
    """The payment chain over delivered files, in the order a month has: units, some of the people,
    the bank export, more people, matched again. Accounts of one segment stay unknown."""
    folder = f"{shared_folder(spark)}/chain-{uuid.uuid4().hex}"
    store = LedgerStore(spark, f"{folder}/ledger")

    def delivered(name: str, df: DataFrame) -> str:
        df.write.csv(f"{folder}/{name}", sep="|", header=True)
        return f"{folder}/{name}"

    customer = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY")

    def people(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("c_mktsegment").alias("nombre"),
            F.col("c_name").alias("apellido"),
            F.col("c_custkey").cast("string").alias("dni"),
            F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
            F.lit(None).cast("string").alias("telefono"),
            F.lpad(F.col("c_custkey").cast("string"), 22, "0").alias("cbu"),
            F.lit("0").alias("es_inquilino"),
        )

    names = {plain: header for header, plain in ROSTER_NAMES.items()}
    roster = delivered("roster", _roster(spark, sf_dir).withColumnsRenamed(names))
    monthly.load_roster(store, roster)
    early, late = F.col("c_acctbal") >= 0, F.col("c_acctbal") < 0
    monthly.load_people(store, delivered("people", people(customer.where(early))), roster)
    monthly.load_payments(store, delivered("bank", _bank_export(spark, sf_dir)))
    monthly.load_people(store, delivered("late", people(customer.where(late))), roster)
    monthly.rematch_payments(store)
    return store.read("pago").drop(PAYMENT_MONTH)


def _lots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Latest order per customer before 1998, and from then on."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    start = F.lit(datetime.date(1998, 1, 1))

    def latest(lot):
        return upsert.keep_latest(lot, ["o_custkey"], "o_orderdate", "o_orderkey")

    return (
        latest(orders.where(F.col("o_orderdate") < start)),
        latest(orders.where(F.col("o_orderdate") >= start)),
    )


@query
def idempotent_upsert(spark, sf_dir):
    stored, incoming = _lots(spark, sf_dir)
    once = upsert.idempotent_upsert(stored, incoming, ["o_custkey"])
    return upsert.idempotent_upsert(once, incoming, ["o_custkey"])


@query
def idempotent_upsert_newest(spark, sf_dir):
    stored, incoming = _lots(spark, sf_dir)
    once = upsert.idempotent_upsert(stored, incoming, ["o_custkey"], "newest_wins", "o_orderkey")
    return upsert.idempotent_upsert(once, incoming, ["o_custkey"], "newest_wins", "o_orderkey")


@query
def quotes_latest(spark, sf_dir):
    return imports.quotes_latest(
        table(spark, sf_dir, "events").select(
            F.col("event_type").alias("moneda"),
            F.col("ts").cast("date").alias("fecha"),
            F.col("value").alias("venta"),
            F.col("event_id").alias("secuencia"),
        )
    )


@query
def curated_payments(spark, sf_dir):
    """Payments written to the curated layout, and one year read back from it."""
    name = sf_dir.rstrip("/").rsplit("/", 1)[-1]
    run = uuid.uuid4().hex
    store = LedgerStore(spark, f"{shared_folder(spark)}/curated-{run}-{name}")
    rows = views.payments(spark, sf_dir)
    missing = [c for c in ("id_pago", "cbu_origen", "estado")]
    store.write("pago", rows.withColumns({c: F.lit(None) for c in missing}), mode="overwrite")
    kept = store.payments(datetime.date(1996, 1, 1), CUTOFF)
    return kept.select(F.col("id_persona_cuenta").cast("bigint"), "fecha_de_pago", "importe")


# ---- charges and reports -----------------------------------------------


@query
def charge_rollup(spark, sf_dir):
    return charging.charge_rollup(views.expense_lines(spark, sf_dir))


@query
def generate_charges(spark, sf_dir):
    lines = views.expense_lines(spark, sf_dir)
    first_year = lines.where(F.col("mes") < F.lit(datetime.date(1996, 1, 1)))
    return imports.generate_charges(lines, imports.generate_charges(first_year))


@query
def charge_reconciliation(spark, sf_dir):
    """What is still to be charged after the first years were."""
    lines = views.expense_lines(spark, sf_dir)
    first_year = lines.where(F.col("mes") < F.lit(datetime.date(1996, 1, 1)))
    return imports.charge_reconciliation(lines, imports.generate_charges(first_year))


@query
def unit_charges(spark, sf_dir):
    return charging.unit_charges(
        views.units(spark, sf_dir), charging.charge_rollup(views.expense_lines(spark, sf_dir))
    )


@query
def unit_statement(spark, sf_dir):
    tables = ledger(spark, sf_dir)
    return charging.unit_statement(
        tables.units,
        charging.charge_rollup(tables.expense_lines),
        tables.payments,
        tables.accounts,
        tables.unit_people,
    )


@query
def unit_charges_exact(spark, sf_dir):
    return apportion.unit_charges_exact(
        views.units(spark, sf_dir), charging.charge_rollup(views.expense_lines(spark, sf_dir))
    )


@query
def payment_allocation(spark, sf_dir):
    tables = ledger(spark, sf_dir)
    return allocation.payment_allocation(tables, charging.charge_rollup(tables.expense_lines))


@query
def debt_by_age(spark, sf_dir):
    tables = ledger(spark, sf_dir)
    charges = charging.charge_rollup(tables.expense_lines)
    return allocation.debt_by_age(tables, charges, CUTOFF)


@query
def unpaid_spells(spark, sf_dir):
    tables = ledger(spark, sf_dir)
    return intervals.unpaid_spells(tables, charging.charge_rollup(tables.expense_lines), CUTOFF)


def _converted(spark, sf_dir) -> DataFrame:
    """Every payment in two currencies at the quote of its day, or the last one before it. Events are
    the quotes: an event type is a currency, an hour of the month one of 720 days three apart."""
    hours = (F.dayofmonth("ts") - 1) * 24 + F.hour("ts")
    quotes = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("moneda"),
        F.date_add(F.lit(datetime.date(1995, 6, 1)), hours * 3).alias("fecha"),
        (F.col("value") + 1).alias("venta"),
        F.col("event_id").alias("secuencia"),
    )
    return currency.payments_in_currency(
        views.payments(spark, sf_dir), quotes, ["purchase", "view"]
    )


@query
def payments_in_currency(spark, sf_dir):
    return _converted(spark, sf_dir)


@query
def payments_without_quote(spark, sf_dir):
    return currency.without_quote(_converted(spark, sf_dir))


@query
def weekly_cash_flow(spark, sf_dir):
    return cash_flow.weekly_cash_flow(ledger(spark, sf_dir))


@query
def weekly_cash_flow_building(spark, sf_dir):
    return cash_flow.weekly_cash_flow(
        ledger(spark, sf_dir), datetime.date(1996, 1, 1), datetime.date(1999, 6, 30), building=3
    )


@query
def collections_month_dept(spark, sf_dir):
    return collections.collections_month_dept(ledger(spark, sf_dir), 1997, DEPARTMENTS)


@query
def collections_type_period(spark, sf_dir):
    """Split by the charges of the month name, years pooled."""
    return collections.collections_type_period(ledger(spark, sf_dir))


@query
def collections_type_month(spark, sf_dir):
    """Split by the charges of the very month."""
    tables = ledger(spark, sf_dir)
    return collections.collections_type_period(tables, charging.charge_rollup(tables.expense_lines))


@query
def top5_expense_income(spark, sf_dir):
    tables = ledger(spark, sf_dir)
    return rankings.top5_expense_income(tables.expense_lines, tables.payments)


@query
def payment_intervals(spark, sf_dir):
    return intervals.payment_intervals(ledger(spark, sf_dir))


@query
def payment_days(spark, sf_dir):
    return intervals.payment_days(ledger(spark, sf_dir))


# ---- protection and audits ---------------------------------------------


@query
def protected_owners(spark, sf_dir):
    return protect.protected_owners(views.people(spark, sf_dir), "reportes", ["general"], PEPPER)


@query
def encrypted_owners(spark, sf_dir):
    """Encrypted and decrypted again: the values must come back."""
    people = views.people(spark, sf_dir)
    hidden = protect.encrypt_columns(people, protect.PERSONAL_COLUMNS, AES_KEY)
    return protect.decrypt_columns(hidden, protect.PERSONAL_COLUMNS, AES_KEY)


@query
def payments_across_keys(spark, sf_dir):
    """What each payer paid, by digest of the account: the key was changed at the cut-off, and tenants'
    accounts were not carried over to the new one."""
    accounts = views.accounts(spark, sf_dir).select("id_persona_cuenta", "id_persona", "cbu")
    payments = protected_payments(views.payments(spark, sf_dir), accounts)
    owners = views.people(spark, sf_dir).where("es_inquilino = 0").select("id_persona")
    bridge = protect.key_bridge(
        accounts.join(owners, "id_persona", "left_semi"), "cbu", DIGEST_KEYS, 1, 2
    )
    # Summed by digest before the change of keys, so that it meets no row of a payment.
    sums = payments.groupBy(protect.KEY_NUMBER, "cbu").agg(
        F.count("*").alias("pagos"), F.sum("importe").alias("total")
    )
    one = protect.under_new_key(sums, "cbu", bridge)
    return one.groupBy(protect.KEY_NUMBER, "cbu").agg(
        F.sum("pagos").alias("pagos"), F.sum("total").alias("total")
    )


def protected_payments(payments: DataFrame, accounts: DataFrame) -> DataFrame:
    """Payments with digests of their accounts, up to the cut-off under the first key, then the second."""
    early = F.col("fecha_de_pago") <= F.lit(CUTOFF)
    lots = [
        protect.keyed_columns(accounts.select("id_persona_cuenta", "cbu"), ["cbu"], DIGEST_KEYS, number)
        .join(payments.where(when), "id_persona_cuenta")
        .select(protect.KEY_NUMBER, "cbu", "importe")
        for number, when in ((1, early), (2, ~early))
    ]
    return lots[0].union(lots[1])


@query
def effective_access(spark, sf_dir):
    """Events as permission statements of a user on an object; errors deny."""
    return membership.effective_access(
        table(spark, sf_dir, "events").select(
            F.col("user_id").alias("rol"),
            files.json_field(F.col("props"), "k", "bigint").alias("objeto"),
            F.when(F.col("event_type") == "error", "DENY").otherwise("GRANT").alias("accion"),
        )
    )


@query
def effective_access_users(spark, sf_dir):
    """Events as statements on objects, sign-ups on whole schemas; customers are the roles of users."""
    key = files.json_field(F.col("props"), "k", "bigint")
    events = table(spark, sf_dir, "events").withColumn("k", key)
    schema = F.floor(F.col("k") / 10).cast("bigint").alias("esquema")
    statements = events.select(
        F.col("user_id").alias("rol"),
        schema,
        F.when(F.col("event_type") != "signup", F.col("k")).alias("objeto"),
        F.when(F.col("value") < 50, "EXECUTE").otherwise("ALTER").alias("permiso"),
        F.when(F.col("event_type") == "error", "DENY").otherwise("GRANT").alias("accion"),
    )
    user = F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string"))
    members = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("rol"), user.alias("miembro")
    )
    objects = events.select(schema, F.col("k").alias("objeto"))
    return membership.effective_access_users(statements, members, objects)


@query
def effective_access_nested(spark, sf_dir):
    """The same statements, where each role is a member of the one of a quarter of its number, and the
    outer one of that of a customer in debt: circles."""
    key = files.json_field(F.col("props"), "k", "bigint")
    events = table(spark, sf_dir, "events").withColumn("k", key)
    schema = F.floor(F.col("k") / 10).cast("bigint").alias("esquema")
    statements = events.select(
        F.col("user_id").alias("rol"),
        schema,
        F.when(F.col("event_type") != "signup", F.col("k")).alias("objeto"),
        F.when(F.col("value") < 50, "EXECUTE").otherwise("ALTER").alias("permiso"),
        F.when(F.col("event_type") == "error", "DENY").otherwise("GRANT").alias("accion"),
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("rol"),
        F.floor(F.col("c_custkey") / 4).cast("bigint").alias("dentro_de"),
        "c_acctbal",
    )
    back = customer.where("c_acctbal < -900").select(
        F.col("dentro_de").alias("rol"), F.col("rol").alias("dentro_de")
    )
    nested = customer.select("rol", "dentro_de").union(back)
    members = customer.select("rol", F.concat(F.lit("u"), F.col("rol").cast("string")).alias("miembro"))
    objects = events.select(schema, F.col("k").alias("objeto"))
    return membership.effective_access_nested(statements, members, objects, nested)


@query
def missing_members(spark, sf_dir):
    pairs = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("rol"),
        F.col("o_custkey").alias("miembro"),
        "o_orderstatus",
    )
    return membership.missing_members(pairs, pairs.where(F.col("o_orderstatus") == "F"))


@query
def people_with_units(spark, sf_dir):
    return membership.exists_in(
        views.people(spark, sf_dir), views.unit_people(spark, sf_dir), ["id_persona"]
    )


@query
def people_in_list(spark, sf_dir):
    return membership.in_list(
        views.people(spark, sf_dir), "nombre", ["HOUSEHOLD", "BUILDING", "OTHER"]
    )
