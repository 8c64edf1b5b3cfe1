"""Loads of the delivered files into ledger tables.

Each load returns the rows to append (keys not stored yet, so a repeated load
appends nothing) and the rejected rows with the reason in ``motivo``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger_spark.functions.amounts import or_zero, parse_amount, parse_percent
from ledger_spark.functions.categories import category_detail, category_name, expense_class
from ledger_spark.functions.text import blank_to_null, month_name, month_start, normalise
from ledger_spark.operators.membership import missing_from
from ledger_spark.operators.quality import Split, duplicate_keys, split_rejects
from ledger_spark.operators.spread import lookup_join
from ledger_spark.operators.upsert import keep_latest, new_rows
from ledger_spark.plans.charges import charge_rollup
from ledger_spark.schemas import CORRUPT, MONEY, TOTAL

MATCHED = "asociado"
UNMATCHED = "no asociado"


def building_id(name: Column) -> Column:
    return normalise(blank_to_null(name))


def unit_id(building: Column, number: Column) -> Column:
    """Building id and unit number; NULL if either is missing."""
    return F.concat(building, F.lit("|"), number.cast("string"))


def _present(column: str) -> Column:
    return F.col(column).isNotNull()


def _one_per_key(df: DataFrame, key: str) -> Split:
    """One row per key, chosen by the other columns so that a rerun chooses alike; rows of the
    same key and other content are rejected. Identical copies are one row.

    Rejects are looked for among the keys that occur more than once only, which a count of the keys
    tells; the rows of a key that occurs very often are split over tasks.
    """
    others = [c for c in df.columns if c != key]
    if not others:
        rows = df.distinct()
        return Split(rows, rows.withColumn("motivo", F.lit("")).where(F.lit(False)))
    content = F.struct(*others)
    found = df.groupBy(key).agg(F.max(content).alias("_elegida"))
    several = df.groupBy(key).agg(F.count(F.lit(1)).alias("_filas")).where("_filas > 1")
    copies = lookup_join(df, several, key).drop("_filas")
    repeated = (
        lookup_join(copies, copies.groupBy(key).agg(F.max(content).alias("_elegida")), key)
        .where(~content.eqNullSafe(F.col("_elegida")))
        .select(*df.columns, F.lit("clave repetida").alias("motivo"))
        .distinct()
    )
    return Split(found.select(key, "_elegida.*").select(*df.columns), repeated)


def _changed(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is stored with other content. What a row leaves open is no change."""
    compared = [c for c in rows.columns if c in existing.columns and c not in keys]
    if not compared:
        return rows.withColumn("motivo", F.lit("")).where(F.lit(False))
    wanted = rows.select(*[F.col(k).alias(f"_n_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys]
    stored = existing.join(wanted, reduce(Column.__and__, same), "left_semi").select(
        *[F.col(c).alias(f"_s_{c}") for c in [*keys, *compared]]
    )
    at = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    other = [F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in compared]
    return (
        rows.join(stored, reduce(Column.__and__, at))
        .where(reduce(Column.__or__, other))
        .select(*rows.columns, F.lit("clave ya cargada").alias("motivo"))
        .distinct()
    )


def _typed(raw: DataFrame, *columns: Column | str) -> DataFrame:
    """The typed columns, and the text of unreadable lines where the source keeps it."""
    return raw.select(*columns, *[c for c in (CORRUPT,) if c in raw.columns])


def _split(typed: DataFrame, rules: dict[str, Column]) -> Split:
    if CORRUPT in typed.columns:
        rules = {"linea ilegible": F.col(CORRUPT).isNull()} | rules
    accepted, rejected = split_rejects(typed, rules)
    return Split(accepted.drop(CORRUPT), rejected)


def _load(
    typed: DataFrame,
    rules: dict[str, Column],
    keys: list[str],
    existing: DataFrame | None,
    texts: list[str] = (),
) -> Split:
    """Rows in = rows to append + rows stored already + identical copies + rejected rows.

    ``texts`` are columns kept for the rejected rows only: the text that could not be read.
    """
    accepted, rejected = _split(typed, rules)
    rows, repeated = _one_per_key(accepted.drop(*texts), keys[0])
    rejected = rejected.unionByName(repeated, allowMissingColumns=True)
    if existing is None:
        return Split(rows, rejected)
    changed = _changed(existing, rows, keys)
    return Split(
        new_rows(existing, rows, keys), rejected.unionByName(changed, allowMissingColumns=True)
    )


def import_buildings(raw: DataFrame, existing: DataFrame | None = None) -> Split:
    """From any rows with the building name in ``nombre``."""
    typed = _typed(
        raw, building_id(F.col("nombre")).alias("id_consorcio"), F.trim("nombre").alias("nombre")
    )
    return _load(typed, {"sin nombre": _present("id_consorcio")}, ["id_consorcio"], existing)


def import_units(raw: DataFrame, existing: DataFrame | None = None) -> Split:
    """From roster rows; ``porcentaje`` is text where the file has one."""
    text = blank_to_null(F.col("porcentaje")) if "porcentaje" in raw.columns else F.lit(None)
    share = parse_percent(text.cast("string"))
    building = building_id(F.col("consorcio"))
    typed = _typed(
        raw,
        unit_id(building, F.col("numero")).alias("id_uf"),
        building.alias("id_consorcio"),
        F.col("numero").cast("bigint").alias("numero"),
        blank_to_null(F.col("piso")).alias("piso"),
        F.upper(blank_to_null(F.col("departamento"))).alias("departamento"),
        share.alias("porcentaje_de_prorrateo"),
        (text.isNull() | share.isNotNull()).alias("porcentaje_legible"),
    )
    rules = {
        "sin consorcio": _present("id_consorcio"),
        "sin numero": _present("numero"),
        "porcentaje ilegible": F.col("porcentaje_legible"),
    }
    accepted, rejected = _load(typed, rules, ["id_uf"], existing)
    return Split(accepted.drop("porcentaje_legible"), rejected)


def typed_people(raw: DataFrame) -> DataFrame:
    """People with trimmed names, lower-case e-mail and document numbers without separators."""
    document = document_number(F.col("dni"))
    return _typed(
        raw,
        document.alias("id_persona"),
        F.initcap(blank_to_null(F.col("nombre"))).alias("nombre"),
        F.initcap(blank_to_null(F.col("apellido"))).alias("apellido"),
        document.alias("dni"),
        normalise(blank_to_null(F.col("email"))).alias("email"),
        blank_to_null(F.col("telefono")).alias("telefono"),
        F.trim("es_inquilino").try_cast("int").alias("es_inquilino"),
    )


def document_number(text: Column) -> Column:
    """Without the label DNI and separators; a leading letter is part of the number. NULL where
    nothing is left."""
    bare = F.regexp_replace(F.upper(text), r"[\s.,:\-]", "")
    return F.nullif(F.regexp_replace(bare, "^DNI", ""), F.lit(""))


def _readable(document: Column) -> Column:
    return document.rlike("^[A-Z]?[0-9]+$")


def import_people(raw: DataFrame, existing: DataFrame | None = None) -> Split:
    rules = {
        "sin documento": _present("dni"),
        "documento ilegible": _readable(F.col("dni")),
        "tipo de persona": F.col("es_inquilino").isin(0, 1),
    }
    return _load(typed_people(raw), rules, ["id_persona"], existing)


def import_accounts(raw_people: DataFrame, existing: DataFrame | None = None) -> Split:
    """Each person's account number, from the people file."""
    cbu = blank_to_null(F.col("cbu"))
    typed = _typed(
        raw_people,
        cbu.alias("id_persona_cuenta"),
        document_number(F.col("dni")).alias("id_persona"),
        cbu.alias("cbu"),
    )
    rules = {
        "sin cuenta": _present("cbu"),
        "sin documento": _present("id_persona"),
        "documento ilegible": _readable(F.col("id_persona")),
    }
    return _load(typed, rules, ["id_persona_cuenta"], existing)


def import_unit_people(
    roster: DataFrame, accounts: DataFrame, units: DataFrame, existing: DataFrame | None = None
) -> Split:
    """Who lives in or owns which unit: the roster's account names the person."""
    building = building_id(F.col("consorcio"))
    rows = _typed(
        roster,
        blank_to_null(F.col("cbu")).alias("cbu"),
        unit_id(building, F.col("numero")).alias("id_uf"),
    )
    known_units = units.select("id_uf", F.lit(True).alias("unit_known"))
    with_person = lookup_join(rows, one_account_per_number(accounts), "cbu", "left")
    resolved = lookup_join(with_person, known_units, "id_uf", "left")
    rules = {"unidad desconocida": F.col("unit_known"), "cuenta desconocida": _present("id_persona")}
    accepted, rejected = _split(resolved, rules)
    links = accepted.select("id_uf", "id_persona")
    keys = ["id_uf", "id_persona"]
    fresh = links.distinct() if existing is None else new_rows(existing, links.distinct(), keys)
    line = [c for c in (CORRUPT,) if c in rejected.columns]
    return Split(fresh, rejected.select("cbu", "id_uf", *line, "motivo"))


def import_suppliers(raw: DataFrame, existing: DataFrame | None = None) -> Split:
    typed = _typed(
        raw,
        F.upper(blank_to_null(F.col("nombre"))).alias("nombre"),
        blank_to_null(F.col("rubro")).alias("rubro"),
        building_id(F.col("consorcio")).alias("consorcio"),
    )
    return _load(typed, {"sin nombre": _present("nombre")}, ["nombre"], existing)


def import_services(
    records: DataFrame,
    year: int | str,
    existing: DataFrame | None = None,
    repeated: str = "keep_last",
) -> Split:
    """Expense lines from monthly expense records.

    ``year`` is a number, or the name of a column that holds it. Of several
    records of one building and month the last one of the source (by
    ``posicion``) counts and the others are rejected as replaced; with
    ``repeated="reject"`` none counts. Rejected are also records without
    building or month, single lines without a readable amount, and lines
    stored already with another amount.
    """
    if repeated not in ("keep_last", "reject"):
        raise ValueError(f"unknown policy {repeated!r}")
    month = ["id_consorcio", "mes"]
    year_value = F.col(year) if isinstance(year, str) else F.lit(year)
    keyed = records.withColumn("id_consorcio", building_id(F.col("consorcio"))).withColumn(
        "mes", month_start(year_value, F.col("periodo"))
    )
    complete, incomplete = _split(
        keyed, {"sin consorcio": _present("id_consorcio"), "sin mes": _present("mes")}
    )
    if repeated == "reject":
        twice = duplicate_keys(complete, month).withColumn("motivo", F.lit("registro repetido"))
        incomplete = incomplete.unionByName(
            complete.join(twice.drop("filas"), month), allowMissingColumns=True
        )
        complete = missing_from(complete, twice, month)
    else:
        # A digest of the month as the only key: records of one month may be very many.
        ranked = complete.withColumn("_mes", F.xxhash64(*month))
        last = ranked.groupBy("_mes").agg(F.max("posicion").alias("_ultima"))
        ranked = lookup_join(ranked, last, "_mes").drop("_mes")
        replaced = ranked.where(F.col("posicion") != F.col("_ultima")).drop("_ultima")
        complete = ranked.where(F.col("posicion") == F.col("_ultima")).drop("_ultima")
        incomplete = incomplete.unionByName(
            replaced.withColumn("motivo", F.lit("registro reemplazado")), allowMissingColumns=True
        )
    lines = complete.select(*month, F.explode("rubros").alias("rotulo", "valor")).where(
        F.col("valor").isNotNull()
    )
    rotulo = F.col("rotulo")
    typed = lines.select(
        F.concat_ws("|", "id_consorcio", F.date_format("mes", "yyyy-MM")).alias(
            "id_expensa_consorcio"
        ),
        "id_consorcio",
        "mes",
        category_name(rotulo).alias("categoria"),
        category_detail(rotulo).alias("detalle"),
        expense_class(rotulo).alias("clase"),
        parse_amount(F.col("valor")).alias("importe"),
        "valor",
    )
    good, bad = split_rejects(typed, {"importe ilegible": _present("importe")})
    good = good.drop("valor")
    told = [c for c in ("oid", CORRUPT) if c in incomplete.columns]
    rejected = incomplete.select("id_consorcio", "mes", "periodo", *told, "motivo").unionByName(
        bad.select("id_consorcio", "mes", F.col("categoria"), "valor", "motivo"),
        allowMissingColumns=True,
    )
    keys = ["id_consorcio", "mes", "categoria", "detalle"]
    if existing is None:
        return Split(good, rejected)
    changed = _changed(existing, good, keys).drop("id_expensa_consorcio", "clase", "detalle")
    changed = changed.withColumn("valor", F.col("importe").cast("string")).drop("importe")
    return Split(
        new_rows(existing, good, keys), rejected.unionByName(changed, allowMissingColumns=True)
    )


def generate_charges(expense_lines: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Charge rows per building and month. A month charged already stays as it is; lines that came
    later are charged as one more row of that month, with what they add. Without new lines
    nothing is added, so the totals of charges and lines always agree.
    """
    totals = ["total_ordinarios", "total_extraordinarios"]
    rows = charge_rollup(expense_lines, ["id_consorcio", "mes"])
    month = F.concat_ws("|", "id_consorcio", F.date_format("mes", "yyyy-MM"))
    number = month
    if existing is not None:
        charged = existing.groupBy("id_consorcio", "mes").agg(
            F.count(F.lit(1)).alias("_filas"),
            *[F.sum(or_zero(F.col(c))).alias(f"_{c}") for c in totals],
        )
        known = F.col("_filas").isNotNull()
        rest = {
            c: F.when(~known, F.col(c)).otherwise(or_zero(F.col(c)) - F.col(f"_{c}")).cast(MONEY)
            for c in totals
        }
        differs = reduce(Column.__or__, [F.col(c) != 0 for c in totals])
        rows = (
            rows.join(charged, ["id_consorcio", "mes"], "left")
            .withColumns(rest)
            .where(~known | F.coalesce(differs, F.lit(False)))
        )
        number = F.when(known, F.concat_ws("|", month, F.lit("ajuste"), "_filas")).otherwise(month)
    return rows.select(
        number.alias("id_expensa_consorcio"),
        "id_consorcio",
        month_name(F.month("mes")).alias("periodo"),
        "mes",
        *totals,
    )


def charge_reconciliation(expense_lines: DataFrame, charges: DataFrame) -> DataFrame:
    """Building months whose expense lines and charges do not add up to the same: the total of
    each (0 where there is none) and the difference."""
    amount = or_zero(F.col("total_ordinarios")) + or_zero(F.col("total_extraordinarios"))
    month = ["id_consorcio", "mes"]
    spent = expense_lines.groupBy(*month).agg(F.sum(or_zero(F.col("importe"))).alias("gastos"))
    charged = charges.groupBy(*month).agg(F.sum(amount).alias("expensas"))
    gastos, expensas = or_zero(F.col("gastos")), or_zero(F.col("expensas"))
    return (
        spent.join(charged, month, "full")
        .select(
            *month,
            gastos.cast(TOTAL).alias("gastos"),
            expensas.cast(TOTAL).alias("expensas"),
            (gastos - expensas).cast(TOTAL).alias("diferencia"),
        )
        .where(F.col("diferencia") != 0)
    )


def one_account_per_number(accounts: DataFrame) -> DataFrame:
    """Account by number; a number stored twice must not double its payments."""
    wanted = accounts.where(F.col("cbu").isNotNull()).select("cbu", "id_persona_cuenta", "id_persona")
    return keep_latest(wanted, ["cbu"], "id_persona_cuenta", "id_persona")


def match_payments(payments: DataFrame, accounts: DataFrame) -> DataFrame:
    """Set the account and state of payments by their account number.

    Payments that have an account keep it and meet no row of the join. The
    left join keeps every payment. An account number, or the absence of one,
    may stand in any share of the payments.
    """
    known = one_account_per_number(accounts).select(
        F.col("cbu").alias("_cbu"), F.col("id_persona_cuenta").alias("_cuenta")
    )
    own = F.lit(None)
    if "id_persona_cuenta" in payments.columns:
        own = F.col("id_persona_cuenta")
    others = [c for c in payments.columns if c not in ("id_persona_cuenta", "estado")]
    asked = payments.select(
        *others, own.alias("_propia"), F.when(own.isNull(), F.col("cbu_origen")).alias("_cbu")
    )
    account = F.coalesce("_propia", "_cuenta")
    state = F.when(account.isNotNull(), MATCHED).otherwise(UNMATCHED)
    return lookup_join(asked, known, "_cbu", "left").select(
        *others, account.alias("id_persona_cuenta"), state.alias("estado")
    )


AMBIGUOUS = "ambiguo"


def match_rounded(
    payments: DataFrame, accounts: DataFrame, lost_digits: int = 7
) -> DataFrame:
    """Set the account of payments whose account number lost its last digits to a spreadsheet.

    A number that is stored as it was delivered matches as always. Else a number whose last
    ``lost_digits`` digits are zeros matches the accounts that begin like it and are as long: a
    single one is taken; of several none is, the payment is ambiguous and ``candidatos`` says how
    many there are. ``candidatos`` is 1 for a match, 0 where nothing fits and NULL for a payment
    that names no account number.

    Accounts become one row per beginning before they meet the payments, so an ambiguous beginning
    multiplies nothing, and any share of the payments may have the same number.
    """
    exact = match_payments(payments, accounts)
    zeros = "0" * lost_digits
    own, number = F.col("id_persona_cuenta"), F.col("cbu_origen")

    def beginning(digits: Column) -> Column:
        """What is left of a number, with its length."""
        kept = F.length(digits) - lost_digits
        return F.concat_ws(":", F.length(digits), F.substring(digits, F.lit(1), kept))

    several = F.countDistinct("id_persona_cuenta").alias("_cuantas")
    known = (
        one_account_per_number(accounts)
        .where(F.length("cbu") > lost_digits)
        .groupBy(beginning(F.col("cbu")).alias("_inicio"))
        .agg(several, F.min("id_persona_cuenta").alias("_cuenta"))
    )
    cut = own.isNull() & number.endswith(zeros) & (F.length(number) > lost_digits)
    rows = exact.withColumn("_inicio", F.when(cut, beginning(number)))
    found = lookup_join(rows, known, "_inicio", "left")
    account = F.coalesce(own, F.when(F.col("_cuantas") == 1, F.col("_cuenta")))
    state = F.when(account.isNotNull(), MATCHED).when(F.col("_cuantas") > 1, AMBIGUOUS)
    count = F.when(own.isNotNull(), 1).otherwise(F.coalesce("_cuantas", F.lit(0)))
    others = [c for c in exact.columns if c not in ("id_persona_cuenta", "estado")]
    return found.select(
        *others,
        account.alias("id_persona_cuenta"),
        state.otherwise(UNMATCHED).alias("estado"),
        F.when(number.isNotNull(), count).cast("bigint").alias("candidatos"),
    )


def import_payments(
    raw: DataFrame,
    accounts: DataFrame,
    existing: DataFrame | None = None,
    date_format: str = "dd/MM/yyyy",
) -> Split:
    """Bank payments; those of an unknown account are kept as unmatched."""
    typed = _typed(
        raw,
        "id_pago",
        F.try_to_date(F.trim("fecha"), date_format).alias("fecha_de_pago"),
        blank_to_null(F.col("cbu_origen")).alias("cbu_origen"),
        parse_amount(F.col("importe")).alias("importe"),
        F.col("fecha").alias("fecha_texto"),
        F.col("importe").alias("importe_texto"),
    )
    rules = {
        "sin numero de pago": _present("id_pago"),
        "fecha ilegible": _present("fecha_de_pago"),
        "importe ilegible": _present("importe"),
    }
    texts = ["fecha_texto", "importe_texto"]
    accepted, rejected = _load(typed, rules, ["id_pago"], existing, texts)
    return Split(match_payments(accepted, accounts), rejected)


def rematch_payments(payments: DataFrame, accounts: DataFrame) -> DataFrame:
    """All payments, the unmatched ones matched again against the current accounts."""
    return match_payments(payments, accounts).select(*payments.columns)


def import_quotes(
    raw: DataFrame,
    sequence: int,
    existing: DataFrame | None = None,
    date_format: str = "dd/MM/yyyy",
) -> Split:
    """Dollar quotes of one load: ``sequence`` numbers the loads, and reports read the last one.
    A load repeated under its number adds nothing."""
    typed = _typed(
        raw,
        F.upper(blank_to_null(F.col("moneda"))).alias("moneda"),
        F.try_to_date(F.trim("fecha"), date_format).alias("fecha"),
        parse_amount(F.col("compra")).alias("compra"),
        parse_amount(F.col("venta")).alias("venta"),
        F.lit(sequence).cast("bigint").alias("secuencia"),
        F.col("fecha").alias("fecha_texto"),
        F.col("compra").alias("compra_texto"),
        F.col("venta").alias("venta_texto"),
    )
    rules = {
        "sin moneda": _present("moneda"),
        "fecha ilegible": _present("fecha"),
        "importe ilegible": _present("venta"),
    }
    accepted, rejected = _split(typed, rules)
    rows = accepted.drop("fecha_texto", "compra_texto", "venta_texto").distinct()
    return Split(rows if existing is None else new_rows(existing, rows, rows.columns), rejected)


def quotes_latest(quotes: DataFrame) -> DataFrame:
    """The last quote loaded per currency and day; of several in one load the highest."""
    amounts = [c for c in ("venta", "compra") if c in quotes.columns]
    return keep_latest(quotes, ["moneda", "fecha"], "secuencia", *amounts)
