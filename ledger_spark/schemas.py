"""Explicit schemas of the ledger tables and of the files loaded into them.

Nothing is inferred: inference costs a pass over the data, and it would turn
22-digit account numbers into decimals.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# Sums over all payments outgrow 18 digits.
TOTAL = T.DecimalType(28, 2)
PERCENT = T.DecimalType(5, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_STR, _INT, _LONG, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()

# Ids of the stored tables are natural keys (building name, building and unit
# number, document number, account number). They need no counter and no lookup
# join, never collide, and come out the same when a load is repeated. Reports
# only compare ids, so tables with numeric ids work as well.
_ID = T.StringType()

BUILDING = _struct(id_consorcio=_ID, nombre=_STR)

# One row per building and period. ``periodo`` is the month name as typed;
# ``mes`` is the first day of the month where the year is known.
CHARGE = _struct(
    id_expensa_consorcio=_ID,
    id_consorcio=_ID,
    periodo=_STR,
    mes=_DATE,
    total_ordinarios=MONEY,
    total_extraordinarios=MONEY,
)

EXPENSE_LINE = _struct(
    id_expensa_consorcio=_ID,
    id_consorcio=_ID,
    mes=_DATE,
    categoria=_STR,
    detalle=_STR,
    clase=_STR,
    importe=MONEY,
)

PERSON = _struct(
    id_persona=_ID,
    nombre=_STR,
    apellido=_STR,
    dni=_STR,
    email=_STR,
    telefono=_STR,
    es_inquilino=_INT,
)

UNIT = _struct(
    id_uf=_ID,
    id_consorcio=_ID,
    numero=_LONG,
    piso=_STR,
    departamento=_STR,
    porcentaje_de_prorrateo=PERCENT,
)

UNIT_PERSON = _struct(id_uf=_ID, id_persona=_ID)

ACCOUNT = _struct(id_persona_cuenta=_ID, id_persona=_ID, cbu=_STR)

PAYMENT = _struct(
    id_pago=_LONG,
    id_persona_cuenta=_ID,
    cbu_origen=_STR,
    fecha_de_pago=_DATE,
    importe=MONEY,
    estado=_STR,
)

QUOTE = _struct(moneda=_STR, fecha=_DATE, compra=MONEY, venta=MONEY, secuencia=_LONG)

SUPPLIER = _struct(nombre=_STR, rubro=_STR, consorcio=_STR)

# ---- files -------------------------------------------------------------

CORRUPT = "_corrupt_record"

# Fixed values. Unit roster: '|' separated, in this column order.
ROSTER_FILE = T.StructType(
    [
        T.StructField("CVU/CBU", _STR),
        T.StructField("Nombre del consorcio", _STR),
        T.StructField("nroUnidadFuncional", _LONG),
        T.StructField("piso", _STR),
        T.StructField("departamento", _STR),
    ]
)

ROSTER_NAMES = {
    "CVU/CBU": "cbu",
    "Nombre del consorcio": "consorcio",
    "nroUnidadFuncional": "numero",
}

# Category keys of the records seen so far, for tables with a column per
# category. Records as read may have any others.
EXPENSE_CATEGORIES = [
    "BANCARIOS",
    "LIMPIEZA",
    "ADMINISTRACION",
    "SEGUROS",
    "GASTOS GENERALES",
    "SERVICIOS PUBLICOS-Agua",
    "SERVICIOS PUBLICOS-Luz",
    "EXTRAORDINARIO-Obras",
]

# The keys of a monthly expense record that are no category.
MONTHLY_EXPENSES_FIXED = ["_id", "Nombre del consorcio", "Mes"]

# Bank export: amounts and dates arrive as text.
PAYMENT_FILE = _struct(id_pago=_LONG, fecha=_STR, cbu_origen=_STR, importe=_STR)

# Units with their share of the expenses, as text in any amount style.
UNIT_FILE = _struct(consorcio=_STR, numero=_LONG, piso=_STR, departamento=_STR, porcentaje=_STR)

QUOTE_FILE = _struct(moneda=_STR, fecha=_STR, compra=_STR, venta=_STR)

PERSON_FILE = _struct(
    nombre=_STR, apellido=_STR, dni=_STR, email=_STR, telefono=_STR, cbu=_STR, es_inquilino=_STR
)
