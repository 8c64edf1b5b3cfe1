"""The SQL each query must agree with.

Written straight from the definitions (every unit joined to every period, every
payment to every unit), not from the plans, so that it checks them.
"""

from __future__ import annotations

VIEWS = """
meses AS (
  SELECT * FROM (VALUES (1, 'enero'), (2, 'febrero'), (3, 'marzo'), (4, 'abril'), (5, 'mayo'),
    (6, 'junio'), (7, 'julio'), (8, 'agosto'), (9, 'septiembre'), (10, 'octubre'),
    (11, 'noviembre'), (12, 'diciembre')) AS t(nro, mes_nombre)
),
persona AS (
  SELECT c_custkey AS id_persona, c_mktsegment AS nombre, c_name AS apellido,
    CAST(c_custkey AS VARCHAR) AS dni, lower(c_name) || '@example.org' AS email,
    CAST(c_nationkey AS VARCHAR) AS telefono,
    CAST(c_mktsegment = 'HOUSEHOLD' AS BIGINT) AS es_inquilino
  FROM customer
),
unidad AS (
  SELECT o_orderkey AS id_uf, CAST(c_nationkey AS BIGINT) AS id_consorcio,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'B' WHEN '3-MEDIUM' THEN 'C'
      WHEN '4-NOT SPECIFIED' THEN 'D' WHEN '5-LOW' THEN 'E' END AS departamento,
    CASE WHEN o_orderstatus <> 'P' THEN
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(5,2))
    END AS pct
  FROM orders JOIN customer ON o_custkey = c_custkey
),
uf_persona AS (SELECT o_orderkey AS id_uf, o_custkey AS id_persona FROM orders),
gasto AS (
  SELECT CAST(c_nationkey AS BIGINT) AS id_consorcio, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes,
    mes_nombre AS periodo, o_orderstatus = 'P' AS extra,
    CAST(o_totalprice AS DECIMAL(18,2)) AS importe
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN meses ON nro = month(o_orderdate)
),
expensa AS (
  SELECT id_consorcio, periodo, SUM(CASE WHEN NOT extra THEN importe END) AS total_ordinarios,
    SUM(CASE WHEN extra THEN importe END) AS total_extraordinarios
  FROM gasto GROUP BY id_consorcio, periodo
),
expensa_mes AS (
  SELECT id_consorcio, mes, SUM(CASE WHEN NOT extra THEN importe END) AS total_ordinarios,
    SUM(CASE WHEN extra THEN importe END) AS total_extraordinarios
  FROM gasto GROUP BY id_consorcio, mes
),
pago AS (
  SELECT o_custkey AS id_persona, CAST(l_shipdate AS DATE) AS fecha,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS importe
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
unidad_pagadora AS (
  SELECT id_persona, id_uf, id_consorcio, departamento
  FROM (SELECT id_persona, MIN(id_uf) AS id_uf FROM uf_persona GROUP BY id_persona)
  JOIN unidad USING (id_uf)
)
"""


def _with_views(body: str) -> str:
    return f"WITH {VIEWS.strip()},\n{body.strip()}" if body.lstrip().startswith("_") else (
        f"WITH {VIEWS.strip()}\n{body.strip()}"
    )


def _delinquency(
    building: int | None, extra: bool, periods: list[str] | None, each_unit: bool = True
) -> str:
    """Charges and payments of every owned unit as one list of movements, then its sums."""
    amount = "COALESCE(total_ordinarios, 0)"
    if extra:
        amount += " + COALESCE(total_extraordinarios, 0)"
    scope = f"id_consorcio = {building}" if building is not None else "TRUE"
    months = f"periodo IN {tuple(periods)}" if periods else "TRUE"
    paying = "_tenencia" if each_unit else "(SELECT DISTINCT id_persona, id_consorcio FROM _tenencia)"
    return f"""
_tenencia AS (
  SELECT id_persona, id_consorcio, COALESCE(pct, 0) * CAST(0.01 AS DECIMAL(3,2)) AS parte
  FROM unidad JOIN uf_persona USING (id_uf)
  WHERE {scope} AND id_persona IN (SELECT id_persona FROM persona WHERE es_inquilino = 0)
),
_movimiento AS (
  SELECT id_persona, id_consorcio, CAST({amount} AS DECIMAL(18,2)) * parte AS cargo, NULL AS abono
  FROM _tenencia JOIN expensa USING (id_consorcio) WHERE {months}
  UNION ALL
  SELECT id_persona, id_consorcio, NULL, importe
  FROM {paying} JOIN pago USING (id_persona) WHERE fecha <= DATE '1996-12-31'
),
_saldo AS (
  SELECT id_persona, id_consorcio, SUM(cargo) AS debe, COALESCE(SUM(abono), 0) AS haber
  FROM _movimiento GROUP BY ALL HAVING COUNT(cargo) > 0
),
_informe AS (
  SELECT id_persona, id_consorcio, n_name AS "Consorcio", apellido, nombre, dni, email, telefono,
    CAST(debe AS DOUBLE) AS "DeudaEsperada", CAST(haber AS DOUBLE) AS "Pagos",
    CAST(CAST(greatest(debe - haber, 0) AS DECIMAL(18,2)) AS DOUBLE) AS "Morosidad"
  FROM _saldo JOIN persona USING (id_persona) JOIN nation ON n_nationkey = id_consorcio
)
"""


def _top(n: int, *args) -> str:
    return _with_views(
        _delinquency(*args)
        + f"""SELECT * EXCLUDE (id_persona, id_consorcio) FROM _informe
ORDER BY "Morosidad" DESC, apellido, nombre, id_persona, id_consorcio LIMIT {n}"""
    )


_WIDE_NAMES = """(VALUES ('1-URGENT', 'SERVICIOS PUBLICOS-Agua', 'SERVICIOS PUBLICOS', 'Agua'),
    ('2-HIGH', 'SERVICIOS PUBLICOS-Luz', 'SERVICIOS PUBLICOS', 'Luz'),
    ('3-MEDIUM', 'LIMPIEZA', 'LIMPIEZA', NULL), ('4-NOT SPECIFIED', 'SEGUROS', 'SEGUROS', NULL),
    ('5-LOW', 'EXTRAORDINARIO-Obras', 'EXTRAORDINARIO', 'Obras'))
    AS r(prioridad, rotulo, categoria, detalle)"""

_LOT = """
  SELECT o_custkey, o_orderdate, o_orderkey FROM orders WHERE o_orderdate {side} TIMESTAMP '1998-01-01'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""
_LOTS = f"WITH guardado AS ({_LOT.format(side='<')}), nuevo AS ({_LOT.format(side='>=')})"
_LOT_COLUMNS = "o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderkey"

_BANK = """
WITH banco AS (
  SELECT l_orderkey AS id_pago, MAX(l_shipdate) AS fecha,
    SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS importe
  FROM lineitem GROUP BY l_orderkey
)
SELECT id_pago, strftime(fecha, '%Y-%m-%d') AS fecha_de_pago,
  lpad(CAST(o_custkey AS VARCHAR), 22, '0') AS cbu_origen, CAST(importe AS DOUBLE) AS importe,
  CASE WHEN {known} THEN o_custkey END AS id_persona_cuenta,
  CASE WHEN {known} THEN 'asociado' ELSE 'no asociado' END AS estado
FROM banco JOIN orders ON id_pago = o_orderkey JOIN customer ON o_custkey = c_custkey
"""

_ROSTER = """
roster AS (
  SELECT lpad(CAST(id_persona AS VARCHAR), 22, '0') AS cbu, n_name AS consorcio,
    CAST(id_uf AS BIGINT) AS numero, 'PB' AS piso, departamento
  FROM unidad JOIN uf_persona USING (id_uf) JOIN nation ON n_nationkey = id_consorcio
)
"""


def _hmac(key: str) -> str:
    """HMAC-SHA-256 of the bytes ``cbu`` under a key of at most a block, as the standard writes it."""
    inner, outer = (
        bytes(b ^ mask for b in key.encode().ljust(64, b"\0")).hex() for mask in (0x36, 0x5C)
    )
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || cbu)))"


def _roster(body: str) -> str:
    return f"WITH {VIEWS.strip()},\n{_ROSTER.strip()}\n{body.strip()}"


_DAYS = """
_dias AS (
  SELECT id_uf, fecha, COUNT(*) AS pagos FROM pago JOIN unidad_pagadora USING (id_persona)
  GROUP BY id_uf, fecha
)
"""

_SPLIT = """
_pagado AS (
  SELECT id_consorcio, year(fecha) AS anio, month(fecha) AS nro, SUM(importe) AS pagado
  FROM pago JOIN unidad_pagadora USING (id_persona) GROUP BY ALL
),
_parte AS (
  SELECT p.id_consorcio, anio, p.nro AS mes, pagado,
    ROUND(CAST(pagado AS DOUBLE) * (CAST(COALESCE(total_ordinarios, 0) AS DOUBLE)
      / NULLIF(CAST(COALESCE(total_ordinarios, 0) + COALESCE(total_extraordinarios, 0) AS DOUBLE), 0)), 2)
      AS ordinario
  FROM _pagado p {join}
)
SELECT id_consorcio, anio, mes, CAST(pagado AS DOUBLE) AS pagado,
  ordinario AS pagado_ordinario,
  CAST(pagado - CAST(ordinario AS DECIMAL(18,2)) AS DOUBLE) AS pagado_extraordinario
FROM _parte
"""


def _weekly(source: str) -> str:
    return f"""
_semana AS (
  SELECT CAST(date_trunc('week', fecha) AS DATE) AS semana, SUM(importe) AS total
  FROM {source} GROUP BY 1
)
SELECT strftime(semana, '%Y-%m-%d') AS semana, CAST(total AS DOUBLE) AS total,
  CAST(SUM(total) OVER (ORDER BY semana) AS DOUBLE) AS acumulado,
  ROUND(CAST(SUM(total) OVER () AS DOUBLE) / COUNT(*) OVER (), 2) AS promedio_semanal
FROM _semana
"""


# Charges and payments of every unit with the sums up to each; no amount is negative here.
_ALLOCATED = """
_cargo AS (
  SELECT id_uf, mes, CAST(CAST(COALESCE(total_ordinarios, 0) + COALESCE(total_extraordinarios, 0)
    AS DECIMAL(18,2)) * (COALESCE(pct, 0) * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(18,2)) AS importe
  FROM unidad u JOIN expensa_mes e ON e.id_consorcio = u.id_consorcio WHERE mes IS NOT NULL /* mes */
),
_cargo_hasta AS (
  SELECT *, SUM(importe) OVER (PARTITION BY id_uf ORDER BY mes) AS hasta FROM _cargo WHERE importe > 0
),
_pago_hasta AS (
  SELECT id_uf, fecha AS dia, SUM(importe) AS importe,
    SUM(SUM(importe)) OVER (PARTITION BY id_uf ORDER BY fecha) AS hasta
  FROM pago JOIN unidad_pagadora USING (id_persona) WHERE TRUE /* dia */ GROUP BY id_uf, fecha
)
"""

_CONVERTED = """
_cotizacion AS (
  SELECT event_type AS moneda, DATE '1995-06-01' + CAST(((day(ts) - 1) * 24 + hour(ts)) * 3 AS INTEGER) AS fecha,
    value + 1 AS venta, event_id
  FROM events WHERE event_type IN ('purchase', 'view')
),
_dia AS (
  SELECT moneda, fecha AS desde, arg_max(venta, event_id) AS venta FROM _cotizacion GROUP BY ALL
),
_fecha AS (
  SELECT f.fecha, m.moneda, d.desde, d.venta
  FROM (SELECT DISTINCT fecha FROM pago) f CROSS JOIN (VALUES ('purchase'), ('view')) m(moneda)
  ASOF LEFT JOIN _dia d ON d.moneda = m.moneda AND f.fecha >= d.desde
)
"""

_RESPELLED = """
_cliente AS (
  SELECT c_custkey, CAST(c_custkey * 7919 + 10000000 AS VARCHAR) AS documento,
    translate(c_name, '#0123456789', ' abcdefghij') AS apellido, c_mktsegment AS nombre,
    lower(c_name) || '@example.org' AS email
  FROM customer
),
_caso AS (
  SELECT c_custkey, -1 AS caso, 0 AS n FROM customer
  UNION SELECT o_custkey, o_orderkey % 3, o_orderkey % 7 FROM orders WHERE o_orderstatus = 'P'
),
_alta AS (
  SELECT DISTINCT CASE caso WHEN 0 THEN documento || n WHEN 1 THEN '9' || documento[2:]
      WHEN 2 THEN 'M' || reverse(documento) ELSE documento END AS id,
    lower(CASE WHEN caso = 1 THEN nombre[2:] ELSE nombre END || ' ' || apellido
      || CASE WHEN caso = 2 AND n > 3 THEN 'k' ELSE '' END) AS nombre,
    CASE WHEN caso IN (-1, 2) THEN email END AS email
  FROM _cliente JOIN _caso USING (c_custkey)
),
_cabeza AS (SELECT email, nombre, min(id) AS id FROM _alta WHERE email IS NOT NULL GROUP BY ALL),
_enlace AS (
  SELECT a.id AS x, b.id AS y, TRUE AS doc, FALSE AS con FROM _alta a JOIN _alta b ON a.id < b.id
    AND abs(length(a.id) - length(b.id)) <= 1 AND levenshtein(a.id, b.id) = 1
    AND levenshtein(a.nombre, b.nombre) <= 2
  UNION ALL
  SELECT c.id, p.id, FALSE, TRUE FROM _cabeza c JOIN _alta p USING (email, nombre) WHERE p.id <> c.id
  UNION ALL
  SELECT a.id, b.id, FALSE, TRUE FROM _cabeza a JOIN _cabeza b USING (email)
  WHERE a.id <> b.id AND levenshtein(a.nombre, b.nombre) = 1
),
_par AS (
  SELECT least(x, y) AS id_a, greatest(x, y) AS id_b, bool_or(doc) AS por_documento,
    bool_or(con) AS por_contacto
  FROM _enlace GROUP BY ALL
)
"""

ORACLE: dict[str, str] = {
    "similar_people": f"WITH {_RESPELLED} SELECT * FROM _par",
    "people_groups": f"""
WITH RECURSIVE {_RESPELLED},
_vecino AS (SELECT id_a AS a, id_b AS b FROM _par UNION SELECT id_b, id_a FROM _par),
_alcance AS (
  SELECT a AS nodo, b AS otro FROM _vecino
  UNION SELECT nodo, b FROM _alcance JOIN _vecino ON a = otro
)
SELECT nodo AS id_persona, min(least(nodo, otro)) AS grupo,
  (SELECT count(*) FROM _vecino WHERE a = nodo) AS enlaces
FROM _alcance GROUP BY nodo
""",
    "top_delinquent_owners": _top(10, None, True, None),
    "top_delinquent_owners_listed": _top(3, None, False, ["enero", "febrero"]),
    "top_delinquent_owners_building": _top(5, 7, True, ["marzo", "abril", "mayo"]),
    "top_delinquent_owners_dedup": _top(10, None, True, None, False),
    "top_delinquent_owners_protected": f"""
SELECT * REPLACE (sha256('not-a-secret' || dni) AS dni, sha256('not-a-secret' || email) AS email,
  sha256('not-a-secret' || telefono) AS telefono)
FROM ({_top(10, None, True, None)})
""",
    "owner_delinquency": _with_views(
        _delinquency(None, True, None) + "SELECT * FROM _informe"
    ),
    "period_set": _with_views(
        """
SELECT DISTINCT 'default' AS origen, lower(trim(periodo)) AS periodo FROM expensa
UNION ALL
SELECT DISTINCT 'lista', lower(trim(x)) FROM (
  SELECT unnest(string_split(' Enero,enero ,MARZO,otro', ',')) AS x)
"""
    ),
    "listed_charges": _with_views(
        """
SELECT id_consorcio, periodo, CAST(total_ordinarios AS DOUBLE) AS total_ordinarios,
  CAST(total_extraordinarios AS DOUBLE) AS total_extraordinarios
FROM expensa WHERE periodo IN ('enero', 'marzo')
"""
    ),
    "expense_amount_parse": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  l_extendedprice AS coma_punto, l_extendedprice AS punto_coma,
  l_extendedprice AS coma_coma, l_extendedprice AS solo_coma FROM lineitem
""",
    "amounts_by_vote": """
WITH linea AS (
  SELECT *, l_suppkey % 3 = 0 AS coma,
    l_linenumber % 3 = 0 OR l_suppkey % 3 = 2 AS corto, CAST(l_extendedprice AS DECIMAL(18,2)) AS precio
  FROM lineitem
),
escrito AS (
  SELECT *, CASE WHEN corto THEN format('{:,}', CAST(floor(precio) AS BIGINT))
    ELSE format('{:,}', CAST(floor(precio) AS BIGINT)) || '.'
      || lpad(CAST(CAST((precio - floor(precio)) * 100 AS BIGINT) AS VARCHAR), 2, '0') END AS ingles
  FROM linea
),
voto AS (
  SELECT l_suppkey, count(*) FILTER (WHERE NOT corto AND NOT coma) AS votos_coma,
    count(*) FILTER (WHERE NOT corto AND coma) AS votos_punto
  FROM linea GROUP BY 1
)
SELECT CAST(l_suppkey AS BIGINT) AS archivo, CASE WHEN coma THEN ingles ELSE translate(ingles, ',.', '.,') END AS texto,
  l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN NOT corto THEN CAST(precio AS DOUBLE)
    WHEN precio < 1000 OR votos_coma + votos_punto > 0 THEN CAST(floor(precio) AS DOUBLE) END AS importe,
  CASE WHEN corto AND precio >= 1000 AND votos_coma + votos_punto = 0 THEN 'importe ambiguo' END AS motivo,
  votos_coma, votos_punto
FROM escrito JOIN voto USING (l_suppkey)
""",
    "month_normalise": _with_views(
        """
SELECT o_orderkey, mes_nombre AS periodo, CAST(nro AS BIGINT) AS nro_mes,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS mes
FROM orders JOIN meses ON nro = month(o_orderdate)
"""
    ),
    "import_services": _with_views(
        """
_mes AS (
  SELECT id_consorcio, mes, SUM(CASE WHEN NOT extra THEN importe END) AS ordinario,
    SUM(CASE WHEN extra THEN importe END) AS extraordinario, MAX(importe) AS mayor,
    MIN(importe) AS menor
  FROM gasto GROUP BY id_consorcio, mes
),
_linea AS (
  SELECT id_consorcio, mes, 'LIMPIEZA' AS categoria, NULL AS detalle, 'ordinario' AS clase,
    ordinario AS importe FROM _mes
  UNION ALL SELECT id_consorcio, mes, 'SERVICIOS PUBLICOS', 'Agua', 'ordinario', mayor FROM _mes
  UNION ALL SELECT id_consorcio, mes, 'SERVICIOS PUBLICOS', 'Luz', 'ordinario', menor FROM _mes
  UNION ALL SELECT id_consorcio, mes, 'EXTRAORDINARIO', 'Obras', 'extraordinario', extraordinario
    FROM _mes
  UNION ALL SELECT id_consorcio, mes, 'EXTRAORDINARIO', 'Ascensor', 'extraordinario', menor FROM _mes
)
SELECT 'aceptado' AS estado, lower(n_name) AS id_consorcio, strftime(mes, '%Y-%m-%d') AS mes,
  categoria, detalle, clase, CAST(importe AS DOUBLE) AS importe, 1 AS filas
FROM _linea JOIN nation ON n_nationkey = id_consorcio WHERE importe IS NOT NULL
UNION ALL
SELECT 'sin consorcio', NULL, NULL, NULL, NULL, NULL, NULL, COUNT(*) FROM _mes
UNION ALL
SELECT 'registro reemplazado', NULL, NULL, NULL, NULL, NULL, NULL, COUNT(*) FROM _mes
"""
    ),
    "json_field_extract": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""",
    "objects_of_arrays": """
SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  '}{"' || event_type || '\\"},' AS nota
FROM events
""",
    "expense_unpivot": f"""
SELECT CAST(c_nationkey AS BIGINT) AS id_consorcio,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS mes, rotulo,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
FROM orders JOIN customer ON o_custkey = c_custkey JOIN {_WIDE_NAMES} ON prioridad = o_orderpriority
GROUP BY ALL
""",
    "expense_class": f"""
SELECT categoria, detalle,
  CASE WHEN categoria = 'EXTRAORDINARIO' THEN 'extraordinario' ELSE 'ordinario' END AS clase,
  COUNT(DISTINCT (c_nationkey, date_trunc('month', o_orderdate))) AS lineas,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS importe
FROM orders JOIN customer ON o_custkey = c_custkey JOIN {_WIDE_NAMES} ON prioridad = o_orderpriority
GROUP BY categoria, detalle
""",
    "lots_union": _with_views(
        """
SELECT id_consorcio, periodo, CAST(SUM(importe) AS DOUBLE) AS ordinario,
  CAST(NULL AS DOUBLE) AS extraordinario
FROM gasto WHERE NOT extra GROUP BY id_consorcio, periodo
UNION ALL
SELECT id_consorcio, periodo, NULL, CAST(SUM(importe) AS DOUBLE)
FROM gasto WHERE extra GROUP BY id_consorcio, periodo
"""
    ),
    "roster_parse": _roster("SELECT * FROM roster"),
    "roster_dimensions": _roster(
        """
SELECT consorcio, 1 AS filas, 'consorcio' AS dimension FROM roster GROUP BY consorcio
UNION ALL
SELECT consorcio, COUNT(DISTINCT numero), 'unidad' FROM roster GROUP BY consorcio
UNION ALL
SELECT consorcio, COUNT(DISTINCT (cbu, numero)), 'cuenta' FROM roster GROUP BY consorcio
"""
    ),
    "roster_uniqueness": _roster(
        "SELECT cbu, COUNT(*) AS filas FROM roster GROUP BY cbu HAVING COUNT(*) > 1"
    ),
    "duplicate_keys": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS filas FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""",
    "keep_latest": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_partkey,
  l_suppkey, l_extendedprice
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
""",
    "reject_split": """
SELECT event_id, user_id, event_type, value,
  CASE WHEN user_id IS NULL THEN 'sin usuario' WHEN event_type = 'error' THEN 'evento de error'
    WHEN NOT COALESCE(value >= 5, FALSE) THEN 'valor bajo' END AS motivo
FROM events
""",
    "import_buildings": """
SELECT DISTINCT lower(n_name) AS id_consorcio, n_name AS nombre
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 0
""",
    "import_units": _with_views(
        """
SELECT lower(n_name) || '|' || id_uf AS id_uf, lower(n_name) AS id_consorcio, id_uf AS numero,
  'PB' AS piso, departamento, CAST(pct AS DOUBLE) AS porcentaje_de_prorrateo
FROM unidad JOIN nation ON n_nationkey = id_consorcio
"""
    ),
    "import_people": """
WITH filas AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal, COUNT(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
)
SELECT CAST(c_custkey AS VARCHAR) AS id_persona,
  upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS nombre,
  upper(c_name[1]) || lower(c_name[2:]) AS apellido, CAST(c_custkey AS VARCHAR) AS dni,
  lower(c_name) || '@example.org' AS email, CAST(NULL AS VARCHAR) AS telefono,
  CAST(c_mktsegment = 'HOUSEHOLD' AS BIGINT) AS es_inquilino,
  CAST(NULL AS VARCHAR) AS motivo, CAST(NULL AS BIGINT) AS filas
FROM filas WHERE c_acctbal >= 0
UNION ALL
SELECT NULL, NULL, NULL, CAST(c_custkey AS VARCHAR), NULL, NULL, NULL, 'tipo de persona', n
FROM filas WHERE c_acctbal < 0
""",
    "import_unit_people": _roster(
        """
SELECT lower(consorcio) || '|' || numero AS id_uf,
  CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS VARCHAR) END AS id_persona,
  CASE WHEN c_acctbal < 0 THEN 'cuenta desconocida' END AS motivo
FROM roster JOIN customer ON CAST(cbu AS BIGINT) = c_custkey
"""
    ),
    "import_suppliers": """
SELECT upper(s_name) AS nombre, 'servicios' AS rubro, lower(n_name) AS consorcio
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""",
    "import_payments": _BANK.format(known="c_acctbal >= 0"),
    "unmatched_payments": _BANK.format(known="c_acctbal >= 0") + "WHERE c_acctbal < 0",
    "rounded_payments": """
WITH cuenta AS (
  SELECT c_custkey AS id, lpad(CAST(c_custkey // 3 AS VARCHAR), 14, '0')
    || CASE WHEN c_acctbal < 0 THEN '9' ELSE CAST(c_custkey % 3 AS VARCHAR) END || '123456'
    || CASE WHEN c_acctbal < 0 THEN CAST(c_custkey % 3 AS VARCHAR) ELSE '7' END AS cbu
  FROM customer
),
entregado AS (
  SELECT o_orderkey AS id_pago, o_orderstatus = 'P' AS entero,
    CASE WHEN o_orderstatus = 'P' THEN cbu ELSE left(cbu, 15) || '0000000' END AS cbu_origen
  FROM orders JOIN cuenta ON id = o_custkey
),
hallado AS (
  SELECT id_pago, cbu_origen, count(*) AS candidatos, min(id) AS id
  FROM entregado JOIN cuenta ON CASE WHEN entero THEN cbu = cbu_origen ELSE left(cbu, 15) = left(cbu_origen, 15) END
  GROUP BY ALL
)
SELECT id_pago, cbu_origen, CASE WHEN candidatos = 1 THEN id END AS id_persona_cuenta,
  CASE WHEN candidatos = 1 THEN 'asociado' ELSE 'ambiguo' END AS estado, candidatos
FROM hallado
""",
    "rematch_payments": _BANK.format(known="TRUE"),
    "chain_payments": f"""
SELECT * REPLACE (CASE WHEN estado = 'asociado' THEN cbu_origen END AS id_persona_cuenta)
FROM ({_BANK.format(known="c_mktsegment <> 'MACHINERY'")})
""",
    "idempotent_upsert": f"""{_LOTS}
SELECT {_LOT_COLUMNS} FROM guardado UNION ALL
SELECT {_LOT_COLUMNS} FROM nuevo WHERE o_custkey NOT IN (SELECT o_custkey FROM guardado)
""",
    "idempotent_upsert_newest": f"""{_LOTS}
SELECT {_LOT_COLUMNS} FROM (SELECT * FROM guardado UNION ALL SELECT * FROM nuevo)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1
""",
    "quotes_latest": """
SELECT event_type AS moneda, strftime(ts, '%Y-%m-%d') AS fecha, value AS venta,
  event_id AS secuencia
FROM events QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE)
  ORDER BY event_id DESC) = 1
""",
    "curated_payments": _with_views(
        """
SELECT id_persona AS id_persona_cuenta, strftime(fecha, '%Y-%m-%d') AS fecha_de_pago,
  CAST(importe AS DOUBLE) AS importe
FROM pago WHERE fecha BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
"""
    ),
    "charge_rollup": _with_views(
        """
SELECT id_consorcio, strftime(mes, '%Y-%m-%d') AS mes,
  CAST(total_ordinarios AS DOUBLE) AS total_ordinarios,
  CAST(total_extraordinarios AS DOUBLE) AS total_extraordinarios FROM expensa_mes
"""
    ),
    "generate_charges": _with_views(
        """
SELECT id_consorcio || '|' || strftime(mes, '%Y-%m') AS id_expensa_consorcio, id_consorcio,
  mes_nombre AS periodo, strftime(mes, '%Y-%m-%d') AS mes,
  CAST(total_ordinarios AS DOUBLE) AS total_ordinarios,
  CAST(total_extraordinarios AS DOUBLE) AS total_extraordinarios
FROM expensa_mes JOIN meses ON nro = month(mes) WHERE mes >= DATE '1996-01-01'
"""
    ),
    "charge_reconciliation": _with_views(
        """
SELECT id_consorcio, strftime(mes, '%Y-%m-%d') AS mes, CAST(SUM(importe) AS DOUBLE) AS gastos,
  CAST(0 AS DOUBLE) AS expensas, CAST(SUM(importe) AS DOUBLE) AS diferencia
FROM gasto WHERE mes >= DATE '1996-01-01' GROUP BY id_consorcio, mes
"""
    ),
    "unit_charges": _with_views(
        """
SELECT id_uf, u.id_consorcio, strftime(mes, '%Y-%m-%d') AS mes,
  CAST(CAST(CAST(COALESCE(total_ordinarios, 0) + COALESCE(total_extraordinarios, 0)
    AS DECIMAL(18,2)) * (COALESCE(pct, 0) * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(18,2))
    AS DOUBLE) AS cargo
FROM unidad u JOIN expensa_mes e ON e.id_consorcio = u.id_consorcio
"""
    ),
    "unit_charges_exact": _with_views(
        """
_peso AS (
  SELECT id_uf, id_consorcio, CAST(greatest(COALESCE(pct, 0), 0) * 100 AS HUGEINT) AS peso FROM unidad
),
_parte AS (
  SELECT id_uf, u.id_consorcio, mes,
    CAST(abs(COALESCE(total_ordinarios, 0) + COALESCE(total_extraordinarios, 0)) * 100 AS HUGEINT) AS total,
    sign(COALESCE(total_ordinarios, 0) + COALESCE(total_extraordinarios, 0)) AS signo,
    CASE WHEN SUM(peso) OVER _edificio > 0 THEN peso ELSE 1 END AS parte,
    CASE WHEN SUM(peso) OVER _edificio > 0 THEN SUM(peso) OVER _edificio ELSE COUNT(*) OVER _edificio END AS partes
  FROM _peso u JOIN expensa_mes e ON e.id_consorcio = u.id_consorcio
  WINDOW _edificio AS (PARTITION BY u.id_consorcio, mes)
),
_cuota AS (
  SELECT *, total * parte // partes AS cuota, total * parte % partes AS resto FROM _parte
),
_lugar AS (
  SELECT *, total - SUM(cuota) OVER (PARTITION BY id_consorcio, mes) AS sobrante,
    row_number() OVER (PARTITION BY id_consorcio, mes
      ORDER BY resto DESC, parte, md5(CAST(id_uf AS VARCHAR)), id_uf) AS lugar
  FROM _cuota
)
SELECT id_uf, id_consorcio, strftime(mes, '%Y-%m-%d') AS mes,
  CAST(CAST(signo * (cuota + CASE WHEN lugar <= sobrante THEN 1 ELSE 0 END) AS DECIMAL(18,0))
    * CAST(0.01 AS DECIMAL(3,2)) AS DOUBLE) AS cargo
FROM _lugar
"""
    ),
    "payment_allocation": _with_views(
        _ALLOCATED
        + """
SELECT c.id_uf, strftime(c.mes, '%Y-%m-%d') AS mes, strftime(p.dia, '%Y-%m-%d') AS fecha,
  CAST(least(c.hasta, p.hasta) - greatest(c.hasta - c.importe, p.hasta - p.importe) AS DOUBLE) AS importe
FROM _cargo_hasta c JOIN _pago_hasta p ON c.id_uf = p.id_uf
  AND c.hasta > p.hasta - p.importe AND p.hasta > c.hasta - c.importe
"""
    ),
    "debt_by_age": _with_views(
        _ALLOCATED.replace("/* mes */", "AND mes <= DATE '1996-12-31'").replace(
            "/* dia */", "AND fecha <= DATE '1996-12-31'"
        )
        + """,
_abierto AS (
  SELECT id_uf, date_diff('day', mes, DATE '1996-12-31') AS dias,
    least(importe, hasta - COALESCE((SELECT SUM(importe) FROM _pago_hasta p WHERE p.id_uf = c.id_uf), 0)) AS deuda
  FROM _cargo_hasta c
)
SELECT id_consorcio, CASE WHEN dias <= 30 THEN '0-30' WHEN dias <= 60 THEN '31-60'
    WHEN dias <= 90 THEN '61-90' ELSE 'mas de 90' END AS antiguedad,
  COUNT(DISTINCT id_uf) AS unidades, CAST(SUM(deuda) AS DOUBLE) AS deuda
FROM _abierto JOIN unidad USING (id_uf) WHERE deuda > 0 GROUP BY 1, 2
"""
    ),
    "unpaid_spells": _with_views(
        """
_mes AS (
  SELECT DISTINCT id_uf, id_consorcio, mes FROM unidad JOIN expensa_mes USING (id_consorcio)
  WHERE mes <= DATE '1996-12-31'
),
_sin AS (
  SELECT *, row_number() OVER (PARTITION BY id_uf ORDER BY mes) AS n,
    max(mes) OVER (PARTITION BY id_consorcio) AS ultimo,
    EXISTS (SELECT 1 FROM pago JOIN unidad_pagadora USING (id_persona) WHERE fecha <= DATE '1996-12-31'
      AND unidad_pagadora.id_uf = _mes.id_uf AND date_trunc('month', fecha) = mes) AS pago
  FROM _mes
),
_racha AS (
  SELECT *, n - row_number() OVER (PARTITION BY id_uf ORDER BY mes) AS racha FROM _sin WHERE NOT pago
)
SELECT id_uf, strftime(min(mes), '%Y-%m-%d') AS desde, strftime(max(mes), '%Y-%m-%d') AS hasta,
  COUNT(*) AS meses, max(mes) = max(ultimo) AS abierto
FROM _racha GROUP BY id_uf, racha
"""
    ),
    "payments_in_currency": _with_views(
        _CONVERTED
        + """
SELECT id_persona AS id_persona_cuenta, strftime(f.fecha, '%Y-%m-%d') AS fecha_de_pago, f.moneda,
  CAST(importe AS DOUBLE) AS importe, strftime(desde, '%Y-%m-%d') AS vigente_desde, venta,
  CAST(importe AS DOUBLE) / venta AS importe_en_moneda
FROM _fecha f JOIN pago USING (fecha)
"""
    ),
    "payments_without_quote": _with_views(
        _CONVERTED
        + """
SELECT moneda, strftime(f.fecha, '%Y-%m-%d') AS fecha_de_pago, COUNT(*) AS pagos,
  CAST(SUM(importe) AS DOUBLE) AS importe
FROM _fecha f JOIN pago USING (fecha) WHERE desde IS NULL GROUP BY 1, 2
"""
    ),
    "unit_statement": _with_views(
        """
_cargo AS (
  SELECT id_uf, mes, CAST(CAST(COALESCE(total_ordinarios, 0) + COALESCE(total_extraordinarios, 0)
    AS DECIMAL(18,2)) * (COALESCE(pct, 0) * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(18,2)) AS cargo
  FROM unidad u JOIN expensa_mes e ON e.id_consorcio = u.id_consorcio
),
_pagado AS (
  SELECT id_uf, CAST(date_trunc('month', fecha) AS DATE) AS mes, SUM(importe) AS pagado
  FROM pago JOIN unidad_pagadora USING (id_persona) GROUP BY ALL
),
_saldo AS (
  SELECT COALESCE(c.id_uf, p.id_uf) AS id_uf, COALESCE(c.mes, p.mes) AS mes,
    COALESCE(cargo, 0) AS cargo, COALESCE(pagado, 0) AS pagado
  FROM _cargo c FULL JOIN _pagado p ON c.id_uf = p.id_uf AND c.mes = p.mes
),
_corrido AS (
  SELECT *, SUM(cargo - pagado) OVER (PARTITION BY id_uf ORDER BY mes) AS saldo_final FROM _saldo
)
SELECT id_uf, strftime(mes, '%Y-%m-%d') AS mes,
  CAST(COALESCE(LAG(saldo_final) OVER (PARTITION BY id_uf ORDER BY mes), 0) AS DOUBLE)
    AS saldo_anterior,
  CAST(cargo AS DOUBLE) AS cargo, CAST(pagado AS DOUBLE) AS pagado,
  CAST(saldo_final AS DOUBLE) AS saldo_final
FROM _corrido
"""
    ),
    "weekly_cash_flow": _with_views(_weekly("pago")),
    "weekly_cash_flow_building": _with_views(
        _weekly(
            """(SELECT * FROM pago JOIN unidad_pagadora USING (id_persona) WHERE id_consorcio = 3
    AND fecha BETWEEN DATE '1996-01-01' AND DATE '1999-06-30')"""
        )
    ),
    "collections_month_dept": _with_views(
        "SELECT month(fecha) AS mes, "
        + ", ".join(
            f"CAST(SUM(CASE WHEN departamento = '{d}' THEN importe END) AS DOUBLE) AS \"{d}\""
            for d in "ABCDE"
        )
        + """
FROM pago JOIN unidad_pagadora USING (id_persona) WHERE year(fecha) = 1997 GROUP BY 1"""
    ),
    "collections_type_period": _with_views(
        _SPLIT.format(
            join="""JOIN meses m ON m.nro = p.nro
  LEFT JOIN expensa e ON e.id_consorcio = p.id_consorcio AND e.periodo = m.mes_nombre"""
        )
    ),
    "collections_type_month": _with_views(
        _SPLIT.format(
            join="""LEFT JOIN expensa_mes e ON e.id_consorcio = p.id_consorcio
  AND e.mes = make_date(anio, p.nro, 1)"""
        )
    ),
    "top5_expense_income": _with_views(
        """
(SELECT 'gasto' AS tipo, strftime(mes, '%Y-%m-%d') AS mes, CAST(SUM(importe) AS DOUBLE) AS importe
  FROM gasto GROUP BY gasto.mes ORDER BY SUM(importe) DESC, gasto.mes LIMIT 5)
UNION ALL
(SELECT 'ingreso', strftime(date_trunc('month', fecha), '%Y-%m-%d'),
  CAST(SUM(importe) AS DOUBLE) FROM pago GROUP BY date_trunc('month', fecha)
  ORDER BY SUM(importe) DESC, date_trunc('month', fecha) LIMIT 5)
"""
    ),
    "payment_intervals": _with_views(
        """
_fechas AS (
  SELECT id_uf, fecha, LAG(fecha) OVER (PARTITION BY id_uf ORDER BY fecha) AS anterior
  FROM pago JOIN unidad_pagadora USING (id_persona)
)
SELECT id_uf, strftime(fecha, '%Y-%m-%d') AS fecha,
  strftime(anterior, '%Y-%m-%d') AS fecha_anterior, date_diff('day', anterior, fecha) AS dias
FROM _fechas
"""
    ),
    "payment_days": _with_views(
        _DAYS
        + """
SELECT id_uf, strftime(fecha, '%Y-%m-%d') AS fecha, pagos,
  strftime(LAG(fecha) OVER w, '%Y-%m-%d') AS fecha_anterior,
  strftime(LEAD(fecha) OVER w, '%Y-%m-%d') AS fecha_siguiente
FROM _dias WINDOW w AS (PARTITION BY id_uf ORDER BY fecha)
"""
    ),
    "protected_owners": _with_views(
        """
SELECT id_persona, nombre, apellido, sha256('not-a-secret' || dni) AS dni,
  sha256('not-a-secret' || email) AS email, sha256('not-a-secret' || telefono) AS telefono,
  es_inquilino
FROM persona
"""
    ),
    "encrypted_owners": _with_views("SELECT * FROM persona"),
    "payments_across_keys": f"""
WITH cuenta AS (
  SELECT c_custkey AS id, encode(lpad(CAST(c_custkey AS VARCHAR), 22, '0')) AS cbu,
    c_mktsegment <> 'HOUSEHOLD' AS pasa
  FROM customer
),
resumen AS (SELECT id, pasa, {_hmac("clave-vieja")} AS vieja, {_hmac("clave-nueva")} AS nueva FROM cuenta),
pagado AS (
  SELECT o_custkey AS id, CAST(l_shipdate AS DATE) > DATE '1996-12-31' AS tarde,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS importe
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
SELECT CASE WHEN tarde OR pasa THEN 2 ELSE 1 END AS clave,
  CASE WHEN tarde OR pasa THEN nueva ELSE vieja END AS cbu,
  count(*) AS pagos, CAST(sum(importe) AS DOUBLE) AS total
FROM pagado JOIN resumen USING (id) GROUP BY 1, 2
""",
    "effective_access": """
SELECT user_id AS rol, CAST(json_extract_string(props, '$.k') AS BIGINT) AS objeto,
  bool_or(event_type <> 'error') AND NOT bool_or(event_type = 'error') AS permitido
FROM events GROUP BY 1, 2
""",
    "effective_access_users": """
WITH evento AS (
  SELECT user_id AS rol, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type, value
  FROM events
),
objeto AS (SELECT DISTINCT k // 10 AS esquema, k AS objeto FROM evento),
alcance AS (
  SELECT rol, k // 10 AS esquema, k AS objeto, value, event_type = 'error' AS niega
  FROM evento WHERE event_type <> 'signup'
  UNION ALL
  SELECT rol, esquema, objeto, value, FALSE
  FROM evento JOIN objeto ON esquema = k // 10 WHERE event_type = 'signup'
)
SELECT c_mktsegment || '-' || c_nationkey AS miembro, esquema, objeto,
  CASE WHEN value < 50 THEN 'EXECUTE' ELSE 'ALTER' END AS permiso,
  bool_or(NOT niega) AND NOT bool_or(niega) AS permitido
FROM alcance JOIN customer ON c_custkey = rol GROUP BY 1, 2, 3, 4
""",
    "effective_access_nested": """
WITH RECURSIVE evento AS (
  SELECT user_id AS rol, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type, value
  FROM events
),
objeto AS (SELECT DISTINCT k // 10 AS esquema, k AS objeto FROM evento),
alcance AS (
  SELECT rol, k // 10 AS esquema, k AS objeto, value, event_type = 'error' AS niega
  FROM evento WHERE event_type <> 'signup'
  UNION ALL
  SELECT rol, esquema, objeto, value, FALSE
  FROM evento JOIN objeto ON esquema = k // 10 WHERE event_type = 'signup'
),
dentro AS (
  SELECT c_custkey AS rol, c_custkey // 4 AS fuera FROM customer
  UNION
  SELECT c_custkey // 4, c_custkey FROM customer WHERE c_acctbal < -900
),
camino AS (
  SELECT c_custkey AS miembro, c_custkey AS rol, 1 AS distancia FROM customer
  UNION
  SELECT miembro, fuera, distancia + 1 FROM camino JOIN dentro USING (rol) WHERE distancia < 24
),
papel AS (SELECT miembro, rol, min(distancia) AS distancia FROM camino GROUP BY ALL)
SELECT 'u' || miembro AS miembro, esquema, objeto,
  CASE WHEN value < 50 THEN 'EXECUTE' ELSE 'ALTER' END AS permiso,
  bool_or(NOT niega) AND NOT bool_or(niega) AS permitido, CAST(min(distancia) AS BIGINT) AS distancia
FROM alcance JOIN papel USING (rol) GROUP BY 1, 2, 3, 4
""",
    "missing_members": """
SELECT DISTINCT o.o_orderpriority AS rol, o.o_custkey AS miembro FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders f WHERE f.o_orderstatus = 'F'
  AND f.o_orderpriority = o.o_orderpriority AND f.o_custkey = o.o_custkey)
""",
    "people_with_units": _with_views(
        """
SELECT * FROM persona p WHERE EXISTS (SELECT 1 FROM uf_persona u WHERE u.id_persona = p.id_persona)
"""
    ),
    "people_in_list": _with_views(
        "SELECT * FROM persona WHERE nombre IN ('HOUSEHOLD', 'BUILDING', 'OTHER')"
    ),
}
