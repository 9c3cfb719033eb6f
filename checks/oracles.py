"""DuckDB SQL that gives the expected rows of each query, from the raw tables."""

from __future__ import annotations

import re

from aforo.catalogs import HS_CHAPTERS
from aforo.contracts import EXPORT_FACT, EXPORT_SOURCE, IMPORT_FACT, IMPORT_SOURCE
from aforo.plans.facts import EXPORT_RENAMED, IMPORT_RENAMED
from checks.queries import DIM_QUERIES, PROFILED
from checks.views import MONTH_LIST, VIEWS

ORACLES: dict[str, str] = {}


def _columns(name: str) -> list[str]:
    body = VIEWS[name].split("\nFROM ")[0]
    return re.findall(r" AS (\w+)(?:,?\n|$)", body + "\n")


IMPO, EXPO = _columns("stg_impo"), _columns("stg_expo")


def sql(name: str, body: str, *views: str, **ctes: str) -> None:
    parts = [f"{v} AS ({VIEWS[v]})" for v in views] + [f"{n} AS ({t})" for n, t in ctes.items()]
    ORACLES[name] = f"WITH {', '.join(parts)} {body}" if parts else body


def C(c: str) -> str:
    return f"nullif(trim({c}), '')"


def D8(c: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({c}), '[0-9]{{8}}') AND left(trim({c}), 4) <> '0000' "
            f"THEN CAST(try_strptime(trim({c}), '%Y%m%d') AS DATE) END")


def DEC(c: str, p: int = 18, s: int = 2) -> str:
    return f"CASE WHEN trim({c}) NOT IN ('', 'NaN') THEN TRY_CAST(trim({c}) AS DECIMAL({p},{s})) END"


def INT(c: str) -> str:
    return f"CAST(trunc(TRY_CAST(trim({c}) AS DECIMAL(38,10))) AS INTEGER)"


MONTH_NAME = f"split_part('{MONTH_LIST}', ',', CAST(month(%s) AS INT))"
FOLD = "upper(strip_accents(trim(%s)))"
ISO = ("CASE " + FOLD + " WHEN 'ESTADOS UNIDOS DE AMERICA' THEN 'US' WHEN 'ESTADOS UNIDOS' THEN 'US' "
       "WHEN 'CHINA' THEN 'CN' WHEN 'MEXICO' THEN 'MX' WHEN 'BRASIL' THEN 'BR' WHEN 'JAPON' THEN 'JP' "
       "WHEN 'COREA (SUR) REPUBLICA DE' THEN 'KR' WHEN 'ALEMANIA' THEN 'DE' WHEN 'PERU' THEN 'PE' "
       "WHEN 'ECUADOR' THEN 'EC' WHEN 'ESPANA' THEN 'ES' END")
CHAPTERS = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in HS_CHAPTERS.items()) + ") t(cap, cap_nombre)"
IMPO_DATE = f"coalesce({D8('fecha_aceptacion_declaracion')}, {D8('fecha_presentacion')}, {D8('fecha_manifiesto')})"
EXPO_DATE = f"coalesce({D8('fecha_declaracion_exportacion')}, {D8('fecha_proceso')})"

# ---- sources and ingest
sql("archive_manifest", "SELECT DISTINCT archivo_origen, true AS valido FROM stg_impo", "stg_impo")
sql("archive_members", "SELECT DISTINCT archivo_origen, 'datos.csv' AS miembro, 'csv' AS tipo, ';' AS separador, "
    "CAST(NULL AS VARCHAR) AS error FROM stg_impo", "stg_impo")
sql("period_gaps", f"""
SELECT CAST(year(m) AS INTEGER) AS anio, CAST(month(m) AS INTEGER) AS mes, {MONTH_NAME % 'm'} AS nombre_mes, flujo, archivo
FROM (SELECT m, lower(w) AS flujo,
        lpad(CAST(month(m) AS VARCHAR), 2, '0') || '_' || w || '_' || CAST(year(m) AS VARCHAR) || '_' || {MONTH_NAME % 'm'} || '.zip' AS archivo
      FROM range(DATE '1993-01-01', DATE '2002-04-02', INTERVAL 1 MONTH) r(m), (VALUES ('Importaciones'), ('Exportaciones')) f(w))
WHERE archivo NOT IN (SELECT archivo_origen FROM stg_impo)""", "stg_impo")
sql("ledger_latest", """SELECT archivo_origen, seq, estado, registros FROM (SELECT *, row_number() OVER
    (PARTITION BY archivo_origen ORDER BY seq DESC) rn FROM control_events) WHERE rn = 1""", "control_events")
sql("run_summary", "SELECT estado, count(*) AS n FROM control_events GROUP BY estado", "control_events")
sql("run_summary_sample", """SELECT estado, archivo_origen, seq, CAST(rn AS INTEGER) AS posicion FROM (
    SELECT *, row_number() OVER (PARTITION BY estado ORDER BY seq DESC) rn FROM control_events
    WHERE estado IN ('ERROR', 'EN_PROCESO')) WHERE rn <= 5""", "control_events")
sql("scan_delimited", "SELECT archivo_origen, " + ", ".join(
    f"CASE WHEN {c} NOT IN ('', 'NaN') THEN {c} END AS {c}" for c in IMPO if c != "archivo_origen") + " FROM stg_impo", "stg_impo")
sql("scan_xlsx", "SELECT archivo_origen, " + ", ".join(
    f"nullif({c}, '') AS {c}" for c in EXPO if c != "archivo_origen") + " FROM stg_expo", "stg_expo")
LONGER = "CAST(nit_exportador AS BIGINT) % 13 = 0"
sql("skipped_lines", f"""SELECT archivo_origen, count(*) FILTER (WHERE {LONGER}) AS omitidas, count(*) FILTER (WHERE NOT ({LONGER})) AS registros
    FROM stg_expo GROUP BY 1""", "stg_expo")
sql("clean_headers", """SELECT encabezado, CASE WHEN n = '' THEN 'campo_desconocido' WHEN n BETWEEN '0' AND '9~' THEN 'col_' || n ELSE n END AS limpio
    FROM (SELECT encabezado, trim(regexp_replace(lower(strip_accents(encabezado)), '[^a-z0-9]+', '_', 'g'), '_') AS n
      FROM (SELECT pais_origen AS encabezado FROM stg_impo UNION SELECT tipo_importacion FROM stg_impo
            UNION SELECT nombre_importador FROM stg_impo UNION SELECT valor_fob_usd FROM stg_impo))""", "stg_impo")
sql("drop_blank_rows", """SELECT numero_formulario, cod_aduana_anterior, cod_lugar_ingreso_mcia, lugar_ingreso_mcia,
    CAST(tasa_cambio AS DOUBLE) AS tasa FROM stg_impo
    WHERE NOT (coalesce(cod_aduana_anterior, '') = '' AND coalesce(cod_lugar_ingreso_mcia, '') = ''
      AND coalesce(lugar_ingreso_mcia, '') = '' AND CAST(tasa_cambio AS DOUBLE) = 0)""", "stg_impo")
PERIOD_SQL = """CAST(nullif(regexp_extract(archivo_origen, '(\\d{4})_([A-Za-z]+)', 1), '') AS INTEGER) AS anio_proceso,
    nullif(regexp_extract(archivo_origen, '(\\d{4})_([A-Za-z]+)', 2), '') AS mes_proceso"""
sql("file_period", f"""SELECT archivo_origen, {PERIOD_SQL} FROM
    (SELECT archivo_origen FROM stg_impo UNION SELECT archivo_origen FROM stg_expo)""", "stg_impo", "stg_expo")
sql("stamp_lineage", f"SELECT subpartida, {PERIOD_SQL}, archivo_origen, '2024-05-01 12:30:00' AS fecha_carga FROM stg_expo", "stg_expo")
sql("union_schema", """SELECT archivo_origen, forma_pago, pais_origen, numero_formulario, NULL AS subpartida, NULL AS nit_exportador FROM stg_impo
    UNION ALL SELECT archivo_origen, forma_pago, NULL, NULL, subpartida, nit_exportador FROM stg_expo""", "stg_impo", "stg_expo")
sql("project_contract", "SELECT " + ", ".join(
    c if c in IMPO else f"CAST(NULL AS VARCHAR) AS {c}" for c in [*IMPORT_SOURCE, "archivo_origen"]) + " FROM stg_impo", "stg_impo")
sql("incremental_intake", f"""SELECT archivo_origen, {PERIOD_SQL}, count(*) AS registros FROM stg_expo
    GROUP BY ALL""", "stg_expo")

# ---- scalars
sql("clean_text", "SELECT numero_formulario, " + ", ".join(f"{C(c)} AS {c}" for c in (
    "cod_aduana_presentada", "nombre_exportador", "cod_departamento_destino", "empresa_transportadora",
    "numero_identificac_export")) + " FROM stg_impo", "stg_impo")
sql("sql_clean", "SELECT numero_formulario, " + ", ".join(f"{C(c)} AS {c}" for c in (
    "cod_aduana_presentada", "nombre_exportador", "empresa_transportadora")) + " FROM stg_impo", "stg_impo")
sql("parse_date8", "SELECT numero_formulario, " + ", ".join(f"{D8(c)} AS {c}" for c in (
    "fecha_aceptacion_declaracion", "fecha_presentacion", "fecha_manifiesto")) + " FROM stg_impo", "stg_impo")
sql("first_valid_date", f"SELECT numero_formulario, {IMPO_DATE} AS fecha FROM stg_impo UNION ALL "
    f"SELECT nit_exportador, {EXPO_DATE} FROM stg_expo", "stg_impo", "stg_expo")
sql("parse_decimal", f"""SELECT numero_formulario, {DEC('valor_fob_usd')} AS valor_fob_usd, {DEC('valor_cif_usd')} AS valor_cif_usd,
    {DEC('cantidad', 18, 4)} AS cantidad, {DEC('tasa_cambio', 18, 6)} AS tasa_cambio,
    {DEC('porcentaje_arancel', 9, 4)} AS porcentaje_arancel FROM stg_impo""", "stg_impo")
sql("parse_int", "SELECT numero_formulario, " + ", ".join(
    f"{INT(c)} AS {c}" for c in ("num_cuotas_o_meses", "cantidad", "valor_fob_usd")) + " FROM stg_impo", "stg_impo")


def calendar(d: str) -> str:
    return (f"CAST(coalesce(year({d}), 0) AS INTEGER) AS anio, CAST(quarter({d}) AS INTEGER) AS trimestre, "
            f"CAST(month({d}) AS INTEGER) AS mes, CASE WHEN {d} IS NOT NULL THEN {MONTH_NAME % d} END AS nombre_mes, "
            f"strftime({d}, '%Y-%m') AS anio_mes")


sql("calendar_fields", f"SELECT numero_formulario, fecha, {calendar('fecha')} FROM "
    f"(SELECT numero_formulario, {D8('fecha_presentacion')} AS fecha FROM stg_impo)", "stg_impo")
sql("fold_accents", f"SELECT nombre, {FOLD % 'nombre'} AS plegado FROM (SELECT pais_origen AS nombre FROM stg_impo "
    "UNION SELECT pais_destino_final FROM stg_expo)", "stg_impo", "stg_expo")
sql("country_iso2", f"SELECT numero_formulario, pais_origen, {ISO % 'pais_origen'} AS iso2 FROM (SELECT numero_formulario, pais_origen "
    "FROM stg_impo UNION ALL SELECT nit_exportador, pais_destino_final FROM stg_expo)", "stg_impo", "stg_expo")
sql("hs_chapter", f"""SELECT numero_formulario, subpartida_arancelaria,
    CASE WHEN length({C('subpartida_arancelaria')}) >= 2 THEN left({C('subpartida_arancelaria')}, 2) END AS capitulo, cap_nombre AS capitulo_nombre
    FROM stg_impo LEFT JOIN ch ON cap = CASE WHEN length({C('subpartida_arancelaria')}) >= 2 THEN left({C('subpartida_arancelaria')}, 2) END""",
    "stg_impo", ch=CHAPTERS)
sql("hs_levels", "SELECT {c} AS hs10, left({c}, 2) AS hs2, left({c}, 4) AS hs4, left({c}, 6) AS hs6, left({c}, 8) AS hs8 FROM stg_impo".format(
    c=C("subpartida_arancelaria")), "stg_impo")
sql("coalesce_drift", f"""SELECT {C('cod_aduana_presentada')} AS a, coalesce({C('nit_declarante')}, {C('docto_identif_declar')}) AS b FROM stg_impo
    UNION ALL SELECT coalesce({C('pais_destino_final')}, {C('cod_pais_destino_alf')}), coalesce({C('modalidad_exportacion')}, {C('cod_modalidad_exportacion')}) FROM stg_expo""",
    "stg_impo", "stg_expo")
EXPORTER = f"coalesce({C('numero_identificac_export')}, 'NOMBRE:' || upper({C('nombre_exportador')}))"
sql("surrogate_natural_key", f"""SELECT numero_formulario, {EXPORTER} AS exportador,
    coalesce({C('nit_declarante')}, 'NOMBRE:' || upper({C('nombre_declarante')})) AS agente FROM stg_impo""", "stg_impo")
MOD, SUB = C("moda_codigo_modalidad"), C("cod_modalidad_importacion")
sql("regime_code", f"""SELECT numero_formulario, CASE WHEN {SUB} = 'C100' THEN 'REGIMEN ' || {MOD} ELSE {MOD} || '-' || {SUB} END AS regimen
    FROM stg_impo""", "stg_impo")
sql("upper_text", f"SELECT numero_formulario, upper({C('empresa_transportadora')}) AS empresa FROM stg_impo", "stg_impo")
sql("default_currency", f"SELECT 'USD' AS moneda FROM stg_impo UNION ALL SELECT coalesce({C('cod_moneda_transaccion')}, 'USD') FROM stg_expo",
    "stg_impo", "stg_expo")
sql("resolve_or_fallback", f"""SELECT numero_formulario, coalesce(m.nombre, {C('tipo_declaracion')}, {C('cod_forma_pago')}) AS valor
    FROM stg_impo LEFT JOIN (SELECT {C('cod_forma_pago')} AS k, min({C('forma_pago')}) AS nombre FROM stg_impo GROUP BY 1) m
    ON m.k = {C('cod_forma_pago')}""", "stg_impo")

# ---- filters
sql("by_file", "SELECT numero_formulario, nit_importador FROM stg_impo WHERE archivo_origen = '03_Importaciones_1997_Marzo.zip'", "stg_impo")
sql("not_blank", "SELECT numero_formulario, cod_aduana_anterior FROM stg_impo WHERE trim(cod_aduana_anterior) <> ''", "stg_impo")
sql("by_country", f"SELECT DISTINCT {C('banc_codigo_banco')} AS codigo, 31 AS cod_dim_pais FROM stg_impo", "stg_impo")

# ---- dimension members, straight from the population rules
ROLES = {
    "DimDepartamento": [("cod_departamento_destino", "departamento_destino"), ("codigo_depto_importador", "departamento_importador")],
    "DimMunicipio": [("codigo_municipio", None)],
    "DimBanco": [("banc_codigo_banco", None)],
    "DimFormaPago": [("cod_forma_pago", "forma_pago")],
    "DimTipoDeclaracion": [("cod_tipo_declaracion", "tipo_declaracion")],
    "DimClaseImportador": [("cod_clase_importador", "clase_importador")],
    "DimTipoImportacion": [("cod_tipo_importacion", "tipo_importacion")],
    "DimEmbalaje": [("codigo_embalaje", "clase_de_embalaje")],
    "DimEntidadIntermedia": [("codigo_entidad_intermedia", None)],
    "DimDeposito": [("codigo_deposito", None)],
    "DimActividadEconomica": [("actividad_economica_sec", None)],
    "DimAduana": [("cod_aduana_presentada", "aduana_presentada"), ("cod_aduana_anterior", None), ("cod_lugar_ingreso_mcia", "lugar_ingreso_mcia")],
    "DimPartidas": [("subpartida_arancelaria", None)],
}


def _branch(dim: str, code: str, sub="NULL", name="NULL", address="NULL", phone="NULL", table="stg_impo") -> str:
    return (f"SELECT '{dim}' AS dim, {code} AS codigo, CAST({sub} AS VARCHAR) AS subcodigo, CAST({name} AS VARCHAR) AS nombre, "
            f"CAST({address} AS VARCHAR) AS direccion, CAST({phone} AS VARCHAR) AS telefono, archivo_origen FROM {table}")


def branches(dim: str) -> list[str]:
    if dim in ROLES:
        return [_branch(dim, C(code), name=C(name) if name else "NULL") for code, name in ROLES[dim]]
    return [{
        "DimEmpresaTransportadora": lambda: _branch(dim, f"upper({C('empresa_transportadora')})"),
        "DimModalidad": lambda: _branch(dim, f"CASE WHEN {SUB} IS NOT NULL THEN {MOD} END", sub=SUB),
        "DimImportador": lambda: _branch(dim, C("nit_importador"), name=C("nombre_importador"),
                                         address="direccion_importador", phone="telefono_importador"),
        "DimExportador": lambda: _branch(dim, f"CASE WHEN {C('nombre_exportador')} IS NOT NULL THEN {EXPORTER} END",
                                         name=C("nombre_exportador")),
        "DimAgenteAduanero": lambda: _branch(dim, f"coalesce({C('nit_declarante')}, {C('docto_identif_declar')})",
                                             name=C("nombre_declarante")),
    }[dim]()]


def role_rows(*dims: str) -> str:
    rows = " UNION ALL ".join(b for d in dims for b in branches(d))
    return f"SELECT * FROM ({rows}) WHERE codigo IS NOT NULL"


BACKFILL = """SELECT dim, codigo, subcodigo,
    CASE WHEN dim = 'DimDepartamento' THEN coalesce(min(nombre), '') ELSE min(nombre) END AS nombre,
    min(direccion) AS direccion, min(telefono) AS telefono, 31 AS cod_dim_pais FROM roles GROUP BY dim, codigo, subcodigo"""
FIRST_FILE = """SELECT dim, codigo, subcodigo, archivo_origen AS desde_archivo,
    CASE WHEN dim = 'DimDepartamento' THEN coalesce(nombre, '') ELSE nombre END AS nombre, direccion, telefono, 31 AS cod_dim_pais
  FROM (SELECT *, row_number() OVER (PARTITION BY dim, codigo, subcodigo ORDER BY archivo_origen) AS rn
    FROM (SELECT dim, codigo, subcodigo, archivo_origen, min(nombre) AS nombre, min(direccion) AS direccion, min(telefono) AS telefono
          FROM roles GROUP BY ALL)) WHERE rn = 1"""
ALL_DIMS = list(DIM_QUERIES.values())
SEEDED = [d for d in ALL_DIMS if d not in ("DimAduana", "DimImportador", "DimExportador", "DimAgenteAduanero", "DimPartidas")]
SEEDS = "SELECT * FROM (VALUES " + ", ".join(
    f"('{d}', '{'NO RELACIONADO' if d == 'DimEmpresaTransportadora' else '-1'}', "
    f"{chr(39) + '-1' + chr(39) if d == 'DimModalidad' else 'NULL'}, {'NULL' if d == 'DimEmpresaTransportadora' else chr(39) + 'NO RELACIONADO' + chr(39)}, 1)"
    for d in SEEDED) + ") t(dim, codigo, subcodigo, nombre, cod_dim_pais)"

for key, dim in DIM_QUERIES.items():
    shown = {
        "DimEmpresaTransportadora": "codigo AS nombre",
        "DimModalidad": "codigo AS codigo_modalidad, subcodigo AS codigo_sub_modalidad, nombre",
        "DimImportador": "codigo AS nit, nombre, direccion, telefono",
        "DimExportador": "codigo AS nit, nombre, direccion",
        "DimAgenteAduanero": "codigo AS nit, nombre",
        "DimPartidas": "codigo AS hs10, left(codigo, 2) AS hs2, left(codigo, 4) AS hs4, left(codigo, 6) AS hs6, left(codigo, 8) AS hs8",
    }.get(dim, "codigo, nombre")
    sql(key, f"SELECT {shown}, cod_dim_pais FROM m", "stg_impo", roles=role_rows(dim), m=BACKFILL)
sql("dim_backfill", "SELECT * FROM m", "stg_impo", roles=role_rows(*ALL_DIMS), m=BACKFILL)
sql("dim_first_file_wins", "SELECT * FROM m", "stg_impo", roles=role_rows(*ALL_DIMS), m=FIRST_FILE)
sql("dim_seed_members", "SELECT dim, codigo, subcodigo, nombre, cod_dim_pais FROM m UNION ALL SELECT * FROM seeds", "stg_impo",
    roles=role_rows(*ALL_DIMS), m=BACKFILL, seeds=SEEDS)
sql("assign_surrogate_ids", """SELECT row_number() OVER (PARTITION BY dim ORDER BY codigo, subcodigo) +
    CASE WHEN dim IN (SELECT dim FROM seeds) THEN 1 ELSE 0 END AS id, dim, codigo, subcodigo FROM m""", "stg_impo",
    roles=role_rows(*ALL_DIMS), m=BACKFILL, seeds=SEEDS)
sql("stream_new_members", """SELECT row_number() OVER (PARTITION BY dim ORDER BY lote, codigo, subcodigo) AS id,
    dim, codigo, subcodigo, nombre, direccion, telefono, cod_dim_pais FROM (
    SELECT CASE WHEN desde_archivo < '07' THEN 1 ELSE 2 END AS lote, dim, codigo, subcodigo, nombre, direccion, telefono, cod_dim_pais FROM m
    UNION ALL SELECT 0, dim, codigo, subcodigo, nombre, NULL, NULL, cod_dim_pais FROM seeds)""",
    "stg_impo", roles=role_rows(*ALL_DIMS), m=FIRST_FILE, seeds=SEEDS)
EXPO_AGENTS = f"""SELECT 'DimAgenteAduanero' AS dim, {C('nit_declarante')} AS codigo, min({C('razon_social_declarante')}) AS nombre
    FROM stg_expo WHERE {C('nit_declarante')} IS NOT NULL GROUP BY 2"""
sql("insert_ignore", "SELECT codigo, nombre, 31 AS cod_dim_pais FROM a WHERE codigo NOT IN (SELECT codigo FROM m)",
    "stg_impo", "stg_expo", roles=role_rows("DimAgenteAduanero"), m=BACKFILL, a=EXPO_AGENTS)
sql("append_new_members", """SELECT row_number() OVER (ORDER BY lote, codigo) AS id, codigo, nombre FROM (
    SELECT 1 AS lote, codigo, nombre FROM m UNION ALL SELECT 2, codigo, nombre FROM a WHERE codigo NOT IN (SELECT codigo FROM m))""",
    "stg_impo", "stg_expo", roles=role_rows("DimAgenteAduanero"), m=BACKFILL, a=EXPO_AGENTS)
sql("orphan_check", "SELECT DISTINCT nit_declarante FROM stg_expo WHERE nit_declarante NOT IN (SELECT codigo FROM roles)",
    "stg_impo", "stg_expo", roles=role_rows("DimAgenteAduanero"))
sql("union_role_keys", "SELECT archivo_origen, codigo, nombre FROM roles", "stg_impo", roles=role_rows("DimDepartamento"))
sql("union_all_roles", "SELECT codigo, nombre FROM roles", "stg_impo", roles=role_rows("DimAduana"))

# ---- joins
ADU = "(SELECT codigo, nombre FROM m WHERE dim = 'DimAduana')"
sql("dim_lookup_join", f"""SELECT numero_formulario, a.nombre AS aduana_presentada, b.nombre AS aduana_anterior, i.nombre AS importador
    FROM stg_impo s LEFT JOIN {ADU} a ON a.codigo = {C('cod_aduana_presentada')} LEFT JOIN {ADU} b ON b.codigo = {C('cod_aduana_anterior')}
    LEFT JOIN (SELECT codigo, nombre FROM m WHERE dim = 'DimImportador') i ON i.codigo = {C('nit_importador')}""",
    "stg_impo", roles=role_rows("DimAduana", "DimImportador"), m=BACKFILL)
sql("composite_lookup_join", f"""SELECT numero_formulario, {MOD} AS codigo, {SUB} AS subcodigo,
    CASE WHEN {SUB} = 'C100' THEN 'REGIMEN ' || {MOD} END AS nombre FROM stg_impo""", "stg_impo")
sql("collated_lookup_join", f"""SELECT numero_formulario, {C('departamento_destino')} AS codigo, nombre FROM stg_impo LEFT JOIN (
    SELECT {C('departamento_destino')} AS k, min({C('cod_departamento_destino')}) AS nombre FROM stg_impo GROUP BY 1) d ON k = {C('departamento_destino')}""", "stg_impo")
FIRST_GEO = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ISO2 ORDER BY Id_DimPais) rn FROM dim_pais WHERE ISO2 IS NOT NULL) WHERE rn = 1"""


def geo(role: str) -> str:
    return (f"g.Continente AS continente_{role}, g.Subcontinente AS subcontinente_{role}, "
            f"g.BloqueEconomico AS bloque_economico_{role}, g.Region AS region_{role}")


sql("geo_enrich_join", f"SELECT numero_formulario, pais, {geo('origen')} FROM (SELECT numero_formulario, lower({ISO % 'pais_origen'}) AS pais FROM stg_impo) "
    "LEFT JOIN g ON g.ISO2 = upper(pais)", "stg_impo", "dim_pais", g=FIRST_GEO)
sql("first_per_iso2", "SELECT ISO2, Id_DimPais, Continente, Subcontinente, BloqueEconomico, Region FROM g", "dim_pais", g=FIRST_GEO)

# ---- control state by plain window functions
STATE = """SELECT tabla_origen, archivo_origen, fase, arg_max(estado, seq) AS estado,
    arg_max(CASE WHEN estado = 'SUCCESS' THEN registros END, CASE WHEN estado = 'SUCCESS' THEN seq END) AS registros,
    arg_max(CASE WHEN estado = 'SUCCESS' THEN segundos END, CASE WHEN estado = 'SUCCESS' THEN seq END) AS segundos,
    max(CASE WHEN estado = 'EN_PROCESO' THEN fecha END) AS inicio,
    max(CASE WHEN estado <> 'EN_PROCESO' AND seq > ult THEN fecha END) AS fin,
    arg_max(CASE WHEN estado = 'ERROR' AND seq > ult THEN mensaje END, CASE WHEN estado = 'ERROR' AND seq > ult THEN seq END) AS mensaje_error
  FROM (SELECT *, max(CASE WHEN estado = 'EN_PROCESO' THEN seq END) OVER k AS ult, min(CASE WHEN estado = 'EN_PROCESO' THEN seq END) OVER k AS prim
        FROM ev WINDOW k AS (PARTITION BY tabla_origen, archivo_origen, fase)) WHERE seq >= prim GROUP BY 1, 2, 3"""
EV = "SELECT * FROM control_events"
TS = "strftime(%s, '%%Y-%%m-%%d %%H:%%M:%%S.%%f')"
sql("control_state", f"""SELECT tabla_origen, archivo_origen, fase, estado, registros, segundos, {TS % 'inicio'} AS fecha_inicio,
    {TS % 'fin'} AS fecha_fin, mensaje_error FROM st""", "control_events", ev=EV, st=STATE)
sql("control_success", "SELECT tabla_origen, archivo_origen, fase, estado, registros, segundos FROM st WHERE estado = 'SUCCESS'",
    "control_events", ev=EV, st=STATE)
sql("control_error", f"SELECT tabla_origen, archivo_origen, fase, estado, {TS % 'fin'} AS fecha_fin, mensaje_error FROM st WHERE estado = 'ERROR'",
    "control_events", ev=EV, st=STATE)
sql("control_start", f"""SELECT tabla_origen, archivo_origen, fase, estado, registros, {TS % 'inicio'} AS fecha_inicio,
    {TS % 'fin'} AS fecha_fin, mensaje_error FROM st WHERE fase = 'HECHOS'""", "control_events",
    ev="""SELECT * FROM control_events UNION ALL SELECT DISTINCT 'temporal_impo', archivo_origen, 'HECHOS', 'EN_PROCESO', 1152921504606846976,
          TIMESTAMP '2024-05-01 12:30:00', NULL::BIGINT, NULL::DECIMAL(10,2), NULL FROM control_events WHERE fase = 'HECHOS'""", st=STATE)
PENDING = """SELECT DISTINCT archivo_origen FROM stg_impo WHERE archivo_origen NOT IN
    (SELECT archivo_origen FROM st WHERE tabla_origen = 'temporal_impo' AND fase = 'HECHOS' AND estado = 'SUCCESS')"""
sql("pending_anti_join", PENDING, "stg_impo", "control_events", ev=EV, st=STATE)
sql("ordered_pending", PENDING + " ORDER BY 1", "stg_impo", "control_events", ev=EV, st=STATE)
sql("purge_staging", """SELECT archivo_origen, numero_formulario FROM stg_impo WHERE archivo_origen NOT IN
    (SELECT archivo_origen FROM st WHERE estado = 'SUCCESS' AND fase = 'HECHOS' AND tabla_origen = 'temporal_impo')""",
    "stg_impo", "control_events", ev=EV, st=STATE)

# ---- aggregations and sinks
sql("distinct_values", f"""SELECT DISTINCT {C('codigo_municipio')} AS municipio, upper({C('empresa_transportadora')}) AS empresa
    FROM stg_impo WHERE trim(codigo_municipio) <> '' AND trim(empresa_transportadora) <> ''""", "stg_impo")
sql("min_attrs_by_key", """SELECT nit_importador, min(direccion_importador) AS direccion_importador,
    min(telefono_importador) AS telefono_importador, min(tipo_declaracion) AS tipo_declaracion FROM stg_impo GROUP BY 1""", "stg_impo")
YEARLY = f"SELECT archivo_origen, CAST(coalesce(year({IMPO_DATE}), 0) AS INTEGER) AS anio, {DEC('valor_fob_usd')} AS valor_fob_usd FROM stg_impo"
VOTE = """SELECT archivo_origen, anio FROM (SELECT archivo_origen, anio, row_number() OVER (PARTITION BY archivo_origen ORDER BY count(*) DESC, anio) rn
    FROM y GROUP BY archivo_origen, anio) WHERE rn = 1"""
sql("predominant_year", "SELECT * FROM v", "stg_impo", y=YEARLY, v=VOTE)
sql("rows_per_file", "SELECT archivo_origen, count(*) AS registros FROM stg_impo GROUP BY 1", "stg_impo")
sql("top1_by_count", "SELECT anio, count(*) AS n FROM y GROUP BY 1 ORDER BY n DESC, anio LIMIT 1", "stg_impo", y=YEARLY)
sql("is_empty_probe", f"""SELECT 'stg_impo' AS tabla, count(*) = 0 AS vacia FROM stg_impo UNION ALL
    SELECT 'sin_fecha', count(*) = 0 FROM stg_impo WHERE {IMPO_DATE} IS NULL UNION ALL
    SELECT 'sin_archivo', count(*) = 0 FROM stg_impo WHERE archivo_origen IS NULL""", "stg_impo")
sql("replace_by_file", """SELECT archivo_origen, subpartida, CASE WHEN archivo_origen LIKE '01#_%' ESCAPE '#' THEN '0' ELSE valor_fob_usd END AS valor_fob_usd
    FROM stg_expo WHERE archivo_origen NOT LIKE '02#_%' ESCAPE '#'""", "stg_expo")
sql("assign_row_ids", """SELECT archivo_origen, n, fin - n + 1 AS primero, fin AS ultimo, n AS distintos FROM (
    SELECT archivo_origen, n, CAST(1000 + sum(n) OVER (ORDER BY archivo_origen) AS BIGINT) AS fin FROM (SELECT archivo_origen, count(*) AS n FROM stg_expo GROUP BY 1))""", "stg_expo")
OUTBOX = """SELECT 'colombia' AS pais, 'IMPORTACION' AS tipo_intercambio, 'sp_extraer_importacion_por_archivo' AS procedimiento_almacenado,
    archivo_origen AS archivo, anio, 'PENDIENTE' AS estado, '' AS detalle, '2024-05-01 12:30:00' AS fecha, '2024-05-01 12:30:00' AS fecha_actualizacion FROM v"""
sql("outbox_append", f"{OUTBOX} UNION ALL {OUTBOX}", "stg_impo", y=YEARLY, v=VOTE)
sql("write_by_year", "SELECT anio, count(*) AS n, CAST(sum(valor_fob_usd) AS DECIMAL(38,2)) AS valor_fob_usd FROM y GROUP BY 1", "stg_impo", y=YEARLY)

# ---- facts
IMPO_RESOLVED = {
    "departamento_destino": ("DimDepartamento", C("cod_departamento_destino"), C("departamento_destino")),
    "departamento_importador": ("DimDepartamento", C("codigo_depto_importador"), C("departamento_importador")),
    "municipio": ("DimMunicipio", C("codigo_municipio"), "NULL"),
    "aduana_presentada": ("DimAduana", C("cod_aduana_presentada"), C("aduana_presentada")),
    "aduana_anterior": ("DimAduana", C("cod_aduana_anterior"), "NULL"),
    "importador": ("DimImportador", C("nit_importador"), C("nombre_importador")),
    "exportador": ("DimExportador", EXPORTER, C("nombre_exportador")),
    "agente_aduanero": ("DimAgenteAduanero", f"coalesce({C('nit_declarante')}, {C('docto_identif_declar')})", C("nombre_declarante")),
    "forma_pago": ("DimFormaPago", C("cod_forma_pago"), C("forma_pago")),
    "banco": ("DimBanco", C("banc_codigo_banco"), "NULL"),
    "tipo_declaracion": ("DimTipoDeclaracion", C("cod_tipo_declaracion"), C("tipo_declaracion")),
    "clase_importador": ("DimClaseImportador", C("cod_clase_importador"), C("clase_importador")),
    "tipo_importacion": ("DimTipoImportacion", C("cod_tipo_importacion"), C("tipo_importacion")),
    "embalaje": ("DimEmbalaje", C("codigo_embalaje"), C("clase_de_embalaje")),
    "entidad_intermedia": ("DimEntidadIntermedia", C("codigo_entidad_intermedia"), "NULL"),
    "deposito": ("DimDeposito", C("codigo_deposito"), "NULL"),
    "actividad_economica": ("DimActividadEconomica", C("actividad_economica_sec"), "NULL"),
}
EXPO_RESOLVED = {
    "aduana_despacho": ("DimAduana", C("cod_aduana_despacho"), C("aduana_despacho")),
    "exportador": ("DimExportador", C("nit_exportador"), C("razon_social_exportador")),
    "agente_aduanero": ("DimAgenteAduanero", C("nit_declarante"), C("razon_social_declarante")),
    "forma_pago": ("DimFormaPago", C("forma_pago"), "NULL"),
}


def _fact(table: str, columns, resolved: dict, own: dict[str, str], date: str, code: str) -> str:
    kinds = {"int": "INTEGER", "smallint": "INTEGER", "string": "VARCHAR", "date": "DATE"}
    calendar_columns = {"anio", "trimestre", "mes", "nombre_mes", "anio_mes"}
    joins, shown = [], ["CAST(d AS DATE) AS fecha_declaracion", calendar("d")]
    for i, (target, (dim, key, raw)) in enumerate(resolved.items()):
        joins.append(f"LEFT JOIN m m{i} ON m{i}.dim = '{dim}' AND m{i}.codigo = {key} AND m{i}.desde_archivo <= s.archivo_origen")
        own = {**own, target: f"coalesce(nullif(m{i}.nombre, ''), {raw}, {key})"}
    for name, kind in columns:
        if name == "fecha_declaracion" or name in calendar_columns:
            continue
        text = kind.simpleString()
        shown.append(f"CAST({own.get(name, 'NULL')} AS {kinds.get(text, text)}) AS {name}")
    chapter = f"CASE WHEN length({code}) >= 2 THEN left({code}, 2) END"
    return (f"SELECT {', '.join(shown)} FROM (SELECT *, {date} AS d FROM {table}) s {' '.join(joins)} LEFT JOIN ch ON cap = {chapter}")



IMPO_OWN = {
    "pais_origen": ISO % "pais_origen", "pais_origen_nombre": C("pais_origen"), "pais_procedencia": C("pais_procedencia"),
    "nit_importador": C("nit_importador"), "empresa_transportadora": f"upper({C('empresa_transportadora')})",
    "partida_arancelaria": C("subpartida_arancelaria"), "capitulo_nombre": "cap_nombre",
    "regimen_aduanero": f"{MOD} || '-' || {SUB}", "moneda": "'USD'",
    "cantidad": DEC("cantidad", 18, 4), "tasa_cambio": DEC("tasa_cambio", 18, 6), "num_cuotas_o_meses": INT("num_cuotas_o_meses"),
    "valor_fob_usd": DEC("valor_fob_usd"), "valor_cif_usd": DEC("valor_cif_usd"), "porcentaje_arancel": DEC("porcentaje_arancel", 9, 4),
    "numero_formulario": C("numero_formulario"), "descripcion_mercancia": C("descripcion_mercancia"), "archivo_origen": "s.archivo_origen",
}
CODE = C("subpartida_arancelaria")
IMPO_OWN["capitulo"] = f"CASE WHEN length({CODE}) >= 2 THEN left({CODE}, 2) END"
EXPO_NAME = f"coalesce({C('pais_destino_final')}, {C('cod_pais_destino_alf')})"
EXPO_CODE = C("subpartida")
EXPO_OWN = {
    "pais_destino": ISO % EXPO_NAME, "pais_destino_nombre": EXPO_NAME, "nit_exportador": C("nit_exportador"),
    "partida_arancelaria": EXPO_CODE, "capitulo": f"CASE WHEN length({EXPO_CODE}) >= 2 THEN left({EXPO_CODE}, 2) END",
    "capitulo_nombre": "cap_nombre",
    "modalidad_exportacion": f"coalesce({C('modalidad_exportacion')}, {C('cod_modalidad_exportacion')})",
    "moneda": f"coalesce({C('cod_moneda_transaccion')}, 'USD')", "valor_fob_usd": DEC("valor_fob_usd"),
    "peso_neto": DEC("peso_neto_kgs", 18, 4), "archivo_origen": "s.archivo_origen",
}
FACT_IMPO = _fact("stg_impo", IMPORT_FACT, IMPO_RESOLVED, IMPO_OWN, IMPO_DATE, CODE)
FACT_EXPO = _fact("stg_expo", EXPORT_FACT, EXPO_RESOLVED, EXPO_OWN, EXPO_DATE, EXPO_CODE)
IMPO_CTES = {"roles": role_rows(*ALL_DIMS), "m": FIRST_FILE, "ch": CHAPTERS, "f": FACT_IMPO}
EXPO_FIRST = f"""SELECT 'DimAgenteAduanero' AS dim, codigo, desde_archivo, nombre FROM (SELECT *, row_number() OVER (PARTITION BY codigo ORDER BY desde_archivo) rn
    FROM (SELECT {C('nit_declarante')} AS codigo, archivo_origen AS desde_archivo, min({C('razon_social_declarante')}) AS nombre FROM stg_expo
          WHERE {C('nit_declarante')} IS NOT NULL GROUP BY 1, 2)) WHERE rn = 1"""
KNOWN = """SELECT dim, codigo, '' AS desde_archivo, nombre FROM m0 UNION ALL
    SELECT * FROM a WHERE codigo NOT IN (SELECT codigo FROM m0 WHERE dim = 'DimAgenteAduanero')"""
EXPO_CTES = {"roles": role_rows(*ALL_DIMS), "m0": FIRST_FILE, "a": EXPO_FIRST, "m": KNOWN, "ch": CHAPTERS, "f": FACT_EXPO}
sql("fact_importacion", "SELECT * FROM f", "stg_impo", **IMPO_CTES)
sql("fact_exportacion", "SELECT * FROM f", "stg_impo", "stg_expo", **EXPO_CTES)
sql("stream_facts_by_file", "SELECT * FROM f", "stg_expo", m=EXPO_FIRST, ch=CHAPTERS, f=FACT_EXPO)


def _plain(fact, renamed: dict[str, str], known: dict[str, str], resolved: dict) -> dict[str, str]:
    """Fact columns that are cleaned or parsed copies of one staged column."""
    out = {}
    for name, kind in fact:
        if name not in known and name not in resolved:
            text, c = kind.simpleString(), renamed.get(name, name)
            out[name] = DEC(c, kind.precision, kind.scale) if text.startswith("decimal") else INT(c) if text == "int" else C(c)
    return out


IMPO_ALL = {**IMPO_RESOLVED, "aduana_exportacion": ("DimAduana", C("cod_aduana_export"), "NULL")}
IMPO_ALL["agente_aduanero"] = (*IMPO_RESOLVED["agente_aduanero"][:2], f"coalesce({C('nombre_declarante')}, {C('razon_social_declarante')})")
EXPO_ALL = {
    **EXPO_RESOLVED, "aduana_salida": ("DimAduana", C("cod_aduana_salida"), C("aduana_salida")),
    "tipo_declaracion": ("DimTipoDeclaracion", C("tipo_declaracion"), "NULL"),
}
CALENDAR_OWN = dict.fromkeys(("fecha_declaracion", "anio", "trimestre", "mes", "nombre_mes", "anio_mes"))
EXPO_FULL_NAME = f"coalesce({C('pais_destino_final')}, {C('cod_pais_destino_alf')}, {C('cod_pais_destino')})"
EXPO_FULL_DATE = f"coalesce({D8('fecha_declaracion_exportacion')}, {D8('fech_decla_exportacion_ant')}, {D8('fecha_proceso')})"
FULL_ROLES = role_rows(*ALL_DIMS).replace(
    _branch("DimAgenteAduanero", f"coalesce({C('nit_declarante')}, {C('docto_identif_declar')})", name=C("nombre_declarante")),
    _branch("DimAgenteAduanero", f"coalesce({C('nit_declarante')}, {C('docto_identif_declar')})",
            name=f"coalesce({C('nombre_declarante')}, {C('razon_social_declarante')})")
    + " UNION ALL " + _branch("DimAduana", C("cod_aduana_export")))
IMPO_FULL_OWN = {**IMPO_OWN, **_plain(IMPORT_FACT, IMPORT_RENAMED, {**IMPO_OWN, **CALENDAR_OWN}, IMPO_ALL)}
EXPO_FULL_OWN = {**EXPO_OWN, "pais_destino": ISO % EXPO_FULL_NAME, "pais_destino_nombre": EXPO_FULL_NAME}
EXPO_FULL_OWN |= _plain(EXPORT_FACT, EXPORT_RENAMED, {**EXPO_FULL_OWN, **CALENDAR_OWN}, EXPO_ALL)
sql("fact_importacion_full", "SELECT * FROM f", stg_impo=VIEWS["stg_impo_full"], roles=FULL_ROLES, m=FIRST_FILE, ch=CHAPTERS,
    f=_fact("stg_impo", IMPORT_FACT, IMPO_ALL, IMPO_FULL_OWN, IMPO_DATE, CODE))
EXPO_FIRST_ROLES = " UNION ALL ".join(
    f"SELECT '{dim}' AS dim, {code} AS codigo, NULL AS subcodigo, {name} AS nombre, NULL AS direccion, NULL AS telefono, archivo_origen "
    f"FROM stg_expo WHERE {code} IS NOT NULL" for dim, code, name in (
        ("DimAgenteAduanero", C("nit_declarante"), C("razon_social_declarante")),))
sql("fact_exportacion_full", "SELECT * FROM f", stg_expo=VIEWS["stg_expo_full"], roles=EXPO_FIRST_ROLES, m=FIRST_FILE, ch=CHAPTERS,
    f=_fact("stg_expo", EXPORT_FACT, EXPO_ALL, EXPO_FULL_OWN, EXPO_FULL_DATE, EXPO_CODE))
sql("trade_by_chapter", """SELECT anio, capitulo, count(*) AS n, CAST(sum(valor_fob_usd) AS DECIMAL(38,2)) AS valor_fob_usd
    FROM f GROUP BY 1, 2""", "stg_impo", **IMPO_CTES)
sql("view_fact_alias", "SELECT anio, aduana_presentada, count(*) AS n FROM f GROUP BY 1, 2", "stg_impo", **IMPO_CTES)
sql("fact_batch_rebuild", "SELECT * FROM f", "stg_impo", **IMPO_CTES)
sql("fact_batch_states", "SELECT archivo_origen, 'SUCCESS' AS estado, count(*) AS registros, count(*) AS ids FROM stg_impo GROUP BY 1", "stg_impo")
sql("fact_ids", """SELECT archivo_origen, n, CAST(ultimo - n + 1 AS BIGINT) AS primero, CAST(ultimo AS BIGINT) AS ultimo FROM (
    SELECT archivo_origen, n, sum(n) OVER (ORDER BY archivo_origen) AS ultimo FROM (SELECT archivo_origen, count(*) AS n FROM stg_impo GROUP BY 1))""", "stg_impo")
IDENTIFIED = "f.*, true AS id, true AS fecha_carga_dw"
sql("extract_import_by_file", f"SELECT {IDENTIFIED}, {geo('origen')} FROM f LEFT JOIN g ON g.ISO2 = upper(f.pais_origen) "
    "WHERE archivo_origen = '03_Importaciones_1997_Marzo.zip'", "stg_impo", "dim_pais", **IMPO_CTES, g=FIRST_GEO)
sql("extract_export_by_file", f"SELECT {IDENTIFIED}, {geo('destino')} FROM f LEFT JOIN g ON g.ISO2 = upper(f.pais_destino)",
    "stg_impo", "stg_expo", "dim_pais", **EXPO_CTES, g=FIRST_GEO)
sql("extract_function", f"SELECT {IDENTIFIED}, {geo('origen')} FROM f LEFT JOIN g ON g.ISO2 = upper(f.pais_origen) "
    "WHERE archivo_origen = '07_Importaciones_1998_Julio.zip'", "stg_impo", "dim_pais", **IMPO_CTES, g=FIRST_GEO)
sql("search_documents", "SELECT true AS id, true AS fecha_carga_dw, " + ", ".join(
    f"CAST({n} AS DOUBLE) AS {n}" if t.simpleString().startswith("decimal") else n for n, t in IMPORT_FACT if n != "archivo_origen"
) + ", 'colombia_importacion_' || CAST(anio AS VARCHAR) AS indice FROM f", "stg_impo", **IMPO_CTES)
sql("stream_stage_files", "SELECT " + ", ".join(
    f"nullif({c}, '') AS {c}" if c in EXPO else f"CAST(NULL AS VARCHAR) AS {c}" for c in [*EXPORT_SOURCE, "archivo_origen"]
) + " FROM stg_expo", "stg_expo")

# ---- quality
sql("profile_cardinality", " UNION ALL ".join(
    f"SELECT '{c}' AS columna, count(DISTINCT {C(c)}) AS distintos FROM stg_impo" for c in PROFILED), "stg_impo")
sql("fill_rate", " UNION ALL ".join(
    f"SELECT '{c}' AS columna, count({C(c)}) / count(*) AS llenado FROM stg_impo" for c in PROFILED), "stg_impo")
sql("classify_columns", "SELECT columna, distintos, CASE WHEN llenado < 0.001 THEN 'auditoria' WHEN numerico >= 0.95 THEN 'medida' "
    "WHEN distintos / filas >= 0.5 THEN 'documento' ELSE 'dimension' END AS clase FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS columna, count(DISTINCT {C(c)}) AS distintos, count(*) AS filas, count({C(c)}) / count(*) AS llenado, "
        f"avg(CASE WHEN {C(c)} IS NOT NULL THEN CAST(TRY_CAST({C(c)} AS DECIMAL(38,10)) IS NOT NULL AND contains({c}, '.') AS INTEGER) END) AS numerico "
        "FROM stg_impo" for c in PROFILED) + ")", "stg_impo")
sql("profile_sketches", "SELECT columna, filas, llenado, true AS cerca FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS columna, count(*) AS filas, count({C(c)}) / count(*) AS llenado FROM stg_impo" for c in PROFILED if c != "archivo_origen") + ")", "stg_impo")
sql("iso2_coverage", f"SELECT count(*) AS filas, count(iso2) AS con_iso2, count(iso2) / count(*) AS proporcion FROM (SELECT {ISO % 'pais_origen'} AS iso2 FROM stg_impo)", "stg_impo")
sql("iso2_unmatched", f"SELECT pais_origen, count(*) AS filas FROM stg_impo WHERE ({ISO % 'pais_origen'}) IS NULL AND pais_origen IS NOT NULL GROUP BY 1", "stg_impo")
sql("unique_key_check", "SELECT numero_formulario, count(*) AS n FROM stg_impo GROUP BY 1 HAVING count(*) > 1", "stg_impo")
sql("composite_key_evidence", f"""SELECT {SUB} AS subcodigo, count(DISTINCT {MOD}) AS prefijos FROM stg_impo WHERE {SUB} IS NOT NULL AND {MOD} IS NOT NULL
    GROUP BY 1 HAVING count(DISTINCT {MOD}) > 1""", "stg_impo")
