"""Column contracts: what the staging files may hold and what the facts look like.

Staging is all text. A column that a file vintage lacks reads as NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FILE = "archivo_origen"
LINEAGE = T.StructType([
    T.StructField("anio_proceso", T.IntegerType()),
    T.StructField("mes_proceso", T.StringType()),
    T.StructField(FILE, T.StringType()),
    T.StructField("fecha_carga", T.TimestampType()),
])

# The seven duties and the four columns each of them has.
DUTIES = ("arancel", "iva", "sancion", "salvaguardia", "derechos_comp", "antidumping", "rescate")
DUTY_FIELDS = (("porcentaje", 9, 4), ("base", 18, 2), ("total_liquidado", 18, 2), ("total_a_pagar", 18, 2))


def duty_columns(*duties: str) -> list[str]:
    return [f"{field}_{duty}" for duty in duties for field, _, _ in DUTY_FIELDS]


# Column names of the monthly import files, by subject.
IMPORT_SOURCE = [
    # dates
    "fecha_aceptacion_declaracion", "fecha_presentacion", "fecha_manifiesto",
    "fecha_declaracion_ant", "fecha_documento_transp", "fecha_declara_cambio",
    "fecha_factura", "fecha_declaracion_export", "fecha_recibo_pago_anterior",
    # countries
    "pais_origen", "pais_procedencia", "pais_compra", "pais_exportador", "bandera_transporte",
    # places
    "cod_departamento_destino", "departamento_destino",
    "codigo_depto_importador", "departamento_importador", "codigo_municipio",
    # customs offices
    "cod_aduana_presentada", "cod_administracion_presentada_1",
    "aduana_presentada", "nombre_aduana_1", "cod_aduana_anterior", "cod_aduana_export",
    # parties
    "nit_importador", "nombre_importador", "numero_identificac_export", "nombre_exportador",
    "nit_declarante", "docto_identif_declar", "nombre_declarante", "razon_social_declarante",
    "empresa_transportadora",
    # goods and codes
    "subpartida_arancelaria", "unidad_comercial", "cod_forma_pago", "forma_pago",
    "banc_codigo_banco", "moda_codigo_modalidad", "cod_modalidad_importacion",
    "cod_tipo_declaracion", "tipo_declaracion", "cod_clase_importador", "clase_importador",
    "cod_tipo_importacion", "tipo_importacion", "modo_transporte",
    "codigo_embalaje", "clase_de_embalaje", "codigo_acuerdo",
    "codigo_entidad_intermedia", "codigo_deposito", "actividad_economica_sec",
    # quantities
    "peso_neto", "peso_bruto", "cantidad", "cantidad_subpartidas", "numero_bultos",
    "tasa_cambio", "num_cuotas_o_meses",
    # values
    "valor_fob_usd", "valor_cif_usd", "valor_aduana_usd", "valor_ajuste_usd",
    "valor_fletes_usd", "valor_seguros_usd", "valor_otros_gastos_usd",
    "fletes_seguros1", "valor_cuota_usd",
    # duties
    *duty_columns("arancel", "iva"),
    "porcentaje_otros1", "base_otros1", "subtotal_otros1", "valor_total_otros", "otros_pagados",
    *duty_columns("sancion", "salvaguardia", "derechos_comp", "antidumping", "rescate"),
    # totals
    "total_item1", "valor_total_arancel", "valor_total_iva", "total_liquidado",
    "pago_total", "valor_pagos_anteriores",
    # documents
    "numero_formulario", "num_aceptacion_declaracion", "numero_factura",
    "documento_transporte", "manifiesto_de_carga", "descripcion_mercancia",
]

# Further import columns that only the dimension rules read.
RULE_ONLY_SOURCE = [
    "cod_lugar_ingreso_mcia", "lugar_ingreso_mcia",
    "direccion_importador", "telefono_importador", "direccion_exportador",
]

# Column names of the monthly export files, by subject.
EXPORT_SOURCE = [
    "fecha_declaracion_exportacion", "fech_decla_exportacion_ant", "fech_decla_precedente",
    "fecha_solicitud_auto_embarque", "fecha_proceso",
    "cod_pais_destino_alf", "cod_pais_destino", "pais_destino_final",
    "region_de_origen", "region_procedencia", "ciudad_destinatario",
    "cod_aduana_despacho", "aduana_despacho", "cod_aduana_salida", "aduana_salida",
    "nit_exportador", "razon_social_exportador", "razon_social_destinatario",
    "nit_declarante", "razon_social_declarante",
    "subpartida", "unidad_fisica", "forma_pago",
    "cod_modalidad_exportacion", "modalidad_exportacion",
    "tipo_declaracion", "tipo_despacho", "clase_exportador",
    "modo_transporte", "nacionalidad_bandera", "cod_moneda_transaccion",
    "cantidad_unidades_fisicas", "peso_bruto_kgs", "peso_neto_kgs",
    "valor_fob_usd", "valor_fob_pesos", "vlr_serie_agregado_nal_usd",
    "valor_serie_fletes_usd", "valor_serie_seguros_usd", "vlr_serie_otros_gastos_usd",
    "num_solicitud_auto_embarque", "numero_formulario",
]

_TEXT = T.StringType()
_QUANTITY = T.DecimalType(18, 4)
_RATE = T.DecimalType(18, 6)
_MONEY = T.DecimalType(18, 2)

CALENDAR = [
    ("fecha_declaracion", T.DateType()), ("anio", T.IntegerType()), ("trimestre", T.ShortType()),
    ("mes", T.ShortType()), ("nombre_mes", _TEXT), ("anio_mes", _TEXT),
]


def _all(kind: T.DataType, *names: str) -> list[tuple[str, T.DataType]]:
    return [(name, kind) for name in names]


def _duties(*duties: str) -> list[tuple[str, T.DataType]]:
    return [(f"{field}_{duty}", T.DecimalType(p, s)) for duty in duties for field, p, s in DUTY_FIELDS]


# Names, order and types of the import fact.
IMPORT_FACT = [
    *CALENDAR,
    *_all(_TEXT, "pais_origen", "pais_origen_nombre", "pais_procedencia", "pais_compra",
          "pais_exportador", "bandera_transporte"),
    *_all(_TEXT, "departamento_destino", "departamento_importador", "municipio",
          "aduana_presentada", "aduana_anterior", "aduana_exportacion"),
    *_all(_TEXT, "importador", "nit_importador", "exportador", "agente_aduanero",
          "empresa_transportadora"),
    *_all(_TEXT, "partida_arancelaria", "capitulo", "capitulo_nombre", "unidad_medida",
          "forma_pago", "banco", "regimen_aduanero", "tipo_declaracion", "clase_importador",
          "tipo_importacion", "modo_transporte", "embalaje", "acuerdo_comercial",
          "entidad_intermedia", "deposito", "actividad_economica", "moneda"),
    *_all(_QUANTITY, "peso_neto", "peso_bruto", "cantidad", "cantidad_subpartidas", "numero_bultos"),
    ("tasa_cambio", _RATE), ("num_cuotas_o_meses", T.IntegerType()),
    *_all(_MONEY, "valor_fob_usd", "valor_cif_usd", "valor_aduana_usd", "valor_ajuste_usd",
          "valor_fletes_usd", "valor_seguros_usd", "valor_otros_gastos_usd",
          "fletes_seguros1", "valor_cuota_usd"),
    *_duties("arancel", "iva"),
    ("porcentaje_otros1", T.DecimalType(9, 4)),
    *_all(_MONEY, "base_otros1", "subtotal_otros1", "valor_total_otros", "otros_pagados"),
    *_duties("sancion", "salvaguardia", "derechos_comp", "antidumping", "rescate"),
    *_all(_MONEY, "total_item1", "valor_total_arancel", "valor_total_iva", "total_liquidado",
          "pago_total", "valor_pagos_anteriores"),
    *_all(_TEXT, "numero_formulario", "num_aceptacion_declaracion", "numero_factura",
          "documento_transporte", "manifiesto_de_carga", "descripcion_mercancia", FILE),
]

# Names, order and types of the export fact.
EXPORT_FACT = [
    *CALENDAR,
    *_all(_TEXT, "pais_destino", "pais_destino_nombre", "region_origen", "region_procedencia",
          "ciudad_destinatario", "aduana_despacho", "aduana_salida", "exportador",
          "nit_exportador", "destinatario", "agente_aduanero", "partida_arancelaria",
          "capitulo", "capitulo_nombre", "unidad_medida", "forma_pago",
          "modalidad_exportacion", "tipo_declaracion", "tipo_despacho", "clase_exportador",
          "modo_transporte", "nacionalidad_bandera", "moneda"),
    *_all(_QUANTITY, "cantidad", "peso_bruto", "peso_neto"),
    *_all(_MONEY, "valor_fob_usd", "valor_fob_pesos", "valor_agregado_nacional_usd",
          "valor_fletes_usd", "valor_seguros_usd", "valor_otros_gastos_usd"),
    *_all(_TEXT, "num_solicitud_auto_embarque", "numero_formulario", FILE),
]


@dataclass(frozen=True)
class Flow:
    """One direction of trade and the fixed names that go with it."""

    name: str
    word: str
    staging: str
    fact: str
    source: tuple[str, ...]
    fact_columns: tuple[tuple[str, T.DataType], ...]
    country_column: str
    role: str
    exchange_type: str
    extract: str

    @property
    def fact_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.fact_columns])

    @property
    def stored_fact_schema(self) -> T.StructType:
        """The fact as stored: surrogate id first, load time last."""
        return T.StructType([
            T.StructField("id", T.LongType()), *self.fact_schema.fields,
            T.StructField("fecha_carga_dw", T.TimestampType()),
        ])


IMPORTS = Flow(
    "importaciones", "Importaciones", "temporal_impo", "importacion",
    tuple(IMPORT_SOURCE), tuple(IMPORT_FACT), "pais_origen", "origen",
    "IMPORTACION", "sp_extraer_importacion_por_archivo",
)
EXPORTS = Flow(
    "exportaciones", "Exportaciones", "temporal_expo", "exportacion",
    tuple(EXPORT_SOURCE), tuple(EXPORT_FACT), "pais_destino", "destino",
    "EXPORTACION", "sp_extraer_exportacion_por_archivo",
)
FLOWS = (IMPORTS, EXPORTS)


def project_contract(df: DataFrame, columns, keep=()) -> DataFrame:
    """Exactly ``columns`` as text, NULL where the input lacks one, then ``keep``."""
    present = {c.lower() for c in df.columns}
    picked = [
        f"CAST({f'`{c}`' if c in present else 'NULL'} AS STRING) AS `{c}`" for c in columns
    ]
    return df.selectExpr(*picked, *[f"`{c}`" for c in keep if c in present])


def union_schema(*frames: DataFrame) -> DataFrame:
    """All columns any frame has; a frame without one contributes NULLs."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
