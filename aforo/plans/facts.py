"""Typed, flat fact tables built from text staging by dictionary lookups."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.catalogs import COLOMBIA, chapter_catalog, country_catalog
from aforo.contracts import EXPORTS, FILE, IMPORTS, Flow, project_contract
from aforo.functions import (
    calendar_fields,
    clean_text,
    coalesce_drift,
    default_currency,
    first_valid_date,
    hs_chapter,
    parse_decimal,
    parse_int,
    regime_code,
    resolve_or_fallback,
    surrogate_natural_key,
    upper_text,
)
from aforo.operators.lookup import Size, country_lookup, lookup, measure, measure_by, within_budget
from aforo.session import shared_dir

SINCE = "desde_archivo"


class Dictionaries:
    """Named members of every dimension, with their measured sizes.

    ``members`` must be stored or checkpointed, since each lookup reads it. A
    member without a name cannot change a fact, so it is left out. ``SINCE``,
    where present, is the first file that knew the member. With ``collation``
    (for example ``UNICODE_CI_AI``) codes meet whatever their case and accents;
    of spellings that it holds equal the one known first counts.
    """

    def __init__(self, members: DataFrame, country: int = COLOMBIA, collation: str | None = None):
        named = members.filter((F.col("cod_dim_pais") == country) & (F.col("nombre") != ""))
        self.since = SINCE if SINCE in members.columns else None
        self.collation = collation
        columns = ["dim", "codigo", "subcodigo", "nombre"] + ([SINCE] if self.since else [])
        self.members = named.select(*columns)
        if collation:
            known = [F.col(SINCE)] if self.since else []
            alike = [F.collate(c, collation).alias(f"_{c}") for c in ("codigo", "subcodigo")]
            first = F.min(F.struct(*known, "codigo", "subcodigo", "nombre")).alias("row")
            shared_dir(members.sparkSession)
            self.members = self.members.groupBy("dim", *alike).agg(first).select("dim", "row.*").select(*columns).checkpoint()
        self.sizes = measure_by(self.members, "dim")

    def small(self, dim: str) -> bool:
        return self.sizes.get(dim, Size(0, 0)).small

    def broadcast_for(self, uses: dict[str, int]) -> set[str]:
        """The dimensions that lookups, so many of each, may broadcast together."""
        return {dim for dim in within_budget(self.sizes, uses) if self.small(dim)}

    def add_name(
        self, df: DataFrame, dim: str, key: str, as_: str, subkey: str | None = None, small: bool | None = None
    ) -> DataFrame:
        if dim not in self.sizes:
            return df.withColumn(as_, F.lit(None).cast("string"))
        keys = {key: "codigo", **({subkey: "subcodigo"} if subkey else {})}
        entries = self.members.filter(F.col("dim") == dim)
        small = self.small(dim) if small is None else small
        return lookup(df, entries, keys, "nombre", as_, small=small, since=self.since, collation=self.collation)


@dataclass(frozen=True)
class Resolved:
    """A fact column whose value is a dimension name, else raw text, else code."""

    target: str
    dim: str
    code: Column
    raw: Column | None = None


def _resolved(target, dim, code, raw=None) -> Resolved:
    return Resolved(target, dim, clean_text(code), clean_text(raw) if raw else None)


def _import_lookups() -> list[Resolved]:
    return [
        _resolved("departamento_destino", "DimDepartamento", "cod_departamento_destino", "departamento_destino"),
        _resolved("departamento_importador", "DimDepartamento", "codigo_depto_importador", "departamento_importador"),
        _resolved("municipio", "DimMunicipio", "codigo_municipio"),
        Resolved(
            "aduana_presentada", "DimAduana",
            coalesce_drift("cod_aduana_presentada", "cod_administracion_presentada_1"),
            coalesce_drift("aduana_presentada", "nombre_aduana_1"),
        ),
        _resolved("aduana_anterior", "DimAduana", "cod_aduana_anterior"),
        _resolved("aduana_exportacion", "DimAduana", "cod_aduana_export"),
        _resolved("importador", "DimImportador", "nit_importador", "nombre_importador"),
        Resolved(
            "exportador", "DimExportador",
            surrogate_natural_key("numero_identificac_export", "nombre_exportador"),
            clean_text("nombre_exportador"),
        ),
        Resolved(
            "agente_aduanero", "DimAgenteAduanero",
            coalesce_drift("nit_declarante", "docto_identif_declar"),
            coalesce_drift("nombre_declarante", "razon_social_declarante"),
        ),
        _resolved("forma_pago", "DimFormaPago", "cod_forma_pago", "forma_pago"),
        _resolved("banco", "DimBanco", "banc_codigo_banco"),
        _resolved("tipo_declaracion", "DimTipoDeclaracion", "cod_tipo_declaracion", "tipo_declaracion"),
        _resolved("clase_importador", "DimClaseImportador", "cod_clase_importador", "clase_importador"),
        _resolved("tipo_importacion", "DimTipoImportacion", "cod_tipo_importacion", "tipo_importacion"),
        _resolved("embalaje", "DimEmbalaje", "codigo_embalaje", "clase_de_embalaje"),
        _resolved("entidad_intermedia", "DimEntidadIntermedia", "codigo_entidad_intermedia"),
        _resolved("deposito", "DimDeposito", "codigo_deposito"),
        _resolved("actividad_economica", "DimActividadEconomica", "actividad_economica_sec"),
    ]


def _export_lookups() -> list[Resolved]:
    return [
        _resolved("aduana_despacho", "DimAduana", "cod_aduana_despacho", "aduana_despacho"),
        _resolved("aduana_salida", "DimAduana", "cod_aduana_salida", "aduana_salida"),
        _resolved("exportador", "DimExportador", "nit_exportador", "razon_social_exportador"),
        _resolved("agente_aduanero", "DimAgenteAduanero", "nit_declarante", "razon_social_declarante"),
        _resolved("forma_pago", "DimFormaPago", "forma_pago"),
        _resolved("tipo_declaracion", "DimTipoDeclaracion", "tipo_declaracion"),
    ]


# Fact columns that only change name on the way from staging.
IMPORT_RENAMED = {
    "partida_arancelaria": "subpartida_arancelaria",
    "unidad_medida": "unidad_comercial",
    "acuerdo_comercial": "codigo_acuerdo",
}
EXPORT_RENAMED = {
    "region_origen": "region_de_origen",
    "destinatario": "razon_social_destinatario",
    "partida_arancelaria": "subpartida",
    "unidad_medida": "unidad_fisica",
    "cantidad": "cantidad_unidades_fisicas",
    "peso_bruto": "peso_bruto_kgs",
    "peso_neto": "peso_neto_kgs",
    "valor_agregado_nacional_usd": "vlr_serie_agregado_nal_usd",
    "valor_fletes_usd": "valor_serie_fletes_usd",
    "valor_seguros_usd": "valor_serie_seguros_usd",
    "valor_otros_gastos_usd": "vlr_serie_otros_gastos_usd",
}


def declaration_date(flow: Flow) -> Column:
    sources = {
        IMPORTS: ("fecha_aceptacion_declaracion", "fecha_presentacion", "fecha_manifiesto"),
        EXPORTS: ("fecha_declaracion_exportacion", "fech_decla_exportacion_ant", "fech_decla_precedente",
                  "fecha_solicitud_auto_embarque", "fecha_proceso"),
    }
    return first_valid_date(*sources[flow])


def country_name(flow: Flow) -> Column:
    if flow is IMPORTS:
        return clean_text("pais_origen")
    return coalesce_drift("pais_destino_final", "cod_pais_destino_alf", "cod_pais_destino")


def _typed(source: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        return parse_decimal(source, kind.precision, kind.scale)
    if isinstance(kind, T.IntegerType):
        return parse_int(source)
    return clean_text(source)


def add_country(df: DataFrame, name: Column, as_: str, catalog: DataFrame | None = None) -> DataFrame:
    """Add the ISO2 code of a country name; each distinct spelling is folded once."""
    spark = df.sparkSession
    shared_dir(spark)
    catalog = catalog or country_catalog(spark)
    named = df.withColumn("_country", name)
    spellings = country_lookup(named, F.col("_country"), catalog).checkpoint()
    return lookup(
        named, spellings, {"_country": "nombre"}, "iso2", as_, small=measure(spellings).small
    ).drop("_country")


def add_chapter(df: DataFrame, code: Column) -> DataFrame:
    chapters = chapter_catalog(df.sparkSession).withColumnRenamed("capitulo", "_chapter")
    return (
        df.withColumn("capitulo", hs_chapter(code))
        .join(F.broadcast(chapters), F.col("capitulo") == F.col("_chapter"), "left")
        .drop("_chapter")
    )


REGIME = "regimen_aduanero"
DONE = "_done"
#: So many lookups make one generated method; with all of them it is too large for the JVM to compile.
TOGETHER = 4


def build_fact(
    staged: DataFrame, dictionaries: Dictionaries | None, flow: Flow,
    catalog: DataFrame | None = None, keep: tuple[str, ...] = (), columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """One typed fact row per staging row of one flow.

    With ``columns`` only these are built, and only the dictionaries and
    catalogues that they need are looked up.
    """
    wanted = [(n, t) for n, t in flow.fact_columns if columns is None or n in columns]
    names = {n for n, _ in wanted}
    unknown = sorted(set(columns or ()) - names)
    if unknown:
        raise ValueError(f"{flow.fact} has no columns {', '.join(unknown)}")
    lookups = [i for i in (_import_lookups() if flow is IMPORTS else _export_lookups()) if i.target in names]
    regime = flow is IMPORTS and REGIME in names
    uses = Counter(i.dim for i in lookups) + Counter(["DimModalidad"] * regime)
    if uses and dictionaries is None:
        raise ValueError("these columns need dictionaries")
    small = dictionaries.broadcast_for(uses) if uses else set()
    renamed = IMPORT_RENAMED if flow is IMPORTS else EXPORT_RENAMED
    df = project_contract(staged, flow.source, keep=(FILE, *keep))
    df = df.select(
        "*",
        declaration_date(flow).alias("_date"),
        country_name(flow).alias("_country_name"),
        *[item.code.alias(f"_code_{item.target}") for item in lookups],
    )
    code = clean_text(renamed["partida_arancelaria"])
    chapter = {"capitulo", "capitulo_nombre"} & names

    values: dict[str, Column] = {"fecha_declaracion": F.col("_date"), **calendar_fields("_date")}
    values |= {f"{flow.country_column}_nombre": F.col("_country_name"), "capitulo": F.col("capitulo")}
    if flow is IMPORTS:
        values |= {"empresa_transportadora": upper_text("empresa_transportadora"), "moneda": default_currency()}
    else:
        values |= {
            "modalidad_exportacion": coalesce_drift("modalidad_exportacion", "cod_modalidad_exportacion"),
            "moneda": default_currency("cod_moneda_transaccion"),
        }
    looked_up = {flow.country_column, "capitulo_nombre", FILE, *(item.target for item in lookups), *([REGIME] if regime else [])}
    present = {c.lower() for c in staged.columns}
    copied = {n: (renamed.get(n, n), t) for n, t in wanted if n not in values and n not in looked_up}
    if chapter:
        df = df.withColumn("capitulo", hs_chapter(code))
    parsed, arrays = _parsed(copied, present)
    # A step with arrays parsed is not fused with its neighbours into one method that is too large to be compiled,
    # so either of the two steps with many expressions has some.
    early, late = dict(list(arrays.items())[::2]), dict(list(arrays.items())[1::2])
    df = df.select("*", *[a.alias(n) for n, a in early.items()])
    # A column that is not staged is NULL; it is added last and passes no lookup.
    absent = {n for n, (source, _) in copied.items() if source.lower() not in present}
    # What no lookup changes goes through the lookups in a few values, and so do codes and
    # texts. Each lookup copies its row, and column by column a hundred of them cost far more.
    done = [values[n].cast(t).alias(n) for n, t in wanted if n in values and n not in looked_up]
    groups = [lookups[at:at + TOGETHER] for at in range(0, len(lookups), TOGETHER)]
    df = df.select(
        FILE, *keep, *([F.struct(*done).alias(DONE)] if done else []), *early, *[a.alias(n) for n, a in late.items()],
        *(["_country_name"] if flow.country_column in names else []),
        *(["capitulo"] if "capitulo_nombre" in names else []),
        *[F.array(*[F.col(f"_code_{item.target}") for item in g]).alias(f"_codes_{k}") for k, g in enumerate(groups)],
        *[F.array(*[F.coalesce(*([] if item.raw is None else [item.raw]), f"_code_{item.target}") for item in g]).alias(f"_else_{k}")
          for k, g in enumerate(groups)],
        *([clean_text("moda_codigo_modalidad").alias("_regime"),
           clean_text("cod_modalidad_importacion").alias("_subregime")] if regime else []),
    )
    found: dict[str, Column] = {FILE: F.col(FILE), **parsed}
    if flow.country_column in names:
        df = add_country(df, F.col("_country_name"), "_iso2", catalog)
        found[flow.country_column] = F.col("_iso2")
    if "capitulo_nombre" in names:
        df = add_chapter(df, F.col("capitulo"))
        found["capitulo_nombre"] = F.col("capitulo_nombre")
    for k, group in enumerate(groups):
        for at, item in enumerate(group):
            df = df.withColumn("_code", F.get(f"_codes_{k}", F.lit(at)))
            df = dictionaries.add_name(df, item.dim, "_code", f"_name_{item.target}", small=item.dim in small).drop("_code")
            found[item.target] = F.get(f"_found_{k}", F.lit(at))
        names = [f"_name_{item.target}" for item in group]
        resolved = F.zip_with(F.array(*names), f"_else_{k}", lambda name, other: resolve_or_fallback(name, None, other))
        df = df.withColumn(f"_found_{k}", resolved).drop(f"_codes_{k}", f"_else_{k}", *names)
    if regime:
        df = dictionaries.add_name(df, "DimModalidad", "_regime", "_regime_name", subkey="_subregime", small="DimModalidad" in small)
        found[REGIME] = regime_code("_regime", "_subregime", "_regime_name")
    return df.select(*[
        (found[name].cast(kind) if name in found else F.col(f"{DONE}.{name}")).alias(name) for name, kind in wanted
    ], *keep)


def _each(kind: T.DataType) -> Callable[[Column], Column]:
    return lambda c: _typed(c, kind)


def _parsed(copied: dict[str, tuple[str, T.DataType]], present: set[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """Columns that are cleaned or parsed copies of a staged one, and the arrays that they are elements of.

    All of one type are parsed by one expression over an array: written out
    one by one, the columns of a full contract make a method that is too large
    to be compiled. A column that is not staged is NULL.
    """
    columns, groups = {}, {}
    for name, (source, kind) in copied.items():
        if source.lower() in present:
            groups.setdefault(kind.simpleString(), (kind, []))[1].append((name, source))
        else:
            columns[name] = F.lit(None).cast(kind)
    arrays = {}
    for k, (kind, members) in enumerate(groups.values()):
        arrays[f"_typed_{k}"] = F.transform(F.array(*[F.col(s) for _, s in members]), _each(kind))
        columns |= {name: F.get(f"_typed_{k}", F.lit(i)) for i, (name, _) in enumerate(members)}
    return columns, arrays


def fact_importacion(staged: DataFrame, dictionaries: Dictionaries | None, **kw) -> DataFrame:
    return build_fact(staged, dictionaries, IMPORTS, **kw)


def fact_exportacion(staged: DataFrame, dictionaries: Dictionaries | None, **kw) -> DataFrame:
    return build_fact(staged, dictionaries, EXPORTS, **kw)


def view_fact_alias(spark: SparkSession, facts: DataFrame, name: str = "vw_importaciones") -> DataFrame:
    """A stable view name over the import fact."""
    facts.createOrReplaceTempView(name)
    return spark.table(name)
