"""Dimension population rules and the member table.

All dimensions live in one long table, stored by dimension:
``dim, id, codigo, subcodigo, nombre, direccion, telefono, cod_dim_pais``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.catalogs import COLOMBIA, SEED_CODE, SEED_COUNTRY, SEED_NAME
from aforo.contracts import FILE, project_contract
from aforo.functions import clean_text, coalesce_drift, hs_levels, surrogate_natural_key, upper_text
from aforo.operators.members import (
    ATTRIBUTES,
    assign_member_ids,
    first_file_attrs_by_key,
    insert_ignore,
    min_attrs_by_key,
    one_spelling,
    union_roles,
)

MEMBER_SCHEMA = (
    "dim string, id long, codigo string, subcodigo string, nombre string, "
    "direccion string, telefono string, cod_dim_pais int"
)


@dataclass(frozen=True)
class Role:
    """One use of a dimension in a staging row. Tuples list renamed columns."""

    code: tuple[str, ...]
    name: tuple[str, ...] = ()
    subcode: str | None = None
    address: str | None = None
    phone: str | None = None

    def columns(self) -> list[str]:
        extra = [c for c in (self.subcode, self.address, self.phone) if c]
        return [*self.code, *self.name, *extra]

    def key(self) -> Column:
        return coalesce_drift(*self.code)

    def member(self) -> dict[str, Column]:
        null = F.lit(None).cast("string")
        code, subcode = self.key(), null
        if self.subcode:
            subcode = clean_text(self.subcode)
            code = F.when(subcode.isNotNull(), code)
        return {
            "codigo": code,
            "subcodigo": subcode,
            "nombre": coalesce_drift(*self.name) if self.name else null,
            "direccion": F.col(self.address) if self.address else null,
            "telefono": F.col(self.phone) if self.phone else null,
        }


class NameRole(Role):
    """The upper-case name is the key."""

    def key(self) -> Column:
        return upper_text(self.code[0])


class ForeignPartyRole(Role):
    """Tax id, else a key from the name; a row without a name gives no member."""

    def key(self) -> Column:
        (name,) = self.name
        return F.when(clean_text(name).isNotNull(), surrogate_natural_key(self.code[0], name))


@dataclass(frozen=True)
class Rule:
    dim: str
    roles: tuple[Role, ...]
    seeded: bool = True
    name_required: bool = False


def _rule(dim: str, code: str, name: str | None = None, **kw) -> Rule:
    return Rule(dim, (Role((code,), (name,) if name else ()),), **kw)


RULES = {
    rule.dim: rule
    for rule in (
        Rule("DimDepartamento", (
            Role(("cod_departamento_destino",), ("departamento_destino",)),
            Role(("codigo_depto_importador",), ("departamento_importador",)),
        ), name_required=True),
        _rule("DimMunicipio", "codigo_municipio"),
        Rule("DimEmpresaTransportadora", (NameRole(("empresa_transportadora",)),)),
        _rule("DimBanco", "banc_codigo_banco"),
        _rule("DimFormaPago", "cod_forma_pago", "forma_pago"),
        _rule("DimTipoDeclaracion", "cod_tipo_declaracion", "tipo_declaracion"),
        _rule("DimClaseImportador", "cod_clase_importador", "clase_importador"),
        _rule("DimTipoImportacion", "cod_tipo_importacion", "tipo_importacion"),
        _rule("DimEmbalaje", "codigo_embalaje", "clase_de_embalaje"),
        _rule("DimEntidadIntermedia", "codigo_entidad_intermedia"),
        _rule("DimDeposito", "codigo_deposito"),
        _rule("DimActividadEconomica", "actividad_economica_sec"),
        Rule("DimModalidad", (Role(("moda_codigo_modalidad",), subcode="cod_modalidad_importacion"),)),
        Rule("DimAduana", (
            Role(("cod_aduana_presentada",), ("aduana_presentada",)),
            Role(("cod_administracion_presentada_1",), ("nombre_aduana_1",)),
            Role(("cod_aduana_anterior",)),
            Role(("cod_aduana_export",)),
            Role(("cod_lugar_ingreso_mcia",), ("lugar_ingreso_mcia",)),
        ), seeded=False),
        Rule("DimImportador", (
            Role(("nit_importador",), ("nombre_importador",),
                 address="direccion_importador", phone="telefono_importador"),
        ), seeded=False),
        Rule("DimExportador", (
            ForeignPartyRole(("numero_identificac_export",), ("nombre_exportador",),
                             address="direccion_exportador"),
        ), seeded=False),
        Rule("DimAgenteAduanero", (
            Role(("nit_declarante", "docto_identif_declar"),
                 ("nombre_declarante", "razon_social_declarante")),
        ), seeded=False),
        _rule("DimPartidas", "subpartida_arancelaria", seeded=False),
    )
}
RULE_KEY = ["dim", "codigo", "subcodigo"]


def candidate_members(
    staged: DataFrame,
    dims: list[str] | None = None,
    *,
    country: int = COLOMBIA,
    first_file_wins: bool = False,
    collation: str | None = None,
) -> DataFrame:
    """Members that staged rows ask for, by all chosen rules in one scan.

    ``first_file_wins`` gives the result of loading file after file (and adds
    ``desde_archivo``); otherwise the minimum over all rows is taken.
    """
    rules = [RULES[d] for d in dims or RULES]
    roles, columns = [], {}
    for rule in rules:
        for role in rule.roles:
            if not any(c in staged.columns for c in role.code):
                # Only a party keyed by its name can do without its code column.
                if not (isinstance(role, ForeignPartyRole) and role.name[0] in staged.columns):
                    continue
            columns.update(dict.fromkeys(role.columns()))
            fields = {"dim": F.lit(rule.dim), **role.member()}
            roles.append(F.struct(*[c.alias(n) for n, c in fields.items()]))
    if not roles:
        attrs = ", ".join(f"{a} string" for a in ATTRIBUTES)
        first = "desde_archivo string, " if first_file_wins else ""
        return staged.sparkSession.createDataFrame(
            [], f"dim string, codigo string, subcodigo string, {first}{attrs}, cod_dim_pais int"
        )
    source = project_contract(staged, columns, keep=[FILE] if FILE in staged.columns else [])
    keep = [FILE] if FILE in source.columns and first_file_wins else []
    long = union_roles(source, roles, keep)
    reduce_rows = first_file_attrs_by_key if first_file_wins else min_attrs_by_key
    members = reduce_rows(long, RULE_KEY, ATTRIBUTES)
    named = [rule.dim for rule in rules if rule.name_required]
    if named:
        members = members.withColumn(
            "nombre", F.when(F.col("dim").isin(named), F.coalesce("nombre", F.lit(""))).otherwise(F.col("nombre"))
        )
    members = members.withColumn("cod_dim_pais", F.lit(country))
    return one_spelling(members, collation) if collation else members


def seed_members(spark: SparkSession) -> DataFrame:
    """The catch-all member, id 1, of every dimension that has one."""
    rows = []
    for rule in RULES.values():
        if rule.seeded:
            by_name = isinstance(rule.roles[0], NameRole)
            rows.append((
                rule.dim, 1, SEED_NAME if by_name else SEED_CODE,
                SEED_CODE if rule.roles[0].subcode else None,
                None if by_name else SEED_NAME, None, None, SEED_COUNTRY,
            ))
    return spark.createDataFrame(rows, MEMBER_SCHEMA)


def new_members(candidates: DataFrame, stored: DataFrame, collation: str | None = None) -> DataFrame:
    """Candidates not stored yet, with the next ids of their dimension."""
    fresh = insert_ignore(candidates, stored, collation=collation)
    last = stored.groupBy("dim").agg(F.max("id").alias("last_id"))
    return assign_member_ids(fresh, last)


def dimension(members: DataFrame, dim: str) -> DataFrame:
    """One dimension under its own column names."""
    m = members.filter(F.col("dim") == dim)
    key = F.col("codigo")
    if dim == "DimEmpresaTransportadora":
        columns = [key.alias("nombre")]
    elif dim == "DimModalidad":
        columns = [key.alias("codigo_modalidad"), F.col("subcodigo").alias("codigo_sub_modalidad"), F.col("nombre")]
    elif dim in ("DimImportador", "DimExportador", "DimAgenteAduanero"):
        attrs = {"DimImportador": ["direccion", "telefono"], "DimExportador": ["direccion"]}.get(dim, [])
        columns = [key.alias("nit"), F.col("nombre"), *[F.col(a) for a in attrs]]
    elif dim == "DimPartidas":
        columns = [key.alias("hs10"), *[c.alias(n) for n, c in hs_levels(key).items()]]
    else:
        columns = [key, F.col("nombre")]
    ids = [F.col("id")] if "id" in m.columns else []
    return m.select(*ids, *columns, "cod_dim_pais")
