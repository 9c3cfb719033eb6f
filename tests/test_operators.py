from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aforo.contracts import FILE, IMPORTS
from aforo.operators import lookup as lk
from aforo.operators import members as mb
from aforo.plans import control as ct
from aforo.plans import dimensions as dm
from aforo.plans import facts as fc
from checks.queries import checkpointed, countries
from checks.views import view


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_iso2(spark):
    df = spark.createDataFrame([(9, "HK", "a"), (4, "HK", "b"), (5, None, "c")], "Id_DimPais int, ISO2 string, Region string")
    assert [tuple(r) for r in lk.first_per_iso2(df).collect()] == [("HK", 4, "b")]


@pytest.fixture
def skewed(spark):
    """Two thirds of the rows share one key or have none."""
    n = 6000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500))
    left = spark.range(n).select("id", key.alias("k"), F.lit("b.zip").alias(FILE))
    right = spark.sql("SELECT concat('k', id) AS c, concat('name ', id) AS v, if(id % 2 = 0, 'a.zip', 'c.zip') AS f FROM range(400)")
    return left, right.union(spark.sql("SELECT 'hot', 'name hot', 'a.zip'"))


@pytest.mark.parametrize("since", [None, "f"])
def test_shuffle_lookup_equals_broadcast(skewed, since):
    left, right = skewed
    small = lk.lookup(left, right, {"k": "c"}, "v", "name", small=True, since=since)
    large = lk.lookup(left, right, {"k": "c"}, "v", "name", small=False, since=since)
    assert small.columns == large.columns and large.count() == left.count()
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_shuffle_lookup_two_keys(spark):
    left = spark.sql("SELECT id, if(id % 2 = 0, 'x', concat('k', id)) AS a, if(id % 5 = 0, NULL, concat('s', id % 3)) AS b, 'f' AS archivo_origen FROM range(300)")
    right = left.select("a", "b").dropna().distinct().withColumn("v", F.concat("a", "b"))
    small = lk.lookup(left, right, {"a": "a", "b": "b"}, "v", "name", small=True)
    large = lk.lookup(left, right, {"a": "a", "b": "b"}, "v", "name", small=False)
    assert small.exceptAll(large).isEmpty() and large.count() == 300


def test_size_bound():
    assert lk.Size(10, 10).small
    assert not lk.Size(lk.BROADCAST_ROWS + 1, 10).small
    assert not lk.Size(10, lk.BROADCAST_BYTES + 1).small


def test_facts_keep_rows_and_results_without_broadcast(spark, sf, monkeypatch):
    staged = view(spark, sf, "stg_impo")
    members = checkpointed(dm.candidate_members(staged, first_file_wins=True))
    usual = fc.fact_importacion(staged, fc.Dictionaries(members))
    plan = final_plan(usual)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan
    columns = ["numero_formulario", "importador", "exportador", "agente_aduanero"]
    large = ("DimImportador", "DimExportador", "DimAgenteAduanero")
    monkeypatch.setattr(fc.Dictionaries, "small", lambda self, dim: dim not in large)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = fc.fact_importacion(staged, fc.Dictionaries(members))
    # One scan for the rows; the spellings of countries were read before.
    plan = final_plan(shuffled)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("stg_impo") <= 2 and plan.count("SortMergeJoin") == 3
    shuffled, usual = shuffled.select(*columns), usual.select(*columns)
    assert shuffled.count() == staged.count()
    assert usual.exceptAll(shuffled).isEmpty()


def test_one_budget_for_all_broadcasts(monkeypatch):
    sizes = {"a": lk.Size(10, 100), "b": lk.Size(10, 300), "c": lk.Size(10, 500)}
    monkeypatch.setattr(lk, "BROADCAST_BYTES", 1000)
    assert lk.within_budget(sizes, {"a": 1, "b": 1, "c": 1}) == {"a", "b", "c"}
    assert lk.within_budget(sizes, {"a": 1, "b": 2, "c": 1}) == {"a", "c"}
    assert lk.within_budget(sizes, {"a": 1, "b": 2, "d": 5}) == {"a", "b", "d"}
    monkeypatch.setattr(lk, "BROADCAST_ROWS", 15)
    assert lk.within_budget(sizes, {"a": 1, "b": 1}) == {"a"}


@pytest.mark.parametrize("columns, joins, chapters", [(("anio", "capitulo", "valor_fob_usd"), 0, 0), (("capitulo_nombre",), 1, 1), (("banco", "anio"), 1, 0)])
def test_facts_look_up_what_they_need(spark, sf, columns, joins, chapters):
    staged = view(spark, sf, "stg_impo")
    members = None
    if "banco" in columns:
        members = fc.Dictionaries(spark.createDataFrame([("DimBanco", 1, "3", None, "BANCO", None, None, 31)], dm.MEMBER_SCHEMA))
    facts = fc.fact_importacion(staged, members, columns=columns)
    assert set(facts.columns) == set(columns) and final_plan(facts).count("BroadcastHashJoin") == joins
    with pytest.raises(ValueError, match="need dictionaries"):
        fc.fact_importacion(staged, None, columns=("banco",))
    with pytest.raises(ValueError, match="no columns x"):
        fc.fact_importacion(staged, None, columns=("x",))


@pytest.mark.parametrize("small", [True, False])
def test_collated_codes_meet(spark, small):
    rows = [("DimAduana", 1, "bogotá", None, "Uno", None, None, 31, "b"), ("DimAduana", 2, "BOGOTA", None, "Dos", None, None, 31, "a"),
            ("DimAduana", 3, "Cali", None, "Tres", None, None, 31, "a")]
    members = spark.createDataFrame(rows, f"{dm.MEMBER_SCHEMA}, {fc.SINCE} string")
    left = spark.createDataFrame([("Bogota", "z.zip"), ("cáli", "z.zip"), ("x", "z.zip"), (None, "z.zip"), ("BOGOTÁ", "0.zip")], f"k string, {FILE} string")
    known = fc.Dictionaries(members, collation="UNICODE_CI_AI")
    named = known.add_name(left, "DimAduana", "k", "name", small=small)
    assert "NestedLoop" not in final_plan(named) and "Cartesian" not in final_plan(named)
    got = {r.k: r.name for r in named.collect()}
    assert got == {"Bogota": "Dos", "cáli": "Tres", "x": None, None: None, "BOGOTÁ": None}


def test_fact_schema(spark, sf):
    staged = view(spark, sf, "stg_impo").limit(0)
    members = spark.createDataFrame([], dm.MEMBER_SCHEMA)
    facts = fc.fact_importacion(staged, fc.Dictionaries(members))
    assert [(f.name, f.dataType) for f in facts.schema] == list(IMPORTS.fact_columns)


def test_scan_is_pruned_by_file_and_column(spark, sf):
    staged = view(spark, sf, "stg_impo")
    plan = final_plan(staged.filter(F.col(FILE) == "03_Importaciones_1997_Marzo.zip").select("nit_importador"))
    assert "PartitionFilters: [isnotnull(archivo_origen" in plan
    assert "ReadSchema: struct<nit_importador:string>" in plan


def test_first_file_wins_equals_file_after_file(spark, sf):
    staged = view(spark, sf, "stg_impo")
    files = sorted(r[0] for r in staged.select(FILE).distinct().collect())
    third = len(files) // 3
    parts = [files[:third], files[third:2 * third], files[2 * third:]]
    stored = spark.createDataFrame([], dm.MEMBER_SCHEMA)
    for part in parts:
        asked = dm.candidate_members(staged.filter(F.col(FILE).isin(part)), first_file_wins=True)
        stored = stored.unionByName(dm.new_members(asked.drop(fc.SINCE), stored)).checkpoint()
    once = dm.candidate_members(staged, first_file_wins=True).drop(fc.SINCE)
    assert stored.drop("id").exceptAll(once.select(*stored.drop("id").columns)).isEmpty()
    assert stored.count() == once.count()
    assert stored.groupBy("dim", "id").count().filter("count > 1").isEmpty()


def test_members_of_exports_ignore_missing_columns(spark, sf):
    found = dm.candidate_members(view(spark, sf, "stg_expo"))
    assert {r[0] for r in found.select("dim").distinct().collect()} == {"DimAgenteAduanero"}


def test_collation_joins_spellings(spark):
    staged = spark.createDataFrame([("ÁB",), ("ab",), ("c",)], "codigo_deposito string")
    asked = dm.candidate_members(staged, ["DimDeposito"], collation="UNICODE_CI_AI")
    assert asked.count() == 2
    kept = mb.insert_ignore(asked, dm.candidate_members(staged.limit(1), ["DimDeposito"]), collation="UNICODE_CI_AI")
    assert [r[0] for r in kept.select("codigo").collect()] == ["c"]


def test_geography_keeps_rows(spark, sf):
    facts = spark.sql("SELECT id, element_at(array('us', 'HK', 'DE', NULL), cast(id % 4 + 1 AS int)) AS pais FROM range(40)")
    rich = lk.geo_enrich(facts, countries(spark, sf), "pais", "origen")
    assert rich.count() == 40 and "BroadcastHashJoin" in final_plan(rich)


def events(spark, *rows):
    full = [("t", "f.zip", "HECHOS", s, n, datetime(2024, 1, 1, 0, n), r, None, m) for n, (s, r, m) in enumerate(rows)]
    return spark.createDataFrame(full, ct.EVENT_SCHEMA)


def test_control_rules(spark):
    early = ct.control_state(events(spark, ("SUCCESS", 5, None)))
    assert early.isEmpty()
    state = ct.control_state(events(spark, ("EN_PROCESO", None, None), ("SUCCESS", 7, None), ("EN_PROCESO", None, None))).first()
    assert (state.estado, state.registros_procesados, state.fecha_fin) == ("EN_PROCESO", 7, None)
    state = ct.control_state(events(spark, ("EN_PROCESO", None, None), ("ERROR", None, "x" * 70_000))).first()
    assert state.estado == "ERROR" and len(state.mensaje_error) == 60_000


def test_minimum_sorts_only_distinct_rows(spark, sf):
    plan = final_plan(dm.candidate_members(view(spark, sf, "stg_impo")))
    assert plan.count("HashAggregate") >= 2 and plan.count("Exchange hashpartitioning") == 2


def test_the_log_is_folded_by_hashes(spark, sf):
    from aforo.sources.periods import ledger_latest
    from checks.queries import events as log
    assert "SortAggregate" not in final_plan(ct.control_state(log(spark, sf)))
    assert "SortAggregate" not in final_plan(ledger_latest(log(spark, sf).select(FILE, "seq", "estado", "registros"), FILE, "seq"))


def test_extracts_read_one_partition_of_the_stored_fact(spark, sf):
    from aforo.plans import extracts as ex
    from checks.queries import loaded
    wh = loaded(spark, sf)
    wh.facts(IMPORTS).createOrReplaceTempView("facts_of_test")
    countries(spark, sf).createOrReplaceTempView("countries_of_test")
    name = ex.register_extract(spark, IMPORTS, "facts_of_test", "countries_of_test")
    rows = spark.sql(f"SELECT * FROM {name}('07_Importaciones_1998_Julio.zip')")
    assert {"id", "fecha_carga_dw", "region_origen", *IMPORTS.fact_schema.names} == set(rows.columns) - {
        "continente_origen", "subcontinente_origen", "bloque_economico_origen"}
    plan = final_plan(rows)
    assert "PartitionFilters: [isnotnull(archivo_origen" in plan and "07_Importaciones_1998_Julio.zip" in plan


def test_documents_have_the_types_of_the_mapping(spark):
    from aforo.plans import extracts as ex
    facts = spark.createDataFrame([], IMPORTS.stored_fact_schema)
    kinds = {f.name: f.dataType.simpleString() for f in ex.search_documents(facts).schema}
    assert kinds.pop("indice") == "string" and FILE not in kinds and len(kinds) == 103
    assert {k: v for k, v in kinds.items() if v not in ("string", "double")} == {
        "id": "int", "fecha_declaracion": "date", "fecha_carga_dw": "date", "anio": "smallint", "num_cuotas_o_meses": "smallint",
        "trimestre": "tinyint", "mes": "tinyint"}
    assert list(kinds.values()).count("double") == 54 and list(kinds.values()).count("string") == 42
