"""Archives to staging to warehouse, in batch and as streams."""

import zipfile

import pytest
from pyspark.sql import functions as F

from aforo.contracts import EXPORTS, FILE, IMPORTS
from aforo.plans import load as ld
from aforo.session import work_dir
from aforo.sinks import tables as tb
from aforo.sources import archives as ar
from aforo.streaming import intake
from checks.archives import workbook_bytes
from checks.views import view


def zip_of(folder, name, **members):
    with zipfile.ZipFile(folder / name, "w") as archive:
        for member, data in members.items():
            archive.writestr(member.replace("__", "."), data)


@pytest.fixture
def folder(tmp_path):
    text = "Nit Importador;País Origen;Subpartida Arancelaria\n1; Japón ;0101210000\n2;NA;\nbad;line;with;more\n\n3;NULL;77\n"
    zip_of(tmp_path, "01_Importaciones_2018_Enero.zip", datos__csv=text.encode("latin1"))
    zip_of(tmp_path, "02_Importaciones_2018_Febrero.zip", datos__txt="nit_importador|extra\n4|x\n".encode("utf-8-sig"))
    zip_of(tmp_path, "03_Importaciones_2018_Marzo.zip",
           datos__xlsx=workbook_bytes(["Nit Importador", "Valor"], [["5", "1.5"], [None, ""], ["6"]]))
    zip_of(tmp_path, "04_Importaciones_2018_Abril.zip", leeme__pdf="x")
    (tmp_path / "05_Importaciones_2018_Mayo.zip").write_bytes(b"not a zip")
    zip_of(tmp_path, "06_Importaciones_2018_Junio.zip", datos__xlsx="broken")
    return tmp_path


def test_manifest(spark, folder):
    found = {r[FILE][:2]: r.is_valid for r in ar.archive_manifest(ar.list_archives(spark, str(folder))).collect()}
    assert found == {"01": True, "02": True, "03": True, "04": True, "05": False, "06": True}


def test_inspection(spark, folder):
    seen = {r[FILE][:2]: r for r in ar.inspect_archives(ar.list_archives(spark, str(folder))).collect()}
    assert (seen["01"].separador, seen["01"].codificacion) == (";", "latin1")
    assert (seen["02"].separador, seen["02"].codificacion) == ("|", "utf-8-sig")
    assert seen["01"].columnas == ["nit_importador", "pais_origen", "subpartida_arancelaria"]
    assert seen["03"].tipo == "xlsx" and all(seen[k].error for k in ("04", "05", "06"))


def test_scan(spark, folder):
    rows = ar.scan_archives(spark, str(folder)).orderBy("nit_importador").collect()
    got = [(r.nit_importador, r.pais_origen, r.subpartida_arancelaria, r.extra, r.valor) for r in rows]
    assert got == [
        ("1", " Japón ", "0101210000", None, None), ("2", "NA", None, None, None), ("3", None, "77", None, None),
        ("4", None, None, "x", None), ("5", None, None, None, "1.5"), ("6", None, None, None, None),
    ]


@pytest.mark.parametrize("encoding, expected", [("utf-8", "utf-8-sig"), ("latin1", "latin1")])
def test_a_late_character_decides_the_encoding(spark, tmp_path, encoding, expected):
    text = "pais;n\n" + "Chile;1\n" * 200_000 + "Japón;2\n"
    zip_of(tmp_path, "a.zip", datos__csv=text.encode(encoding))
    archives = ar.list_archives(spark, str(tmp_path))
    seen = ar.inspect_archives(archives).first()
    assert (seen.separador, seen.codificacion, seen.filas) == (";", expected, 200_001)
    assert [r.pais for r in ar.scan_archives(spark, str(tmp_path)).where("n = '2'").collect()] == ["Japón"]


@pytest.mark.parametrize("separator", list(ar.DELIMITERS))
def test_records_are_parted_as_written(spark, tmp_path, separator):
    """Quotes, doubled quotes, line breaks and separators inside them, short, long and blank lines."""
    import csv
    import io

    rows = [["1", 'say "hi"', "a\nb"], ["2", f"x{separator}y", ""], ["3", "12\" pipe", "\t"], ["4", "NA", "null"], ["5", "\x1f", "é"]]
    out = io.StringIO()
    writer = csv.writer(out, delimiter=separator, lineterminator="\r\n")
    writer.writerows([["N", "Texto", "Más"], *rows])
    lines = out.getvalue() + "\r\n  \r\n" + separator.join(["6", 'in "the" middle']) + "\r\n" + separator.join("7abc") + "\r\n"
    zip_of(tmp_path, "a.zip", datos__csv=lines.encode())
    seen = ar.inspect_archives(ar.list_archives(spark, str(tmp_path))).first()
    assert (seen.separador, seen.columnas, seen.filas, seen.lineas_largas, seen.error) == (separator, ["n", "texto", "mas"], 6, 1, None)
    got = sorted(tuple(r) for r in ar.scan_archives(spark, str(tmp_path)).select("n", "texto", "mas").collect())
    want = [tuple(None if c in ar.MISSING else c for c in r) for r in rows] + [("6", 'in "the" middle', None)]
    assert got == want


def test_a_separator_that_the_header_lacks_is_not_believed():
    assert ar.guess_separator("a;b\n1,5;2,5\n3,5;4,5\n") == ";"
    assert ar.guess_separator("just one\nvalue\n") == ","


def test_an_open_quote_and_an_empty_member_are_errors(spark, tmp_path):
    zip_of(tmp_path, "a.zip", datos__csv='a;b\n1;"x\n2;y\n')
    zip_of(tmp_path, "b.zip", datos__csv="")
    zip_of(tmp_path, "c.zip", datos__csv="a;b\n")
    seen = {r[FILE]: r for r in ar.inspect_archives(ar.list_archives(spark, str(tmp_path))).collect()}
    assert "never closed" in seen["a.zip"].error and "empty" in seen["b.zip"].error
    assert seen["c.zip"].error is None and seen["c.zip"].filas == 0


def test_one_large_member_is_read_by_several_tasks(spark, tmp_path):
    zip_of(tmp_path, "a.zip", datos__csv="n;x\n" + "".join(f"{k};{'y' * 50}\n" for k in range(200_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        rows = ar.scan_archives(spark, str(tmp_path))
        tasks = rows.select(F.spark_partition_id().alias("p"), "n").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(tasks) > 4 and sum(r["count"] for r in tasks) == 200_000


def test_failures_count_the_lines_left_out_and_columns_are_recorded(spark, folder):
    wh = ld.Warehouse(spark, work_dir(spark, "test-wh"))
    staging, failures = wh.path("temporal_impo"), wh.path("temporal_impo_fallos")
    intake.stage_archives(ar.list_archives(spark, str(folder), "01_*.zip"), staging, failures)
    noted = spark.read.schema(intake.FAILURES).parquet(failures).collect()
    assert [(r[FILE][:2], r.lineas_omitidas) for r in noted] == [("01", 1)]
    one = set(wh.staging(IMPORTS).columns)
    intake.stage_archives(ar.list_archives(spark, str(folder), "02_*.zip"), staging, failures)
    assert set(tb.recorded_columns(spark, staging).names) == set(wh.staging(IMPORTS).columns) == one | {"extra"}
    assert wh.staging(IMPORTS).where("extra IS NULL").count() == 3
    # The archive comes again without rows.
    zip_of(folder, "02_Importaciones_2018_Febrero.zip", datos__txt="nit_importador|extra\n")
    intake.stage_archives(ar.list_archives(spark, str(folder), "02_*.zip"), staging, failures)
    assert [f[:2] for f in tb.stored_files(spark, staging)] == ["01"]
    with pytest.raises(ValueError, match="other types"):
        tb.replace_by_file(spark.createDataFrame([(1, "x.zip")], f"nit_importador int, {FILE} string"), staging)


def test_stream_from_archives_to_facts(spark, folder):
    wh = ld.Warehouse(spark, work_dir(spark, "test-wh"))
    checkpoint = wh.path("stage-checkpoint")
    intake.stream_stage_files(wh, IMPORTS, str(folder), checkpoint, max_files=2).awaitTermination()
    failures = spark.read.parquet(wh.path("temporal_impo_fallos"))
    assert sorted(r[0][:2] for r in failures.select(FILE).collect()) == ["01", "04", "05", "06"]
    staged = wh.staging(IMPORTS)
    assert staged.count() == 6 and {"anio_proceso", "extra", "valor"} <= set(staged.columns)
    intake.stream_stage_files(wh, IMPORTS, str(folder), checkpoint).awaitTermination()
    assert wh.staging(IMPORTS).count() == 6

    assert set(ld.load_pending(wh, IMPORTS).values()) == {"SUCCESS"}
    facts = wh.facts(IMPORTS)
    assert facts.count() == 6 and facts.select("id").distinct().count() == 6
    japan = facts.filter(F.col("nit_importador") == "1").first()
    assert (japan.pais_origen, japan.capitulo, japan.anio) == ("JP", "01", 0)
    assert wh.staging(IMPORTS).isEmpty() and wh.outbox().count() == 3
    assert ld.load_pending(wh, IMPORTS) == {}

    # The February archive comes again with other rows: same name, so only on request.
    zip_of(folder, "02_Importaciones_2018_Febrero.zip", datos__txt="nit_importador|extra\n4|x\n7|y\n")
    february = ar.list_archives(spark, str(folder), "02_*.zip")
    intake.stage_archives(february, wh.path("temporal_impo"), wh.path("temporal_impo_fallos"))
    assert ld.load_pending(wh, IMPORTS) == {}
    ld.load_pending(wh, IMPORTS, force=["02_Importaciones_2018_Febrero.zip"])
    facts = wh.facts(IMPORTS)
    assert facts.count() == 7 and facts.select("id").distinct().count() == 7
    assert wh.outbox().count() == 4


def test_one_bad_file_does_not_stop_the_others(spark, sf, monkeypatch):
    files = ["01_Exportaciones_1998_Enero.zip", "02_Exportaciones_1998_Febrero.zip"]
    wh = ld.Warehouse(spark, work_dir(spark, "test-wh"))
    staged = view(spark, sf, "stg_expo").filter(F.col(FILE).isin(files))
    tb.replace_by_file(staged, wh.path(EXPORTS.staging))
    whole = ld.load_files

    def failing(wh, flow, names):
        if files[0] in names:
            raise ValueError("bad file")
        whole(wh, flow, names)

    monkeypatch.setattr(ld, "load_files", failing)
    assert ld.load_pending(wh, EXPORTS) == {files[0]: "ERROR", files[1]: "SUCCESS"}
    monkeypatch.setattr(ld, "load_files", whole)
    assert ld.load_pending(wh, EXPORTS) == {files[0]: "SUCCESS"}
    assert wh.facts(EXPORTS).count() == staged.count()


def test_only_staged_files_can_be_forced(spark, sf):
    wh = ld.Warehouse(spark, work_dir(spark, "test-wh"))
    tb.replace_by_file(view(spark, sf, "stg_expo").filter(F.col(FILE) < "02"), wh.path(EXPORTS.staging))
    with pytest.raises(ValueError, match="not staged: x.zip"):
        ld.load_pending(wh, EXPORTS, force=["x.zip"])
    assert wh.events().isEmpty()


def test_replace_by_rows_of_the_same_table(spark):
    path = work_dir(spark, "test-replace")
    tb.replace_by_file(spark.createDataFrame([("a.zip", 1), ("b.zip", 2)], f"{FILE} string, n int"), path)
    grown = tb.read_table(spark, path).filter("n = 1").withColumn("n", F.col("n") + 5).checkpoint()
    tb.replace_by_file(grown, path, files=["a.zip", "b.zip"])
    assert [tuple(r) for r in tb.read_table(spark, path).select(FILE, "n").collect()] == [("a.zip", 6)]


def test_replace_drops_a_file_without_rows(spark):
    path = work_dir(spark, "test-replace")
    tb.replace_by_file(spark.createDataFrame([("a b.zip", 1), ("c.zip", 2)], f"{FILE} string, n int"), path)
    tb.replace_by_file(spark.createDataFrame([("c.zip", 3)], f"{FILE} string, n int"), path, files=["a b.zip", "c.zip"])
    assert [tuple(r) for r in tb.read_table(spark, path).select(FILE, "n").collect()] == [("c.zip", 3)]


def contents(wh, flow):
    """Everything a load leaves, without what names a moment or a load."""
    by_row = [c for c in wh.facts(flow).columns if c != "fecha_carga_dw"]
    return {
        "facts": sorted(map(str, wh.facts(flow).select(by_row).collect())),
        "members": sorted(map(str, wh.members().select("dim", "id", "codigo", "subcodigo", "nombre").collect())),
        "outbox": sorted(map(str, wh.outbox().drop("fecha", "fecha_actualizacion").collect())),
        "state": sorted(map(str, wh.control().select("tabla_origen", FILE, "fase", "estado", "registros_procesados").collect())),
        "staged": tb.stored_files(wh.spark, wh.path(flow.staging)), "last": wh.last_id(flow),
        "open": len(ld.open_loads(wh, flow)),
    }


class Stop(BaseException):
    """The process ends; nothing after it runs."""


@pytest.fixture(scope="module")
def undisturbed(spark, sf):
    files = ["01_Importaciones_1995_Enero.zip", "02_Importaciones_1995_Febrero.zip"]
    staged = view(spark, sf, "stg_impo").filter(F.col(FILE).isin(files)).limit(40).repartition(1).checkpoint()
    wh = ld.Warehouse(spark, work_dir(spark, "test-wh"))
    tb.replace_by_file(staged, wh.path(IMPORTS.staging))
    assert set(ld.load_pending(wh, IMPORTS).values()) == {"SUCCESS"}
    want = contents(wh, IMPORTS)
    assert want["facts"] and not want["staged"] and not want["open"]
    return staged, want


def test_a_load_cut_off_after_every_step_is_finished(spark, undisturbed, monkeypatch):
    """Each run does what the one before did last, since its note is missing, and one step more."""
    staged, want = undisturbed
    wh = ld.Warehouse(spark, work_dir(spark, "test-wh"))
    tb.replace_by_file(staged, wh.path(IMPORTS.staging))
    note = ld.Load.note
    for step in ld.STEPS:
        def stop(self, wh, now):
            if now == step:
                raise Stop
            note(self, wh, now)

        monkeypatch.setattr(ld.Load, "note", stop)
        with pytest.raises(Stop):
            ld.load_pending(wh, IMPORTS)
        assert len(ld.open_loads(wh, IMPORTS)) == 1
    monkeypatch.undo()
    assert set(ld.load_pending(wh, IMPORTS).values()) == {"SUCCESS"}
    assert contents(wh, IMPORTS) == want


def test_files_staged_anew_end_a_load_that_broke_off(spark, undisturbed, monkeypatch):
    staged, _ = undisturbed
    wh = ld.Warehouse(spark, work_dir(spark, "test-wh"))
    tb.replace_by_file(staged, wh.path(IMPORTS.staging))
    monkeypatch.setitem(ld.STEPS, ld.MEMBERS, lambda wh, load: (_ for _ in ()).throw(Stop))
    with pytest.raises(Stop):
        ld.load_pending(wh, IMPORTS)
    monkeypatch.undo()
    fewer = staged.filter(F.col("numero_formulario").endswith("1"))
    tb.replace_by_file(fewer, wh.path(IMPORTS.staging))
    assert set(ld.load_pending(wh, IMPORTS).values()) == {"SUCCESS"}
    assert wh.facts(IMPORTS).count() == fewer.count() and not ld.open_loads(wh, IMPORTS)
    assert wh.facts(IMPORTS).groupBy("id").count().where("count > 1").isEmpty()


def test_a_file_that_failed_is_tried_again_by_the_stream(spark, sf, monkeypatch):
    files = ["01_Exportaciones_1998_Enero.zip", "02_Exportaciones_1998_Febrero.zip"]
    wh = ld.Warehouse(spark, work_dir(spark, "test-wh"))
    rows = view(spark, sf, "stg_expo")
    tb.replace_by_file(rows.filter(F.col(FILE).isin(files)), wh.path(EXPORTS.staging))
    whole = ld.STEPS[ld.FACTS]

    def failing(wh, load):
        if files[0] in load.files:
            raise ValueError("bad file")
        whole(wh, load)

    start = lambda: intake.stream_facts_by_file(wh, EXPORTS, rows.schema, wh.path("checkpoint")).awaitTermination()
    monkeypatch.setitem(ld.STEPS, ld.FACTS, failing)
    start()
    state = lambda: {r[FILE]: r.estado for r in wh.control().where("fase = 'HECHOS'").collect()}
    assert state() == {files[0]: "ERROR", files[1]: "SUCCESS"} and ld.failed_files(wh, EXPORTS) == files[:1]
    assert ld.failed_files(wh, EXPORTS, failures=1) == []
    monkeypatch.undo()
    start()
    assert (set(state().values()), ld.failed_files(wh, EXPORTS)) == ({"SUCCESS"}, [])
    assert wh.facts(EXPORTS).count() == rows.filter(F.col(FILE).isin(files)).count()
