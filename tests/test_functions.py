from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import aforo.functions as fn
from aforo.catalogs import HS_CHAPTERS, country_names
from aforo.functions.text import BLANKS
from aforo.plans.facts import add_country
from aforo.sources.staging import drop_blank_rows, file_period, finite


def values(spark, cells, column):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize("by_name", [True, False])
def test_clean_text(spark, by_name):
    column = fn.clean_text("c" if by_name else F.col("c"))
    cells = ["\t a b  \x1c\x85　", "   ", "", None, "x", " ñ ", "é", "a\tb", "!", "~", "\x00"]
    assert values(spark, cells, column) == ["a b", None, None, None, "x", "ñ", "é", "a\tb", "!", "~", "\x00"]


def test_every_python_blank_is_stripped(spark):
    blanks = [chr(i) for i in range(0x110000) if chr(i).isspace()]
    assert sorted(BLANKS) == blanks
    assert values(spark, [f"{b}x{b}" for b in blanks], fn.clean_text("c")) == ["x"] * len(blanks)


def test_sql_clean_strips_spaces_only(spark):
    assert values(spark, ["\t a ", "  ", None], fn.sql_clean("c")) == ["\t a", None, None]


def test_parse_date8(spark):
    cells = ["20180115", " 20180115 ", "20180230", "2018011", "2018-01-15", "00000101", "S/F", None, "20200229", "+2018011"]
    good = date(2018, 1, 15)
    assert values(spark, cells, fn.parse_date8("c")) == [
        good, good, None, None, None, None, None, None, date(2020, 2, 29), None,
    ]


def test_first_valid_date(spark):
    column = fn.first_valid_date(F.lit("S/F"), F.lit(None).cast("string"), F.col("c"))
    assert values(spark, ["20180301"], column) == [date(2018, 3, 1)]


def test_parse_decimal(spark):
    cells = ["1e3", " 12.345 ", "-2.345", "1.234,56", "NaN", "1_000", "9" * 20, "", None, "Infinity", ".5"]
    d = Decimal
    assert values(spark, cells, fn.parse_decimal("c")) == [
        d("1000.00"), d("12.35"), d("-2.35"), None, None, None, None, None, None, None, d("0.50"),
    ]
    assert values(spark, ["12.345"], fn.parse_decimal(F.col("c"), 18, 4)) == [d("12.3450")]


def test_parse_int(spark):
    assert values(spark, ["3.9", "-3.9", "x", "7", ""], fn.parse_int("c")) == [3, -3, None, 7, None]


def test_calendar_fields(spark):
    df = spark.sql("SELECT * FROM VALUES (date'2018-05-01'), (NULL) t(d)")
    rows = df.select(*fn.calendar_fields("d").values()).collect()
    assert [tuple(r) for r in rows] == [(2018, 2, 5, "Mayo", "2018-05"), (0, None, None, None, None)]


def test_country_catalogue(spark):
    names = country_names()
    assert len(names) == 264 and len(set(names.values())) == 228
    assert all(fn.fold_text(n) == n and len(c) == 2 and c.isupper() for n, c in names.items())
    assert list(names) == sorted(names)
    folded = values(spark, ["Japón", "COREA (SUR) REPÚBLICA DE", "ZONA FRANCA CALI", "no relacionado"], fn.fold_accents("c"))
    assert [names.get(n) for n in folded] == ["JP", "KR", None, "ZZ"]
    assert "77" not in HS_CHAPTERS and len(HS_CHAPTERS) == 96


def test_every_country_name_is_found(spark):
    names = country_names()
    df = spark.createDataFrame([(f" {n.title()} ",) for n in names], "c string")
    got = {r._country: r.iso2 for r in add_country(df, fn.clean_text("c"), "iso2").withColumn("_country", fn.fold_accents("c")).collect()}
    assert got == names


def test_hs(spark):
    assert values(spark, ["0101210000", "7700", "7", None], fn.hs_chapter("c")) == ["01", "77", None, None]
    df = spark.createDataFrame([("0101210000",)], "c string")
    assert tuple(df.select(*fn.hs_levels("c").values()).first()) == ("01", "0101", "010121", "01012100")


HEADERS = {
    "Año Proceso (%)": "ano_proceso", "1er Valor": "col_1er_valor", "***": "campo_desconocido",
    " _x__y_ ": "x_y", "Straße": "stra_e",
}


def test_clean_headers(spark):
    assert [fn.clean_header(h) for h in HEADERS] == list(HEADERS.values())
    assert values(spark, list(HEADERS), fn.clean_header_column("c")) == list(HEADERS.values())
    assert fn.clean_headers(spark.createDataFrame([(1,)], "`Año` int")).columns == ["ano"]


def test_file_period(spark):
    df = spark.createDataFrame([("01_Importaciones_2018_Enero.zip",), ("x.zip",)], "f string")
    rows = df.select(*file_period("f").values()).collect()
    assert [tuple(r) for r in rows] == [(2018, "Enero"), (None, None)]


def test_resolve_or_fallback(spark):
    rows = [("A", "B", "1"), ("", "B", "1"), (None, None, "1"), (None, None, None)]
    df = spark.createDataFrame(rows, "name string, raw string, code string")
    assert [r[0] for r in df.select(fn.resolve_or_fallback("name", "raw", "code")).collect()] == ["A", "B", "1", None]


def test_keys_and_regimes(spark):
    df = spark.createDataFrame([("", " acme "), ("9", "acme"), (None, None)], "id string, name string")
    assert [r[0] for r in df.select(fn.surrogate_natural_key("id", "name")).collect()] == ["NOMBRE:ACME", "9", None]
    df = spark.createDataFrame([("48", "C100"), ("48", None)], "a string, b string")
    assert [r[0] for r in df.select(fn.regime_code("a", "b", F.lit(None).cast("string"))).collect()] == ["48-C100", None]


def test_drop_blank_rows(spark):
    rows = [(None, "", 0.0), (None, None, float("nan")), ("x", None, None), (None, None, 2.0), ("0", "", 0.0)]
    df = spark.createDataFrame(rows, "a string, b string, n double")
    assert drop_blank_rows(finite(df)).count() == 3
