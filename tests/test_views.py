import pytest

import checks.views as views
from checks.queries import QUERIES, import_facts


@pytest.mark.parametrize("name", ["dim_forma_pago", "not_blank", "hs_chapter", "classify_columns"])
def test_queries_read_the_tables_and_store_no_staging_first(spark, sf, name):
    files = QUERIES[name](spark, sf).inputFiles()
    assert files and all(f.startswith(f"file://{sf}/") for f in files)


@pytest.mark.parametrize("name", ["stg_impo", "stg_expo"])
def test_rows_are_the_same_whatever_the_joins(spark, sf, name, monkeypatch):
    want = views._select(spark, sf, name).checkpoint()
    monkeypatch.setattr(views, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for got in (views.live(spark, sf, name), views.live(spark, sf, name, by_month=True)):
            assert got.columns == want.columns and got.count() == want.count()
            assert got.exceptAll(want).isEmpty()
        months = views.live(spark, sf, name, by_month=True)._jdf.queryExecution().optimizedPlan().toString()
        assert months.index("RebalancePartitions") < months.index("Join")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_take_the_rows_of_a_month_together(spark, sf):
    plan = import_facts(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions") == 1
