import re

from aforo.plans import dimensions as dm
from aforo.plans import facts as fc
from aforo.sinks import tables as tb
from checks.queries import checkpointed
from checks.views import live


def test_methods_of_a_fact_are_small_enough_to_be_compiled(spark, sf, tmp_path):
    """The JVM interprets methods beyond 8000 bytes, unless told otherwise."""
    path = str(tmp_path / "staged")
    tb.replace_by_file(live(spark, sf, "stg_impo"), path)
    staged = tb.read_table(spark, path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    # As in a session that was built without this library's settings.
    fields = spark.conf.get("spark.sql.codegen.maxFields")
    spark.conf.set("spark.sql.codegen.maxFields", "100")
    try:
        members = checkpointed(dm.candidate_members(staged, first_file_wins=True))
        plan = fc.fact_importacion(staged, fc.Dictionaries(members))._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.codegen.maxFields", fields)
    assert len(sizes) >= 5 and max(sizes) < 8000
