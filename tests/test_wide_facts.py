from aforo.plans import dimensions as dm
from aforo.plans import facts as fc
from checks.queries import checkpointed
from checks.views import live


def nodes(plan):
    children = plan.children()
    return [plan, *(n for i in range(children.size()) for n in nodes(children.apply(i)))]


def test_lookups_carry_few_columns(spark, sf):
    """Each lookup copies the rows that pass it, so a fact with all columns fed must not go through them column by column."""
    staged = live(spark, sf, "stg_impo_full")
    facts = fc.fact_importacion(staged, fc.Dictionaries(checkpointed(dm.candidate_members(staged, first_file_wins=True))))
    joins = [n for n in nodes(facts._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join"]
    widths = [n.output().size() for n in joins if "_name_" in n.output().toString()]
    assert len(widths) >= 10 and max(widths) < 60
