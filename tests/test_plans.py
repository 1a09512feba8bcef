"""Plan-shape checks: the physical plans keep the properties the design relies on."""
import pytest

import __spark_entry__ as E
from casetrail.plans.adapters import event_inputs
from casetrail.plans.warehouse import build

SF = "/root/testdata/sf0.001"


def walk(node, path=()):
    """Yield (node, ancestors) over a physical plan (subqueries excluded)."""
    yield node, path
    kids = node.children()
    for i in range(kids.size()):
        yield from walk(kids.apply(i), path + (node,))


def physical(df):
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def names(plan):
    return [n.nodeName() for n, _ in walk(plan)]


@pytest.fixture(scope="module")
def wh(spark):
    return build(event_inputs(spark, SF), tables=("stg_entries", "lifecycle"))


def above(plan, name):
    """Names of the nodes above each node called ``name``, nearest first."""
    return [[a.nodeName() for a in reversed(path)] for n, path in walk(plan) if n.nodeName() == name]


@pytest.mark.parametrize("layer, made", [("daily", "date_id"), ("monthly", "month_id")])
def test_rows_are_made_where_entries_lie(wh, layer, made):
    """Above the stored, bucketed lifecycle: one expansion for rows that are final at once,
    one for shared ones, one for split cases; the only exchange brings
    a split case's segments together, behind its own roll-up."""
    plan = physical(getattr(wh, layer))
    paths = above(plan, "Generate")
    assert len(paths) == 3
    assert [sum("Exchange" in n for n in p) for p in paths] == [0, 0, 1]
    assert not any(n.startswith("Sort") or "Window" in n for n in paths[0])
    assert paths[2].index("Window") < next(i for i, n in enumerate(paths[2]) if "Exchange" in n)
    assert sum("Exchange" in n for n in names(plan)) == 1
    gens = [n.toString().split("\n")[0] for n, _ in walk(plan) if n.nodeName() == "Generate"]
    assert all(f"[{made}#" in g for g in gens)  # no row per day on the way to months


def test_ranks_are_stored_with_the_entries(spark):
    """Entries and their corrections read ranks; none joins rows to where their case begins again."""
    inp = event_inputs(spark, SF)
    assert not any("Join" in n or "Exchange" in n or "Window" in n for n in names(physical(inp.entries)))


def test_mart_makes_no_month_before_its_scope(wh):
    plan = physical(wh.mart_monthly)
    for n, path in walk(plan):
        if n.nodeName() == "Generate":
            below = n.toString()
            assert "greatest(comment_date" in below  # clipped below the expansion
            assert not any("trunc(date_id" in a.toString().split("\n")[0] for a in path)


def test_stored_entries_need_no_shuffle_for_the_lifecycle(spark, wh):
    wh.entries_x, wh.lifecycle_x  # stored
    plan = physical(wh.lifecycle)
    moved = [n for n, _ in walk(plan) if n.nodeName() == "Exchange"]
    # only the small table of segments moves, to its cases and back
    assert len(moved) <= 2 and not any("comment_by" in n.output().toString() for n in moved)
    assert all("_last_seq" in n.output().toString() or "_s_max" in n.output().toString() for n in moved)


@pytest.mark.parametrize("query", ["case_rollup_events", "case_rollup_orders", "stage_entries_events", "direct_close_events"])
def test_picks_hash_and_texts_stay(spark, query):
    plan = physical(E.queries()[query](spark, SF))
    assert "SortAggregate" not in names(plan)
    for n, _ in walk(plan):
        if n.nodeName() == "Exchange" and query.startswith("case_rollup"):
            assert "comment#" not in n.output().toString()


def test_unstored_rollup_moves_no_texts(spark):
    inp = event_inputs(spark, SF)
    plan = physical(build(inp, tables=()).rollup)
    assert "SortAggregate" not in names(plan)
    lifecycle = [n for n, _ in walk(plan) if n.nodeName() == "Exchange" and "_seg#" in n.output().toString()]
    assert lifecycle and not any("comment#" in n.output().toString() for n in lifecycle)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_nested_loop_or_cartesian_joins(spark, name):
    ns = names(physical(E.queries()[name](spark, SF)))
    assert not any("NestedLoop" in n or "Cartesian" in n for n in ns), ns


def test_scan_reads_only_needed_columns(spark):
    plan = physical(E.queries()["text_flags_documents"](spark, SF)).toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_lifecycle_has_no_global_window(spark):
    df = E.queries()["entry_lifecycle_events"](spark, SF)
    plan = physical(df).toString()
    assert "SinglePartition" not in plan.split("Subquery")[0]
