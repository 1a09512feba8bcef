"""Corrections through the warehouse, stored layers and the export-to-seed chain."""
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import __spark_entry__ as E
from casetrail.operators.marts import dim_entry_type
from casetrail.plans.adapters import order_inputs
from casetrail.plans.warehouse import ALL_TABLE_LAYERS, Inputs, build, staged
from casetrail.sources.layers import database, drop_layers, layer, location, release, save_layer, snapshot
from helpers import TYPES, D, aliases_df, cases_df, entries_df, members_df, types_df

SF = "/root/testdata/sf0.001"


def inputs(spark, **corrections):
    cases = cases_df(spark, [{"incident_id": "A", "registered_date": "2024-01-01", "close_date": "2024-01-20"},
                             {"incident_id": "B", "registered_date": "2024-01-02", "description": "old"}])
    entries = entries_df(spark, [("A", 0, "register", "u", "2024-01-01", "a0"), ("A", 1, "close", "u", "2024-01-05", "a1"),
                                 ("B", 0, "register", "u", "2024-01-02", "b0"), ("B", 1, "answer", "u", "2024-01-03", "b1"),
                                 (None, 1, "answer", "u", "2024-01-03", "no case")])
    return Inputs(cases, entries, types_df(spark, TYPES), aliases_df(spark, []), members_df(spark, []), D("2024-02-15"), **corrections)


def staged_rows(inp):
    return sorted((r["incident_id"], r["comment_seq"], r["comment_div"], str(r["comment_date"]), r["comment"])
                  for r in staged(inp)[1].filter("incident_id is not null").collect())


def test_corrections_reach_both_levels_and_the_direct_close(spark):
    """The composite key: (A, 1) goes while (B, 1) stays.  With its closing entry withdrawn,
    A ends in an open entry and is closed directly; B gets a new closing entry."""
    before = entries_df(spark, [("A", 1, None, None, None, None), ("B", 9, None, None, None, None)])
    after = entries_df(spark, [("B", 2, "close", "w", "2024-01-09", "new")])
    inp = inputs(spark, entries_before=before, entries_after=after)
    rows = staged_rows(inp)
    assert [r[:4] for r in rows if r[0] == "A"] == [("A", 0, "register", "2024-01-01"), ("A", 1, "完了へ直接変更", "2024-01-20")]
    assert [r[1:3] for r in rows if r[0] == "B"] == [(0, "register"), (1, "answer"), (2, "close")]
    assert staged(inp)[1].filter("incident_id is null").count() == 1  # a NULL key never matches

    case_before = cases_df(spark, [{"incident_id": "B"}])
    case_after = cases_df(spark, [{"incident_id": "B", "registered_date": "2024-01-02", "close_date": "2024-01-30"},
                                  {"incident_id": "C", "registered_date": "2024-01-04"}])
    inp = inputs(spark, cases_before=case_before, cases_after=case_after)
    cases = {r["incident_id"]: r for r in staged(inp)[0].collect()}
    assert set(cases) == {"A", "B", "C"} and cases["B"]["description"] is None
    # the corrected header decides: B closes after its last entry now
    assert ("B", 2, "完了へ直接変更", "2024-01-30") in [r[:4] for r in staged_rows(inp)]
    assert [r for r in staged_rows(inp) if r[0] == "C"] == []
    assert {r["incident_id"] for r in build(inp, tables=()).rollup.collect()} == {"A", "B", "C"}


def test_one_sided_corrections(spark):
    only_after = inputs(spark, entries_after=entries_df(spark, [("A", 2, "answer", "u", "2024-01-06", "late")]))
    assert ("A", 2, "answer", "2024-01-06", "late") in staged_rows(only_after)
    only_before = inputs(spark, entries_before=entries_df(spark, [("A", 0, None, None, None, None)]))
    assert [r[1] for r in staged_rows(only_before) if r[0] == "A"] == [1]


def test_adapters_correct_something_at_both_levels(spark):
    inp = order_inputs(spark, SF)
    counts = [x.count() for x in (inp.cases_before, inp.cases_after, inp.entries_before, inp.entries_after)]
    assert all(counts)
    cases, entries = staged(inp)
    assert cases.filter(F.col("incident_id").endswith("-B")).count() > 0
    assert entries.filter(F.col("comment_by") == "corrector").count() > 0
    assert cases.groupBy("incident_id").count().filter("count > 1").isEmpty()
    assert entries.groupBy("incident_id", "comment_seq").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("typed", [True, False])
def test_last_type_is_picked_by_number_or_text(spark, typed):
    """Unknown types are 'others' on side 'unknown' either way, cases without entries have no status."""
    from casetrail.operators.lifecycle import entry_lifecycle
    from casetrail.operators.rollup import case_rollup
    entries = entries_df(spark, [("A", 0, "register", "u", "2024-01-01", "x"), ("A", 1, "close", "u", "2024-01-02", "x"),
                                 ("B", 0, "answer", "u", "2024-01-01", "x"), ("B", 1, "strange", "u", "2024-01-01", "x")])
    entries = entries.withColumn("comment_id", F.lit("i"))
    types, cases = types_df(spark, TYPES), cases_df(spark, [{"incident_id": x} for x in "ABC"]).withColumn("has_library_change", F.lit(False))
    rows = case_rollup(cases, entry_lifecycle(entries, types, aliases_df(spark, [])), aliases_df(spark, []), members_df(spark, []),
                       types if typed else None).collect()
    assert {r["incident_id"]: (r["status"], r["ball_on"]) for r in rows} == {
        "A": ("close", "field"), "B": ("others", "unknown"), "C": (None, None)}


def files_under(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    return sum(len(f) for _, _, f in os.walk(root.removeprefix("file:")))


def test_queries_run_twice_without_growth(spark):
    run = lambda: [E.queries()[q](spark, SF).count() for q in ("daily_counts_events", "mart_monthly_orders", "seed_entries_conversations")]
    first, held = run(), files_under(spark)
    assert run() == first and files_under(spark) == held


def test_stored_layers_are_refused_dropped_and_renamed_by_state(spark, tmp_out):
    save_layer(spark.range(7), "lt_one", ["id"])
    assert f"{database(spark)}" in spark.sql(f"DESCRIBE EXTENDED {database(spark)}.lt_one").toPandas().to_string()
    with pytest.raises(AnalysisException):
        save_layer(spark.range(3), "lt_one")
    assert layer(spark, "lt_one", lambda: pytest.fail("made again")).count() == 7
    drop_layers(spark, "lt_")
    assert not spark.catalog.tableExists(f"{database(spark)}.lt_one")
    assert not [f for _, _, fs in os.walk(location(spark).removeprefix("file:") + "/lt_one") for f in fs]
    assert layer(spark, "lt_one", lambda: spark.range(2)).count() == 2
    path = f"{tmp_out}/t"
    spark.range(3).write.parquet(path)
    one = snapshot(spark, path)
    assert snapshot(spark, path) == one
    spark.range(4).write.mode("append").parquet(path)
    assert snapshot(spark, path) != one


def test_full_stored_build_can_be_dropped_and_dimensions(spark):
    wh = build(inputs(spark), tables=ALL_TABLE_LAYERS)
    assert wh.mart_monthly.count() >= 0 and wh.daily.count() > 0
    again = build(inputs(spark), tables=ALL_TABLE_LAYERS, run_id=wh.run_id)
    assert sorted(map(str, again.monthly.collect())) == sorted(map(str, wh.monthly.collect()))
    assert wh.dim_calendar.agg(F.min("date_id")).first()[0] == D("2023-04-01")
    assert sorted(r["comment_div"] for r in wh.dim_entry_type.collect()) == sorted(t[0] for t in TYPES)
    assert dim_entry_type(wh.inp.types).columns == wh.inp.types.columns
    wh.drop_tables()
    assert not [t.name for t in spark.catalog.listTables(database(spark)) if t.name.startswith(wh.run_id)]


def test_release_leaves_nothing(spark):
    """The whole database goes, and the next layer makes it anew."""
    save_layer(spark.range(2), "lt_last")
    place = location(spark).removeprefix("file:")
    release(spark)
    assert not os.path.exists(place) or not os.listdir(place)
    assert layer(spark, "lt_last", lambda: spark.range(5)).count() == 5


def test_seed_chain_refuses_targets_and_keeps_line_ends(spark, tmp_out):
    from casetrail.plans.checks import EXPORT_COLUMNS, SEED_MAP
    from casetrail.plans.seeds import build_seeds
    from casetrail.sources.files import write_export
    rows = [("C-1", "u", "2024/1/5", " ①髙 \"quoted\", text ", "line one\nline two(close:u 2024/01/06)"), ("C-2", "v", None, "", None)]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in EXPORT_COLUMNS.values()))
    export = raw.select(*[F.col(c).alias(e) for e, c in EXPORT_COLUMNS.items()])
    write_export(export, f"{tmp_out}/x", 2)
    with pytest.raises(AnalysisException):
        write_export(export, f"{tmp_out}/x", 2)
    for fmt in ("parquet", "csv"):
        targets = f"{tmp_out}/{fmt}-c", f"{tmp_out}/{fmt}-e"
        cases, entries = build_seeds(spark, f"{tmp_out}/x", SEED_MAP, *targets, fmt)
        got = {r["incident_id"]: r for r in cases.collect()}
        assert got["C-1"]["description"] == rows[0][3] and got["C-1"]["comment_history"] == rows[0][4]
        assert got["C-2"]["description"] is None and got["C-2"]["patch_no"] is None and got["C-2"]["status"] == "取込"
        assert entries.filter("incident_id = 'C-1' and comment_seq = 1").first()["comment"] == "line oneline two"
        with pytest.raises(AnalysisException):
            build_seeds(spark, f"{tmp_out}/x", SEED_MAP, *targets, fmt)


def test_stored_entries_are_overlaid_once(spark):
    """The sizes of the segments and the direct close read the stored overlay, which goes afterwards."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text
    rows = [(f"C{i}", k, "answer", "u", "2024-01-05", "text") for i in range(5) for k in range(4)]
    entries = entries_df(spark, rows).withColumn("comment", seen.asNondeterministic()("comment"))
    cases = cases_df(spark, [{"incident_id": f"C{i}", "registered_date": "2024-01-01", "close_date": "2024-01-20"} for i in range(5)])
    wh = build(Inputs(cases, entries, types_df(spark, TYPES), aliases_df(spark, []), members_df(spark, []), D("2024-02-15")))
    assert wh.entries.count() == 25 and read.value == len(rows)
    assert [t.name for t in spark.catalog.listTables(database(spark)) if t.name.startswith(wh.run_id)] == [f"{wh.run_id}_stg_entries"]
    wh.drop_tables()
