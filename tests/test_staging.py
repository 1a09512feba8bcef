import os

import pytest
from pyspark.sql import functions as F

from casetrail.operators.overlay import overlay
from casetrail.operators.staging import stage_cases, stage_entries
from casetrail.sources.files import write_table
from casetrail.sources.ids import bad_ids, check_ids, id_domain
from casetrail.sources.layout import column_map, typed_projection
from helpers import D, cases_df, entries_df, types_df

MASTER = [("asked", "dev", False, False, False, False), ("solved", "field", True, False, False, True),
          ("noted", "dev", False, False, False, True)]


def last_entry(spark, closed, kind, day):
    """Ids and the last entry of one case whose log ends with ``kind`` on ``day``."""
    cases = cases_df(spark, [{"incident_id": "Q-7", "close_date": closed}])
    log = entries_df(spark, [("Q-7", 0, "asked", "ana", "2022-06-10", "where is it"), ("Q-7", 4, kind, "bo", day, "here")])
    rows = stage_entries(log, None, None, cases, types_df(spark, MASTER)).orderBy("comment_seq").collect()
    return [r["comment_id"] for r in rows], tuple(rows[-1])


def test_no_entry_is_added_after_a_closing_one(spark):
    ids, _ = last_entry(spark, "2022-06-14", "solved", "2022-06-14")
    assert ids == ["Q-7_0000", "Q-7_0004"]


def test_direct_close_on_and_after_the_last_day(spark):
    for closed in ("2022-06-12", "2022-08-01"):
        ids, last = last_entry(spark, closed, "noted", "2022-06-12")
        assert ids == ["Q-7_0000", "Q-7_0004", "Q-7_0005"]
        assert last[1:6] == ("Q-7", 5, "完了へ直接変更", "(dummy)", D(closed))
        assert last[6] == "(ライブラリ変更などによりステータスを直接完了に変更)"


def test_no_direct_close_before_the_last_day_or_while_open(spark):
    for closed in ("2022-06-11", None):
        assert last_entry(spark, closed, "noted", "2022-06-12")[0] == ["Q-7_0000", "Q-7_0004"]


def test_a_type_that_the_master_lacks_counts_as_not_closing(spark):
    assert last_entry(spark, "2022-06-13", "unheard of", "2022-06-12")[1][2] == 5


def test_overlay_is_not_a_merge_and_keeps_null_keys(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    before = spark.createDataFrame([(2, "b"), (None, "x")], "k int, v string")
    after = spark.createDataFrame([(2, "B"), (9, "new")], "k int, v string")
    got = sorted((str(r.k), r.v) for r in overlay(base, before, after, ["k"]).collect())
    assert got == sorted([("1", "a"), ("None", "n"), ("2", "B"), ("9", "new")])


def test_stage_cases_library_flag(spark):
    cases = cases_df(spark, [{"incident_id": "A", "description": "★" * 19 + " ライブラリの変更が完了しました"},
                             {"incident_id": "B", "description": None}])
    got = {r.incident_id: r.has_library_change for r in stage_cases(cases, None, None).collect()}
    assert got == {"A": True, "B": False}


def test_column_map_kinds(spark):
    df = spark.createDataFrame([("1", "x", "y")], "`管理NO` string, `件名` string, other string")
    m = [{"name": "incident_id", "type": "map", "source": "管理NO"},
         {"name": "title", "type": "map", "source": "件名"},
         {"name": "src", "type": "const", "value": "qa"},
         {"name": "category2", "type": "blank"},
         {"name": "odd", "type": "something"}]
    assert [tuple(r) for r in column_map(df, m).collect()] == [("1", "x", "qa", "", "")]
    with pytest.raises(KeyError):
        column_map(df, [{"name": "a", "type": "map", "source": "missing"}])


def test_typed_projection_strict_and_tolerant(spark):
    df = spark.createDataFrame([("1", "2024/1/17"), ("2", "yyyy/mm/dd")], "n string, d string")
    got = [tuple(r) for r in typed_projection(df, [("n", "int"), ("d", "date")]).collect()]
    assert got == [(1, D("2024-01-17")), (2, None)]


def test_write_refuses_existing_target(spark, tmp_out):
    p = os.path.join(tmp_out, "t")
    df = spark.range(3)
    write_table(df, p)
    with pytest.raises(Exception):
        write_table(df, p)


def test_id_domain_and_check(spark):
    assert [r[0] for r in id_domain(spark, "SMPL", 3).collect()] == ["SMPL-000001", "SMPL-000002", "SMPL-000003"]
    ok = spark.createDataFrame([("SMPL-000001",), ("SMPL-0000012tail",)], "id string")
    check_ids(ok, "id", "SMPL")
    bad = spark.createDataFrame([("SMPL-000001",), ("000002",)], "id string")
    with pytest.raises(ValueError):
        check_ids(bad, "id", "SMPL")
    assert [r[0] for r in bad_ids(bad, "id", "SMPL").collect()] == ["000002"]
