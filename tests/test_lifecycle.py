import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from casetrail.operators.calendar import fiscal_calendar
from casetrail.operators.lifecycle import entry_lifecycle
from casetrail.operators.monthly import monthly_counts
from casetrail.operators.rollup import case_rollup
from casetrail.operators.spine import daily_counts
from casetrail.operators.staging import stage_cases, stage_entries
from casetrail.operators.marts import active_cases
import brute
from helpers import TYPES, D, aliases_df, cases_df, entries_df, members_df, types_df

AS_OF = dt.date(2024, 3, 20)


def random_entries(seed, n_cases=6, max_entries=9, falling=True):
    rnd = random.Random(seed)
    steps = [0, 0, 1, 2, 5, -1] if falling else [0, 0, 1, 2, 5, 9]
    kinds = [t[0] for t in TYPES] + ["stranger"]
    rows = []
    for c in range(n_cases):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
        for s in range(rnd.randint(1, max_entries)):
            day += dt.timedelta(days=rnd.choice(steps))  # dates may fall (N10)
            rows.append((f"C{c:03d}", s, rnd.choice(kinds), rnd.choice(["u1", "u2", "u3"]), day.isoformat(), "t"))
    return rows


def lc_rows(spark, rows, seg=1 << 16, aliases=(("u2", "u9"),)):
    from casetrail.functions.keys import entry_id
    e = entries_df(spark, rows)
    e = e.select(entry_id("incident_id", "comment_seq").alias("comment_id"), "*")
    return entry_lifecycle(e, types_df(spark, TYPES), aliases_df(spark, list(aliases)), segment_size=seg)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("seg", [2, 3, 1 << 16])
def test_lifecycle_matches_brute_force_any_segment_size(spark, seed, seg):
    rows = random_entries(seed)
    got = {(r.incident_id, r.comment_seq): r.asDict() for r in lc_rows(spark, rows, seg).collect()}
    ents = [dict(incident_id=a, comment_seq=b, comment_div=c, comment_by=d, comment_date=D(e), comment=f)
            for a, b, c, d, e, f in rows]
    exp = brute.lifecycle(ents, TYPES, [("u2", "u9")])
    assert len(got) == len(exp)
    for x in exp:
        g = got[(x["incident_id"], x["comment_seq"])]
        for k, v in x.items():
            assert g[k] == v, (k, x, g)


@pytest.mark.parametrize("seed", [4, 5])
def test_daily_and_monthly_match_brute_force(spark, seed):
    rows = random_entries(seed, n_cases=5)
    lc = lc_rows(spark, rows, seg=2)
    cases = cases_df(spark, [{"incident_id": f"C{c:03d}", "registered_date": "2024-01-05"} for c in range(5)])
    cal = fiscal_calendar(cases, AS_OF)
    dl = {(r.date_id, r.incident_id): r.asDict() for r in daily_counts(lc, cal, AS_OF).collect()}
    ents = [dict(incident_id=a, comment_seq=b, comment_div=c, comment_by=d, comment_date=D(e), comment=f)
            for a, b, c, d, e, f in rows]
    blc = brute.lifecycle(ents, TYPES, [("u2", "u9")])
    exp = brute.daily(blc, dt.date(2023, 4, 1), AS_OF)
    assert set(dl) == set(exp)
    for k, v in exp.items():
        for f, x in v.items():
            assert dl[k][f] == x, (k, f, dl[k], v)
    mo = {(r.month_id, r.incident_id): r.asDict() for r in monthly_counts(daily_counts(lc, cal, AS_OF), AS_OF).collect()}
    bm = brute.monthly(exp, AS_OF)
    assert set(mo) == set(bm)
    for k, v in bm.items():
        for f, x in v.items():
            assert mo[k][f] == x, (k, f, mo[k], v)


@pytest.mark.parametrize("seg,falling", [(3, True), (1 << 16, True), (1 << 16, False), (4, False)])
def test_copartitioned_daily_monthly_match_generic(spark, seg, falling):
    """The warehouse path (days and months made where the entries lie, split cases
    merged) equals the generic one, and months from intervals those from days."""
    from casetrail.functions.keys import entry_id
    from casetrail.operators.lifecycle import PART_COLUMNS
    from casetrail.operators.monthly import monthly_from_intervals
    rows = random_entries(7, n_cases=6, falling=falling)
    e = entries_df(spark, rows).select(entry_id("incident_id", "comment_seq").alias("comment_id"), "*")
    lcx = entry_lifecycle(e, types_df(spark, TYPES), aliases_df(spark, []), segment_size=seg,
                          parts=True)
    cases = cases_df(spark, [{"incident_id": f"C{c:03d}", "registered_date": "2024-01-05"} for c in range(6)])
    cal = fiscal_calendar(cases, AS_OF)
    d1, m1 = daily_counts(lcx, cal, AS_OF), monthly_from_intervals(lcx, cal, AS_OF)
    plain = lcx.drop(*PART_COLUMNS)
    d2 = daily_counts(plain, cal, AS_OF)
    m2 = monthly_counts(d2, AS_OF)
    assert sorted(map(tuple, d1.collect())) == sorted(map(tuple, d2.select(*d1.columns).collect()))
    want = sorted(map(tuple, m2.select(*m1.columns).collect()))
    assert sorted(map(tuple, m1.collect())) == want
    assert sorted(map(tuple, monthly_from_intervals(plain, cal, AS_OF).collect())) == want
    for since in (dt.date(2024, 2, 1), dt.date(2023, 11, 1)):
        late = monthly_from_intervals(lcx, cal, AS_OF, F.lit(since))
        assert sorted(map(tuple, late.collect())) == [r for r in want if r[0] >= since]


def test_n2_n4_open_dev_entry_adds_nothing_and_sum_is_null(spark):
    lc = lc_rows(spark, [("A", 0, "register", "u", "2024-03-01", "t")])
    r = lc.first()
    assert r.next_comment_date is None and r.days_after_comment is None
    cases = cases_df(spark, [{"incident_id": "A", "registered_date": "2024-03-01"}])
    roll = case_rollup(stage_cases(cases, None, None), lc, aliases_df(spark, []), members_df(spark, [])).first()
    assert roll.days_on_developer is None and roll.days_on_field == 0 and roll.days_on_unknown == 0
    dl = daily_counts(lc, fiscal_calendar(cases, AS_OF), AS_OF).collect()
    assert len(dl) == (AS_OF - dt.date(2024, 3, 1)).days + 1
    assert sum(r.elapsed_days for r in dl) == 0


def test_n3_shared_day_two_sources_no_double_count(spark):
    lc = lc_rows(spark, [("A", 0, "register", "u", "2024-03-01", "t"), ("A", 1, "answer", "u", "2024-03-04", "t")])
    cases = cases_df(spark, [{"incident_id": "A", "registered_date": "2024-03-01"}])
    dl = {r.date_id: r for r in daily_counts(lc, fiscal_calendar(cases, AS_OF), AS_OF).collect()}
    shared = dl[dt.date(2024, 3, 4)]
    assert shared.comment_seq == 1 and shared.comment_count == 1 and shared.elapsed_days == 0
    assert sum(dl[dt.date(2024, 3, d)].elapsed_days_on_dev for d in (1, 2, 3)) == 3


def test_n5_filed_side_counts_nowhere(spark):
    lc = lc_rows(spark, [("A", 0, "register", "u", "2024-03-01", "t"), ("A", 1, "direct", "u", "2024-03-02", "t"),
                         ("A", 2, "request", "u", "2024-03-05", "t")])
    r = {x.comment_seq: x for x in lc.collect()}
    assert r[1].ball_on == "filed"
    cases = cases_df(spark, [{"incident_id": "A", "registered_date": "2024-03-01"}])
    dl = daily_counts(lc, fiscal_calendar(cases, AS_OF), AS_OF).collect()
    assert all(x.elapsed_days == x.elapsed_days_on_dev + x.elapsed_days_on_field + x.elapsed_days_on_unknown
               or x.ball_on == "filed" for x in dl)


def test_n8_all_closing_never_closed(spark):
    lc = lc_rows(spark, [("A", 0, "close", "u", "2024-03-01", "t"), ("A", 1, "approve", "u", "2024-03-02", "t")])
    assert not any(r.is_final_closer or r.is_after_final_close for r in lc.collect())


def test_n9_reopened_only_last_close_counts(spark):
    lc = lc_rows(spark, [("A", 0, "register", "u", "2024-03-01", "t"), ("A", 1, "close", "u", "2024-03-02", "t"),
                         ("A", 2, "request", "u", "2024-03-03", "t"), ("A", 3, "close", "u", "2024-03-04", "t"),
                         ("A", 4, "approve", "u", "2024-03-05", "t")])
    r = {x.comment_seq: x for x in lc.collect()}
    assert not r[1].is_final_closer and r[3].is_final_closer
    assert r[4].is_after_final_close and r[4].is_final_approver and r[3].next_comment_date == D("2024-03-05")


def test_n10_dates_falling_give_no_spine_rows(spark):
    lc = lc_rows(spark, [("A", 0, "register", "u", "2024-03-10", "t"), ("A", 1, "answer", "u", "2024-03-05", "t")])
    r = {x.comment_seq: x for x in lc.collect()}
    assert r[0].days_after_comment == -5
    cases = cases_df(spark, [{"incident_id": "A", "registered_date": "2024-03-10"}])
    days = {x.date_id for x in daily_counts(lc, fiscal_calendar(cases, AS_OF), AS_OF).collect()}
    assert dt.date(2024, 3, 10) in days  # from entry 1 (open) only
    assert min(days) == dt.date(2024, 3, 5)


def test_n11_days_before_calendar_start_are_lost(spark):
    lc = lc_rows(spark, [("A", 0, "register", "u", "2023-03-25", "t"), ("A", 1, "answer", "u", "2023-04-03", "t")])
    cases = cases_df(spark, [{"incident_id": "A", "registered_date": "2023-04-02"}])
    days = [x.date_id for x in daily_counts(lc, fiscal_calendar(cases, AS_OF), AS_OF).collect()]
    assert min(days) == dt.date(2023, 4, 1)


def test_n1_n13_rollup_alias_quirk_and_case_without_entries(spark):
    cases = cases_df(spark, [
        {"incident_id": "A", "registered_by": "reg1", "assigned_to": "old", "registered_date": "2024-03-01"},
        {"incident_id": "B", "registered_by": "reg2", "assigned_to": None, "registered_date": "2024-03-01"},
    ])
    lc = lc_rows(spark, [("A", 0, "register", "u", "2024-03-01", "t"), ("A", 1, "close", "u", "2024-03-02", "t")])
    roll = {r.incident_id: r for r in case_rollup(stage_cases(cases, None, None), lc,
                                                  aliases_df(spark, [("old", "new"), ("reg1", "zzz")]),
                                                  members_df(spark, ["new"])).collect()}
    a, b = roll["A"], roll["B"]
    assert a.registered_by == "new" and a.registered_by_org == "reg1"  # N1: assignee's alias row
    assert a.assigned_to == "new" and a.is_assigned_to_dwh and a.closed_date == D("2024-03-02")
    assert b.closed_date is None and b.status is None and b.is_assigned_to_dwh  # N13
    act = [r.incident_id for r in active_cases(case_rollup(stage_cases(cases, None, None), lc,
                                                           aliases_df(spark, []), members_df(spark, []))).collect()]
    assert act == ["B"]


def test_a9_month_end_snapshot_mid_month_as_of(spark):
    rows = [("A", 0, "register", "u", "2024-02-20", "t")]
    lc = lc_rows(spark, rows)
    cases = cases_df(spark, [{"incident_id": "A", "registered_date": "2024-02-20"}])
    for as_of, exp in ((dt.date(2024, 3, 20), {2: 1, 3: 1}), (dt.date(2024, 3, 31), {2: 1, 3: 1})):
        mo = monthly_counts(daily_counts(lc, fiscal_calendar(cases, as_of), as_of), as_of).collect()
        assert {r.month_id.month: r.month_end_active_count for r in mo} == exp


def test_stage_entries_then_lifecycle_direct_close_is_final(spark):
    cases = cases_df(spark, [{"incident_id": "A", "registered_date": "2024-03-01", "close_date": "2024-03-03"}])
    ents = entries_df(spark, [("A", 0, "register", "u", "2024-03-01", "t")])
    st = stage_entries(ents, None, None, stage_cases(cases, None, None), types_df(spark, TYPES))
    lc = {r.comment_seq: r for r in entry_lifecycle(st, types_df(spark, TYPES), aliases_df(spark, [])).collect()}
    assert lc[1].comment_div == "others" and lc[1].ball_on == "unknown"  # type absent from this master
    assert not lc[1].is_final_closer


def test_stored_layers_live_in_shared_folder_and_can_be_dropped(spark):
    import os
    from casetrail.plans.adapters import event_inputs
    from casetrail.plans.warehouse import ALL_TABLE_LAYERS, build
    wh = build(event_inputs(spark, "/root/testdata/sf0.001"), tables=ALL_TABLE_LAYERS)
    n = wh.mart_monthly.count()
    from casetrail.sources.layers import location
    root = location(spark).removeprefix("file:")
    assert root.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    held = lambda: {x.removeprefix(f"{wh.run_id}_") for x in os.listdir(root) if x.startswith(wh.run_id)}
    assert {"stg_entries", "lifecycle", "monthly", "rollup"} <= held()
    assert n == wh.mart_monthly.count()
    wh.drop_tables()
    assert not held()


def test_n6_force_close_wording_without_final_close(spark):
    force = "ご連絡がなかったため\nクローズします。新規QA登録をお願いします"
    lc = lc_rows(spark, [("A", 0, "register", "u", "2024-03-01", "t"), ("A", 1, "answer", "u", "2024-03-02", force),
                         ("A", 2, "request", "u", "2024-03-03", "t")])
    r = {x.comment_seq: x for x in lc.collect()}
    assert r[1].is_force_close and not r[1].is_final_closer
    cases = cases_df(spark, [{"incident_id": "A", "registered_date": "2024-03-01"}])
    day = {x.date_id: x for x in daily_counts(lc, fiscal_calendar(cases, AS_OF), AS_OF).collect()}[D("2024-03-02")]
    assert (day.close_count, day.close_count_normal, day.close_count_force) == (0, 0, 1)


def test_n12_registration_is_seq_zero(spark):
    lc = lc_rows(spark, [("A", 0, "register", "u", "2024-03-01", "t"), ("B", 1, "register", "u", "2024-03-01", "t")])
    cases = cases_df(spark, [{"incident_id": x, "registered_date": "2024-03-01"} for x in ("A", "B")])
    day = {x.incident_id: x.registered_count
           for x in daily_counts(lc, fiscal_calendar(cases, AS_OF), AS_OF).collect() if x.date_id == D("2024-03-01")}
    assert day == {"A": 1, "B": 0}


def test_rank_within_case_equals_plain_rank(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from casetrail.plans.adapters import seq_within_case
    rows = [("A" if i % 5 else "B", dt.date(2024, 1, 1 + (i * 7) % 3), i) for i in range(200)]
    df = spark.createDataFrame(rows, "c string, d date, k int")
    got = seq_within_case(df, "c", "d", [F.col("k")], "rank_test")
    want = df.withColumn("comment_seq", (F.row_number().over(Window.partitionBy("c").orderBy("d", "k")) - 1).cast("int"))
    assert sorted(map(tuple, got.select("c", "d", "k", "comment_seq").collect())) == \
        sorted(map(tuple, want.select("c", "d", "k", "comment_seq").collect()))


def test_rank_needs_the_shared_folder(spark, monkeypatch):
    from casetrail.plans import adapters
    from casetrail.sources import layers

    def unset(_spark):
        raise RuntimeError("spark.checkpoint.dir is not set")
    layers.release(spark)
    monkeypatch.setattr(layers, "shared_dir", unset)
    with pytest.raises(RuntimeError):
        adapters.seq_within_case(spark.range(3), "id", "id", [], "rank_test")
