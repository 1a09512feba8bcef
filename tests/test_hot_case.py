"""A case holding every entry of a whole table: split into segments at the
default size, and the results equal the one-segment computation."""
import os

import pytest
from pyspark.sql import functions as F

from casetrail.operators.calendar import fiscal_calendar
from casetrail.operators.lifecycle import LIFECYCLE_COLUMNS, entry_lifecycle
from casetrail.operators.monthly import monthly_counts, monthly_from_intervals
from casetrail.operators.spine import daily_counts
from casetrail.functions.keys import entry_id
from casetrail.plans.adapters import EVENTS_AS_OF, EVENT_ALIASES, EVENT_TYPES, masters, seq_within_case
from helpers import cases_df

SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
def test_one_hot_case_spans_segments(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    n = ev.count()
    assert n > (1 << 16)  # more entries than one segment holds
    hot = ev.select(F.lit("HOT").alias("incident_id"), "ts", "event_id", "event_type", "props",
                    F.to_date("ts").alias("_day"))
    ranked = seq_within_case(hot, "incident_id", "_day", [F.col("ts"), F.col("event_id")], f"hot_{os.getpid()}")
    entries = ranked.select(
        entry_id("incident_id", "comment_seq").alias("comment_id"), "incident_id", "comment_seq",
        F.col("event_type").alias("comment_div"), F.lit("u").alias("comment_by"),
        F.col("_day").alias("comment_date"), F.col("props").alias("comment"))
    p = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"hot-{os.getpid()}")
    entries.write.mode("overwrite").parquet(p)
    entries = spark.read.parquet(p)
    seqs = entries.agg(F.min("comment_seq"), F.max("comment_seq"), F.countDistinct("comment_seq")).first()
    assert tuple(seqs) == (0, n - 1, n)  # dense ranks although the case spans many range partitions
    types, aliases, _ = masters(spark, EVENT_TYPES, EVENT_ALIASES)

    split = entry_lifecycle(entries, types, aliases, parts=True)
    one = entry_lifecycle(entries, types, aliases, segment_size=1 << 30)
    a = split.select(*LIFECYCLE_COLUMNS).exceptAll(one.select(*LIFECYCLE_COLUMNS))
    assert a.count() == 0 and split.count() == n

    cases = cases_df(spark, [{"incident_id": "HOT", "registered_date": "2024-01-01"}])
    cal = fiscal_calendar(cases, EVENTS_AS_OF)
    d1, m1 = daily_counts(split, cal, EVENTS_AS_OF), monthly_from_intervals(split, cal, EVENTS_AS_OF)
    d2 = daily_counts(one, cal, EVENTS_AS_OF)
    m2 = monthly_counts(d2, EVENTS_AS_OF)
    assert d1.exceptAll(d2.select(*d1.columns)).count() == 0 and d1.count() == d2.count()
    assert m1.exceptAll(m2.select(*m1.columns)).count() == 0 and m1.count() == m2.count()


def test_segments_of_long_texts_are_cut_by_bytes(spark):
    """A case of long texts: no segment holds much more than the limit, other cases keep
    theirs, and the figures are those of whole segments."""
    from casetrail.operators.lifecycle import PART_COLUMNS, with_segments
    from casetrail.operators.monthly import monthly_from_intervals
    from helpers import TYPES, aliases_df, entries_df, types_df
    kinds = [t[0] for t in TYPES]
    rows = [(c, i, kinds[(i * i + len(c)) % len(kinds)], "u", f"2024-01-{1 + i // 9:02d}", "x" * (400 if c == "LONG" else 3))
            for c in ("LONG", "SHORT") for i in range(150)] + [(None, 0, "answer", "u", "2024-01-01", "y" * 9000)]
    e = entries_df(spark, rows).withColumn("comment_id", entry_id("incident_id", "comment_seq"))
    cut = with_segments(e, segment_size=100, max_bytes=4000, fine=4)
    held = {(r["incident_id"], r["_seg"]): r for r in cut.groupBy("incident_id", "_seg").agg(
        F.sum(F.octet_length("comment")).alias("b"), F.min("comment_seq").alias("lo"), F.max("comment_seq").alias("hi")).collect()}
    assert max(r["b"] for k, r in held.items() if k[0] == "LONG") <= 4000 + 4 * 400
    assert sum(k[0] == "SHORT" for k in held) == 2 and sum(k[0] == "LONG" for k in held) >= 14
    spans = sorted((r["lo"], r["hi"], k[1]) for k, r in held.items() if k[0] == "LONG")
    assert all(a[1] < b[0] and a[2] < b[2] for a, b in zip(spans, spans[1:]))  # ascending with seq
    types, aliases = types_df(spark, TYPES), aliases_df(spark, [])
    a = entry_lifecycle(cut.filter("incident_id is not null"), types, aliases, parts=True)
    b = entry_lifecycle(e.filter("incident_id is not null"), types, aliases, parts=True)
    assert sorted(map(str, a.drop(*PART_COLUMNS).collect())) == sorted(map(str, b.drop(*PART_COLUMNS).collect()))
    cal = fiscal_calendar(cases_df(spark, [{"incident_id": "LONG", "registered_date": "2024-01-01"}]), EVENTS_AS_OF)
    for made in (daily_counts, monthly_from_intervals):
        assert sorted(map(str, made(a, cal, EVENTS_AS_OF).collect())) == sorted(map(str, made(b, cal, EVENTS_AS_OF).collect()))


def test_days_of_falling_cases_are_made_after_the_sums(spark, monkeypatch):
    """A case whose dates fall is summed by stretches: the rows that are sorted follow
    the entries, not the days, and the days are those of the plain computation."""
    import datetime as dt
    from casetrail.operators import spine
    from helpers import TYPES, aliases_df, entries_df, types_df
    rows = [("F", i, "stranger", "u", d, "t") for i, d in enumerate(
        ["2001-01-05", "2003-02-01", "2001-06-30", "2001-01-05", "2006-05-01"])]
    e = entries_df(spark, rows).withColumn("comment_id", entry_id("incident_id", "comment_seq"))
    parts = entry_lifecycle(e, types_df(spark, TYPES), aliases_df(spark, []), parts=True)
    assert not parts.filter("_chain or _split").count()
    cal, as_of = fiscal_calendar(cases_df(spark, [{"incident_id": "F", "registered_date": "2001-01-05"}]), dt.date(2008, 3, 1)), dt.date(2008, 3, 1)
    summed, rolled = [], spine.rolled
    monkeypatch.setattr(spine, "rolled", lambda rows, *a, **k: summed.append(rows) or rolled(rows, *a, **k))
    days = spine.daily_counts(parts, cal, as_of)
    assert days.count() > 1500 and sum(r.count() for r in summed) < 100
    monkeypatch.undo()
    plain = daily_counts(parts.select(*LIFECYCLE_COLUMNS), cal, as_of)
    assert sorted(map(str, days.collect())) == sorted(map(str, plain.collect()))


def test_months_of_falling_cases_are_made_after_sums_and_join(spark, monkeypatch):
    """What is summed and joined follows the entries, not the months; the months and
    their days are those of the daily table."""
    import datetime as dt
    from casetrail.operators import marts, monthly
    from casetrail.operators.rollup import case_rollup
    from helpers import TYPES, aliases_df, entries_df, members_df, types_df
    rows = [("F", i, "register" if i % 2 else "answer", "u", d, "t") for i, d in enumerate(
        ["2001-01-05", "2003-02-01", "2001-06-30", "2001-01-05", "2006-05-01", "2006-05-01", "2002-02-11"])]
    e = entries_df(spark, rows).withColumn("comment_id", entry_id("incident_id", "comment_seq"))
    types, aliases, as_of = types_df(spark, TYPES), aliases_df(spark, []), dt.date(2008, 3, 15)
    parts = entry_lifecycle(e, types, aliases, parts=True)
    cases = cases_df(spark, [{"incident_id": "F", "registered_date": "2001-01-05"}]).withColumn("has_library_change", F.lit(False))
    cal = fiscal_calendar(cases, as_of)
    summed, rolled = [], monthly.rolled
    monkeypatch.setattr(monthly, "rolled", lambda rows, *a, **k: summed.append(rows) or rolled(rows, *a, **k))
    stretches = monthly.monthly_stretches(parts, cal, as_of)
    assert sum(r.count() for r in summed) < 60 and stretches.count() < 30
    plain = monthly_counts(daily_counts(parts.select(*LIFECYCLE_COLUMNS), cal, as_of), as_of)
    assert plain.count() > 80
    assert sorted(map(str, monthly_from_intervals(parts, cal, as_of).collect())) == sorted(map(str, plain.collect()))
    rollup = case_rollup(cases, parts, aliases, members_df(spark, ["u"]), types)
    got, want = (marts.mart_monthly(m, rollup, as_of, 4) for m in (stretches, plain))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 40
