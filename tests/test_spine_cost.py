"""What a row of the daily table costs: texts and stretches are made once, not per row."""
import datetime as dt

from pyspark.sql import functions as F

from casetrail.functions.keys import entry_id, padded
from casetrail.operators.calendar import fiscal_calendar
from casetrail.operators.lifecycle import LIFECYCLE_COLUMNS, entry_lifecycle
from casetrail.operators.monthly import monthly_counts, monthly_from_intervals
from casetrail.operators.spine import daily_counts
from casetrail.plans.adapters import order_inputs
from helpers import TYPES, aliases_df, cases_df, entries_df, types_df
from test_plans import physical, walk

AS_OF = dt.date(1972, 3, 1)
# F falls, R rises, N has an entry without a date; days on both sides of 1970
ROWS = ([("F", i, "stranger", "u", d, "t") for i, d in enumerate(
            ["1968-12-30", "1970-01-01", "1969-02-27", "1968-12-30", "1971-05-01", "1969-12-31"])]
        + [("R", i, "answer", "u", d, "t") for i, d in enumerate(["1969-12-31", "1969-12-31", "1970-01-01", "1971-03-04"])]
        + [("N", 0, "register", "u", "1969-06-01", "t"), ("N", 1, "answer", "u", None, "t"), ("N", 2, "close", "u", "1969-05-01", "t")]
        + [(None, 0, "answer", "u", "1970-01-05", "t"), (None, 1, "answer", "u", "1969-01-05", "t")])


def made(spark):
    e = entries_df(spark, ROWS).withColumn("comment_id", entry_id("incident_id", "comment_seq"))
    parts = entry_lifecycle(e, types_df(spark, TYPES), aliases_df(spark, []), parts=True)
    return parts, fiscal_calendar(cases_df(spark, [{"incident_id": "F", "registered_date": "1968-12-30"}]), AS_OF)


def test_days_and_months_around_1970_match_the_plain_ones(spark):
    parts, cal = made(spark)
    assert parts.filter("not _chain and not _split").count() and parts.filter("_chain").count()
    plain = daily_counts(parts.select(*LIFECYCLE_COLUMNS), cal, AS_OF)
    days = daily_counts(parts, cal, AS_OF)
    assert sorted(map(str, days.collect())) == sorted(map(str, plain.collect())) and days.count() > 2000
    assert not days.filter(~F.col("daily_incident_id").eqNullSafe(F.concat(F.date_format("date_id", "yyyyMMdd"), F.lit("_"), "incident_id"))).count()
    assert sorted(map(str, monthly_from_intervals(parts, cal, AS_OF).collect())) == sorted(map(str, monthly_counts(plain, AS_OF).collect()))


def test_no_lambda_or_date_text_per_row(spark):
    """Expansions are compiled with their neighbours, the days' texts looked up, and a
    roll-up passes once over its groups."""
    parts, cal = made(spark)
    days, months = physical(daily_counts(parts, cal, AS_OF)), physical(monthly_from_intervals(parts, cal, AS_OF))
    for plan in (days, months):
        heads = [n.toString().split("\n")[0] for n, _ in walk(plan) if n.nodeName() == "Generate"]
        assert heads and not any("lambdafunction" in h for h in heads)
    assert not any("date_format" in h or "year(" in h for h in days.toString().split("\n")[:3])
    parts = parts.localCheckpoint()
    windows = [n for n, _ in walk(physical(daily_counts(parts, cal, AS_OF))) if n.nodeName() == "Window"]
    assert len(windows) == 3  # whole cases, segments of split ones, split ones


def test_numbers_are_padded_as_by_a_formatter(spark):
    numbers = [None, 0, 7, 9999, 10000, 999999, 1000000, 123456789012, -1, -12345]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    for width in (4, 6):
        for r in df.select("n", padded("n", width).alias("a"), F.format_string(f"%0{width}d", "n").alias("b")).collect():
            assert r["a"] == r["b"], r


def test_orders_are_grouped_once(spark, tmp_out):
    day = dt.datetime(1999, 5, 3)
    spark.createDataFrame([(i, [1, 2, None][i % 3], "F", "2-HIGH", day + dt.timedelta(days=i)) for i in range(9)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp") \
        .write.parquet(f"{tmp_out}/orders.parquet")
    spark.createDataFrame([(1, "a", 3, 1.0, "BUILDING"), (2, "b", 5, 1.0, "FURNITURE")],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string") \
        .write.parquet(f"{tmp_out}/customer.parquet")
    inp = order_inputs(spark, tmp_out)
    for df in (inp.cases, inp.cases_before, inp.cases_after, inp.entries_after):
        assert "o_orderdate" not in physical(df).toString()
    assert sorted(r["incident_id"] for r in inp.cases.collect()) == ["CU-  null", "CU-000001", "CU-000002"]
    assert {r["incident_id"] for r in inp.cases_after.collect()} == {"CU-000001", "CU-000002-B"}
