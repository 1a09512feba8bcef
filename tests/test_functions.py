import datetime as dt

from pyspark.sql import functions as F

from casetrail.functions import dates as DT
from casetrail.functions import keys as K
from casetrail.functions import text as TX


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_try_date_forms_and_failures(spark):
    df = spark.createDataFrame([("2024/1/17",), ("yyyy/mm/dd",), ("2024/2/30",), ("2024-01-17",),
                                (None,), ("r 2023/1/5",), ("2023/10/10",)], "s string")
    got = [r[0] for r in df.select(DT.try_date("s")).collect()]
    assert got == [dt.date(2024, 1, 17), None, None, dt.date(2024, 1, 17), None, None, dt.date(2023, 10, 10)]


def test_fiscal_edges(spark):
    rows = spark.createDataFrame([(dt.date(2025, 3, 31),), (dt.date(2025, 4, 1),), (dt.date(2024, 12, 31),)], "d date")
    got = rows.select(DT.fiscal_year("d"), DT.fiscal_quarter("d"), DT.fiscal_year_start("d"),
                      DT.calendar_end("d"), DT.first_date_of_fiscal_scope(F.col("d"), 2)).collect()
    assert [tuple(r) for r in got] == [
        (2024, 4, dt.date(2024, 4, 1), dt.date(2026, 3, 31), dt.date(2023, 4, 1)),
        (2025, 1, dt.date(2025, 4, 1), dt.date(2027, 3, 31), dt.date(2024, 4, 1)),
        (2024, 3, dt.date(2024, 4, 1), dt.date(2026, 3, 31), dt.date(2023, 4, 1)),
    ]
    assert DT.fiscal_scope_start(dt.date(2026, 12, 3), 2) == dt.date(2025, 4, 1)
    assert DT.fiscal_scope_start(dt.date(2026, 3, 3), 2) == dt.date(2024, 4, 1)


def test_month_clamp_and_weekday(spark):
    assert one(spark, F.add_months(F.lit(dt.date(2025, 5, 31)), -3)) == dt.date(2025, 2, 28)
    assert one(spark, DT.weekday_jp(F.lit(dt.date(2024, 1, 7)))) == "日"  # a Sunday
    assert one(spark, DT.weekday_jp(F.lit(dt.date(2024, 1, 13)))) == "土"
    assert one(spark, DT.month_end(F.lit(dt.date(2024, 2, 10)))) == dt.date(2024, 2, 29)


def test_keys(spark):
    assert one(spark, K.seq4(F.lit(7))) == "0007"
    assert one(spark, K.seq4(F.lit(12345))) == "12345"   # widened, never truncated
    assert one(spark, K.entry_id(F.lit("I001"), F.lit(None).cast("int"))) is None
    assert one(spark, K.joined(F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, K.case_id("SMPL", F.lit(3))) == "SMPL-000003"


def test_parse_meta_user_with_paren(spark):
    r = one(spark, TX.parse_meta(F.lit("sent on to the lab (x).(Request:Lab (north)) Ito 2021/12/31)")))
    assert (r["date"], r["type"], r["user"], r["text"]) == ("2021/12/31", "Request", "Lab (north)) Ito", "sent on to the lab (x).")


def test_parse_meta_short_date_cut_at_ten(spark):
    r = one(spark, TX.parse_meta(F.lit("done(Close:User 2023/1/5)")))
    assert r["date"] == "r 2023/1/5"
    assert r["user"] == "Us"
    assert r["text"] == "done"
    assert one(spark, TX.parse_meta(F.lit("no meta here"))) is None


def test_force_close_patterns_cross_newline(spark):
    announce = "その後の状況について\nご連絡がなければクローズします"
    force = "ご連絡がなかったため\nクローズします。新規QA登録をお願いします"
    df = spark.createDataFrame([(announce,), (force,), ("普通のコメント",), (None,)], "c string")
    got = [tuple(r) for r in df.select(TX.is_force_close_announce("c"), TX.is_force_close("c")).collect()]
    assert got == [(True, False), (False, True), (False, False), (False, False)]


def test_library_change_needs_both_markers(spark):
    both = TX.LIBRARY_MARK + "\n" + TX.LIBRARY_PHRASE
    df = spark.createDataFrame([(both,), (TX.LIBRARY_PHRASE,), (None,)], "d string")
    assert [r[0] for r in df.select(TX.has_library_change("d")).collect()] == [True, False, False]
