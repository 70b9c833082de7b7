"""Scalar cleaning functions on the edge rows of FIXTURES.md set A."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import text_df
from tillstar.functions import amounts as A
from tillstar.functions import clean as C
from tillstar.functions import dates as D


def one_col(spark, values, expr):
    df = text_df(spark, ["x"], [(v,) for v in values]).withColumn("_i", F.monotonically_increasing_id())
    return [r[0] for r in df.orderBy("_i").select(expr.alias("y")).collect()]


def test_opt_int(spark):
    assert one_col(spark, [" 42 ", "", "  ", None, "x"], C.opt_int("x")) == [42, None, None, None, None]


def test_int_or_zero(spark):
    assert one_col(spark, ["", "99"], C.int_or_zero("x")) == [0, 99]


def test_nonneg_int(spark):
    assert one_col(spark, ["30", "", "-5"], C.nonneg_int("x")) == [30, 0, 0]


def test_to_decimal_rounds_and_overflows(spark):
    assert one_col(spark, ["10.005", "99999999999.5"], C.to_decimal("x", 10, 2)) == [Decimal("10.01"), None]


def test_nonneg_decimal(spark):
    got = one_col(spark, ["1.23456", "", None, "-1.5", "0.5"], C.nonneg_decimal("x"))
    assert got == [Decimal("1.2346"), Decimal("0.0000"), Decimal("0.0000"), Decimal("0.0000"), Decimal("0.5000")]


def test_to_date_dmy(spark):
    got = one_col(spark, ["01-03-2024", "1-3-2024", "31-02-2024", "", "2024-03-01"], D.to_date_dmy("x"))
    assert got == [dt.date(2024, 3, 1), dt.date(2024, 3, 1), None, None, None]


def test_to_datetime_dmy(spark):
    got = one_col(spark, ["01-03-2024 08:05", "bad"], D.to_datetime_dmy("x"))
    assert got == [dt.datetime(2024, 3, 1, 8, 5), None]


def test_online_city(spark):
    assert one_col(spark, [" 9999 ", " Lviv "], C.online_city("x")) == ["Online", "Lviv"]


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),)], "d date")
    r = df.select(D.date_key("d"), D.day_of_week_num("d"), D.day_name("d"), F.month("d"),
                  D.month_name("d"), F.quarter("d"), F.year("d")).first()
    assert tuple(r) == (20230101, 1, "Sunday", 1, "January", 1, 2023)


def test_changed_null_and_blank_equal(spark):
    df = spark.createDataFrame([("", None), (None, None), ("A", None), ("A", "A")], "a string, b string")
    got = [r[0] for r in df.select(C.changed("a", "b")).collect()]
    assert got == [False, False, True, False]


def test_changed_with_collation(spark):
    df = spark.createDataFrame([("Kyiv", "kyiv "), ("Kyiv", "Lviv")], "a string, b string")
    got = [r[0] for r in df.select(C.changed("a", "b", "UNICODE_CI_AI_RTRIM")).collect()]
    assert got == [False, True]


def test_line_amounts_and_clamp(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("3"), 15), (Decimal("1.00"), Decimal("1"), 50)],
                               "p decimal(18,4), q decimal(18,4), pct int")
    d = A.discount_amount("p", "q", "pct")
    rows = df.select(d.alias("d"), A.line_total("p", "q", d).alias("t"),
                     A.line_total("p", "q", F.lit(Decimal("5.00"))).alias("over")).collect()
    assert rows[0]["d"] == Decimal("4.50") and rows[0]["t"] == Decimal("25.50")
    assert rows[1]["over"] == Decimal("0.00")


def test_fmt(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 1, 8, 5), Decimal("3.5"))], "ts timestamp_ntz, v decimal(18,4)")
    r = df.select(D.fmt_dmy_hm("ts"), D.fmt_dmy(D.to_day("ts")), C.fmt2("v")).first()
    assert tuple(r) == ("01-03-2024 08:05", "01-03-2024", "3.50")


def test_active_on(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 31))], "s date, e date")
    assert df.select(D.active_on("s", "e", dt.date(2024, 1, 31))).first()[0] is True
    assert df.select(D.active_on("s", "e", "2024-02-01")).first()[0] is False


def test_strict_cast_raises(spark):
    import pytest

    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        pytest.skip("strict casts raise only in ANSI mode")
    df = text_df(spark, ["x"], [("12",), ("x",)])
    with pytest.raises(Exception):
        df.select(C.to_int("x", on_error="fail")).collect()
    assert df.where("x = '12'").select(C.to_int("x", on_error="fail")).first()[0] == 12


def test_to_flag(spark):
    assert one_col(spark, ["1", "0", " 1 ", "", None, "x"], C.to_flag("x")) == [True, False, True, None, None, None]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,)], "v double")
    assert [r[0] for r in df.select(C.nan_to_null("v")).collect()] == [None, 1.5]


def test_nan_to_null_passes_other_types(spark):
    row = spark.sql("SELECT DATE'2024-01-02' AS d, 'NaN' AS s, 3 AS i, CAST('NaN' AS FLOAT) AS f")
    got = row.select(*[C.nan_to_null(c).alias(c) for c in row.columns]).first()
    assert (str(got.d), got.s, got.i, got.f) == ("2024-01-02", "NaN", 3, None)


def test_flag_is_true_for_one_only(spark):
    df = text_df(spark, ["v"], [("1",), ("0",), ("2",), (" ",), (None,)])
    assert [r[0] for r in df.select(C.to_flag("v")).collect()] == [True, False, False, None, None]


def test_datetime_is_read_without_a_zone(spark):
    from tillstar.functions import dates as D

    df = text_df(spark, ["v"], [("31-03-2024 03:30",), ("1-2-2024 7:05",), ("01-02-2024 24:00",), ("31-02-2024 10:00",), ("x",), (None,)])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Kyiv")
    try:
        got = [str(r[0]) for r in df.select(D.to_datetime_dmy("v").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2024-03-31 03:30:00", "2024-02-01 07:05:00", "None", "None", "None", "None"]
