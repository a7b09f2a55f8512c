import datetime as dt

from pyspark.sql import functions as F

from dialtone.functions.fmt import hms, int_div, pct_int, round_avg_to_long
from dialtone.functions.timefx import date_bounds, local_date, local_hour


def _one(spark, col, schema="x bigint", rows=None):
    rows = rows or [(1,)]
    return spark.createDataFrame(rows, schema).select(col.alias("r")).collect()


def test_hms_cases(spark):
    cases = {0: "00:00:00", 59: "00:00:59", 3661: "01:01:01", 90000: "25:00:00",
             400000: "111:06:40", -30: "00:00:-30", -3600: "-01:00:00",
             -3661: "-01:-01:-01", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "x bigint")
    got = {r.x: r.h for r in df.select("x", hms(F.col("x")).alias("h")).collect()}
    assert got == cases


def test_int_div_truncates_and_guards_zero(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (5, 0), (None, 3)], "a bigint, b bigint")
    got = [r.q for r in df.select(int_div(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got == [3, -3, None, None]


def test_pct_int(spark):
    df = spark.createDataFrame([(1, 3), (2, None), (3, 3)], "a bigint, b bigint")
    assert [r.p for r in df.select(pct_int(F.col("a"), F.col("b")).alias("p")).collect()] == [33, None, 100]


def test_round_avg_half_away_from_zero(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (5, 4), (1, 0)], "t bigint, n bigint")
    got = [r.v for r in df.select(round_avg_to_long(F.col("t"), F.col("n")).alias("v")).collect()]
    assert got == [4, -4, 1, None]


def test_local_day_crosses_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 18, 29, 59),), (dt.datetime(2024, 1, 1, 18, 30),)],
                               "ts timestamp_ntz")
    got = df.select(local_date("ts").alias("d"), local_hour("ts").alias("h")).collect()
    assert [(r.d, r.h) for r in got] == [(dt.date(2024, 1, 1), 23), (dt.date(2024, 1, 2), 0)]


def test_date_bounds_drop_time_of_day():
    assert date_bounds("2024-01-05 10:00:00", "2024-01-12 00:00:00") == (
        dt.date(2024, 1, 5), dt.date(2024, 1, 12))
