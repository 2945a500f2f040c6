"""Scalar column functions (ports of the reference's unit cases plus trap cases)."""
import datetime as dt

from pyspark.sql import functions as F

from spendlake.functions import (api_date, day_name_pt, days_between, month_name_pt, next_quarter,
                                 only_digits, parse_bool, parse_num, parse_ts, person_type, quarter_label,
                                 weekday_monday0, year_month)


def one(spark, expr, schema="s string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_only_digits_documents(spark):
    df = spark.createDataFrame([("123.456.789-00",), ("12.345.678/0001-90",), (None,), ("NaN",), ("abc",)], "s string")
    got = [r["d"] for r in df.select(only_digits("s").alias("d")).collect()]
    assert got == ["12345678900", "12345678000190", None, None, None]


def test_only_digits_ascii_only(spark):
    # Arabic-Indic digits are not kept (ASCII digits only)
    assert one(spark, only_digits("s"), value="١٢3") == "3"


def test_api_date(spark):
    assert one(spark, api_date(F.col("s")), value="2026-01-05") == "05/01/2026"


def test_parse_ts_drops_offset_keeps_wall_clock(spark):
    df = spark.createDataFrame([("2026-01-10T00:00:00.000-03:00",), ("2026-01-10 00:00:00.000",),
                                ("05/03/2026",), ("garbage",), (None,)], "s string")
    got = [r["t"] for r in df.select(parse_ts("s").alias("t")).collect()]
    assert got[0] == got[1] == dt.datetime(2026, 1, 10)
    assert got[2] == dt.datetime(2026, 5, 3)       # month first
    assert got[3] is None and got[4] is None


def test_parse_num(spark):
    df = spark.createDataFrame([("1000.50",), ("abc",), (None,), ("NaN",)], "s string")
    assert [r["v"] for r in df.select(parse_num("s").alias("v")).collect()] == [1000.5, 0.0, 0.0, 0.0]


def test_parse_bool_false_text_is_false(spark):
    df = spark.createDataFrame([("false",), ("true",), (None,), ("x",)], "s string")
    assert [r["b"] for r in df.select(parse_bool("s").alias("b")).collect()] == [False, True, False, False]


def test_days_between_floors(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 2, 12), dt.datetime(2026, 1, 1)),
                                (dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2, 12))], "a timestamp_ntz, b timestamp_ntz")
    got = [r["d"] for r in df.select(days_between("a", "b").alias("d")).collect()]
    assert got == [1, -2]


def test_calendar_attributes(spark):
    d = spark.createDataFrame([(dt.date(2026, 1, 5),)], "d date")
    r = d.select(weekday_monday0("d").alias("w"), day_name_pt("d").alias("n"), month_name_pt("d").alias("m"),
                 year_month("d").alias("ym")).first()
    assert (r["w"], r["n"], r["m"], r["ym"]) == (0, "segunda", "janeiro", "2026-01")


def test_next_quarter(spark):
    y, q = next_quarter(dt.date(2026, 11, 30))
    r = spark.range(1).select(y.alias("y"), q.alias("q"), quarter_label(y, q).alias("l")).first()
    assert (r["y"], r["q"], r["l"]) == (2027, 1, "2027-Q1")
    y, q = next_quarter("2026-07-23")
    assert spark.range(1).select(quarter_label(y, q)).first()[0] == "2026-Q4"


def test_person_type(spark):
    df = spark.createDataFrame([("12345678000190",), ("12345678900",)], "s string")
    assert [r[0] for r in df.select(person_type("s")).collect()] == ["PJ", "PF"]
