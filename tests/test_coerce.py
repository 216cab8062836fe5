"""Scalar coercions against the table-driven cases of FIXTURES.md §2."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pasture.functions import coerce as C


def run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    return [r[0] for r in df.select(fn(F.col("raw"))).collect()]


def test_european_float(spark):
    got = run(spark, C.european_float, ["1,5", " 2.0 ", "", None, "1,234", "1.234,56", "abc", "1e3", ".5", "1.", "1_0", "1.5d"])
    assert got[:5] == [1.5, 2.0, None, None, 1.234]
    assert got[5] is None and got[6] is None
    assert got[7:10] == [1000.0, 0.5, 1.0]
    assert got[10] is None and got[11] is None          # Python accepts 1_0, rejected on purpose; Spark-only 1.5d rejected
    nan = run(spark, C.european_float, ["nan", "inf", "-Infinity"])
    assert math.isnan(nan[0]) and nan[1] == math.inf and nan[2] == -math.inf


def test_european_float_invalid_flag(spark):
    assert run(spark, C.european_float_invalid, ["1,5", "", None, "x", "1.234,56"]) == [False, False, False, True, True]


def test_datetime_ampm(spark):
    got = run(spark, C.datetime_ampm, ["12/25/2024 10:30:00 AM", "12/25/2024 12:00:00 AM", "1/5/2024 1:02:03 pm",
                                       "2024-01-05", "20240105", "2024", "2024-1-5", "T10:00",
                                       "2024-01-05T13:00:00", "2024-01-05 13:00:00.5", "2024-01-05T10:00:00+02:00"])
    assert got[0] == dt.datetime(2024, 12, 25, 10, 30)
    assert got[1] == dt.datetime(2024, 12, 25, 0, 0)
    assert got[2] == dt.datetime(2024, 1, 5, 13, 2, 3)
    assert got[3] == dt.datetime(2024, 1, 5)
    assert got[4] == dt.datetime(2024, 1, 5)
    assert got[5:8] == [None, None, None]
    assert got[8] == dt.datetime(2024, 1, 5, 13)
    assert got[9] == dt.datetime(2024, 1, 5, 13, 0, 0, 500000)
    assert got[10] == dt.datetime(2024, 1, 5, 10)        # offset: wall time kept


def test_date_ampm(spark):
    got = run(spark, C.date_ampm, ["12/25/2024 13:00:00 PM", "2024-12-25T23:59:59", "12/25/2024 25:00:00 PM", "x"])
    assert got == [dt.date(2024, 12, 25), dt.date(2024, 12, 25), None, None]


def test_int_from_float(spark):
    got = run(spark, C.int_from_float, ["123.0", "12.7", "-1.9", "", "x", None, "nan", "inf"])
    assert got == [123, 12, -1, None, None, None, None, None]
    assert run(spark, C.int_from_float_invalid, ["x", "", "nan", "3"]) == [True, False, True, False]


def test_bool_text(spark):
    got = run(spark, C.bool_text, ["YES", "1", "true", "y", "No", "0", "n", "false", "maybe"])
    assert got == [True] * 4 + [False] * 4 + [None]


def test_time_text(spark):
    assert run(spark, C.time_text, ["23:59:59", "24:00:00", "7:5:9", "1:2"]) == [86399, None, 25509, None]


def test_uuid_and_source_type(spark):
    u = run(spark, C.uuid_text, ["{12345678-1234-1234-1234-1234567890AB}", "12345678123412341234123456789abc", "x"])
    assert u == ["12345678-1234-1234-1234-1234567890ab", "12345678-1234-1234-1234-123456789abc", None]
    assert run(spark, C.source_type, ["csv", "api", "excel", "ftp", None]) == ["csv", "api", "excel", "unknown", "unknown"]


def test_iso_and_numeric_text(spark):
    assert run(spark, C.iso_date, ["2024-01-05", "2024-13-01"]) == [dt.date(2024, 1, 5), None]
    assert run(spark, C.int_text, [" 12 ", "1.5", "-3"]) == [12, None, -3]
    assert run(spark, C.float_text, ["1,5", "2.5"]) == [None, 2.5]


@pytest.mark.parametrize("pattern,value,ok", [(r"\d{3}", "123abc", True), (r"\d{3}", "a123", False)])
def test_pattern_anchored_at_start(spark, pattern, value, ok):
    from pasture.operators.rules import FieldRule, field_errors, _typed
    df = spark.createDataFrame([(value,)], "raw string")
    rule = FieldRule("raw", type="str", pattern=pattern)
    v, bad, blank = _typed(rule, F.col("raw"))
    errs = df.select(field_errors(rule, F.col("raw"), v, bad, blank)).first()[0]
    assert (len(errs) == 0) == ok
