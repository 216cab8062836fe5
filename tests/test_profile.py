"""Dataset detection and time profile."""

import datetime as dt

from pyspark.sql import functions as F

from pasture.operators import profile as P


def test_detect_dataset(spark):
    hdrs = [["timestamp", "pm10 (µg/m³)"], ["Pressure hPa"], ["Date", "Nr. animals"], ["Day production/cow (kg)"],
            ["Date and Time", "Hourly"], ["Date and Time", "Daily"], ["Date and Time", "Hourly", "x"], ["a"]]
    df = spark.createDataFrame([(h,) for h in hdrs], "cols array<string>")
    got = [r[0] for r in df.select(P.detect_dataset(F.col("cols"))).collect()]
    assert got == ["environmental_metrics", "environmental_metrics", "dairy_production", "dairy_production",
                   "energy_hourly", "energy_daily", None, None]


def test_device_from_name(spark):
    df = spark.createDataFrame([("abcdef0123456789abcd-x.csv",), ("abc-x.csv",)], "n string")
    assert [r[0] for r in df.select(P.device_from_name(F.col("n"))).collect()] == ["abcdef0123456789abcd", None]
    assert P.time_column(["value", "Date and Time", "timestamp"]) == "Date and Time"


def _gran(spark, gaps):
    t0 = dt.datetime(2024, 1, 1)
    ts, cur = [t0], t0
    for g in gaps:
        cur = cur + dt.timedelta(seconds=g)
        ts.append(cur)
    df = spark.createDataFrame([("f", t) for t in ts], "f string, t timestamp_ntz")
    return P.time_profile(df, "f", "t").first()["granularity"]


def test_granularity_threshold(spark):
    assert _gran(spark, [7199] * 5) == "hourly"
    assert _gran(spark, [7200] * 5) == "daily"
    assert _gran(spark, []) == "daily"                        # single timestamp
    assert _gran(spark, [3600, 3600, 86400, 86400]) == "daily"   # even count: median = (3600+86400)/2
    assert _gran(spark, [3600, 3600, 3600, 86400]) == "hourly"
    assert _gran(spark, [0, 0, 86400]) == "hourly"           # duplicates are 0-second gaps
    assert _gran(spark, [7000, 7300]) == "hourly"             # median (7000+7300)/2 = 7150
