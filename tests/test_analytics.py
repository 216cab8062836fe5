"""Analytics against NumPy and against the literal SQL shapes."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from pasture.operators import stats as ST
from pasture.plans import analytics as A


def test_ols_matches_numpy_and_exact_fit(spark):
    rng = np.random.default_rng(7)
    X = rng.normal(size=(40, 3))
    y = 2.0 + X @ np.array([1.5, -0.5, 0.25]) + rng.normal(scale=0.1, size=40)
    rows = [("a", float(yy), *map(float, xx)) for yy, xx in zip(y, X)]
    rows += [("exact", 1.0 + 2 * i, float(i), float(i % 3), 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, y double, x1 double, x2 double, x3 double")
    fit = {r["g"]: r for r in ST.ols_fit(df, "y", ["x1", "x2", "x3"], ["g"]).collect()}
    A1 = np.c_[np.ones(40), X]
    coef = np.linalg.lstsq(A1, y, rcond=None)[0]
    assert np.allclose([fit["a"]["intercept"], fit["a"]["b_x1"], fit["a"]["b_x2"], fit["a"]["b_x3"]], coef, atol=1e-8)
    assert abs(fit["exact"]["r2"] - 1.0) < 1e-9 and abs(fit["exact"]["b_x1"] - 2.0) < 1e-9


def test_ols_rank_deficient_min_norm(spark):
    rows = [("d", 1.0, 1.0, 2.0), ("d", 2.0, 2.0, 4.0), ("d", 4.0, 3.0, 6.0)]     # x2 = 2·x1
    df = spark.createDataFrame(rows, "g string, y double, x1 double, x2 double")
    r = ST.ols_fit(df, "y", ["x1", "x2"], ["g"]).first()
    X = np.array([[1, 2], [2, 4], [3, 6]], float)
    Xc = X - X.mean(0)
    yc = np.array([1, 2, 4.0]) - 7 / 3
    b = np.linalg.pinv(Xc) @ yc
    assert np.allclose([r["b_x1"], r["b_x2"]], b, atol=1e-9)


def test_trend_slope_matches_polyfit(spark):
    rows = [("d", dt.date(2024, 1, i + 1), 3.0 * i + (i % 2), 5.0) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, d date, f double, c double")
    r = ST.trend_slopes(df, ["g"], "d", ["f", "c"], 7, digits=None).first()
    ys = np.array([3.0 * i + (i % 2) for i in range(3, 10)])
    assert abs(r["f"] - np.polyfit(np.arange(7), ys, 1)[0]) < 1e-9 and r["c"] == 0.0 and r["n"] == 7


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 8.3, 5.0)],
                               "a double, b double, c double")
    got = {(r["feature_x"], r["feature_y"]): (r["r"], r["n"]) for r in ST.correlation_long(df, ["a", "b", "c"]).collect()}
    assert got[("a", "c")][0] is None and got[("a", "b")][1] == 3
    assert abs(got[("a", "b")][0] - np.corrcoef([1, 2, 4], [2, 4.1, 8.3])[0, 1]) < 1e-6


def test_fanout_frame_equals_literal_join(spark):
    prod = spark.createDataFrame([(dt.date(2024, 1, 5), 20.0, 30.0, 1.0, 400, 100), (dt.date(2024, 1, 6), 21.0, None, 1.1, 410, 101)],
                                 "production_date date, day_production_per_cow_kg double, fed_per_cow_total_kg double, "
                                 "feed_efficiency double, rumination_minutes int, average_lactation_days int")
    hourly = spark.createDataFrame([(1, dt.datetime(2024, 1, 5, 1), 2.0), (1, dt.datetime(2024, 1, 5, 2), 3.0),
                                    (9, dt.datetime(2024, 1, 5, 3), 7.0)], "device_id long, ts timestamp_ntz, energy_kwh double")
    device = spark.createDataFrame([(1, "fan")], "id long, alias string")
    env = spark.createDataFrame([(dt.datetime(2024, 1, 5, 1), 10.0, 50.0), (dt.datetime(2024, 1, 5, 2), 10.0, 50.0),
                                 (dt.datetime(2024, 1, 5, 3), 11.0, 50.0)], "timestamp timestamp_ntz, temperature double, humidity double")
    got = sorted((r["date"], r["total_device_kwh"]) for r in A.milk_frame(prod, hourly, device, env).collect())
    for n, d in (("p", prod), ("h", hourly), ("d", device), ("e", env)):
        d.createOrReplaceTempView(n)
    lit = spark.sql("""
      SELECT p.production_date AS date, SUM(CASE WHEN d.alias IS NOT NULL THEN h.energy_kwh ELSE 0 END) AS total_device_kwh
      FROM p LEFT JOIN h ON to_date(h.ts) = p.production_date LEFT JOIN d ON d.id = h.device_id
             LEFT JOIN e ON to_date(e.timestamp) = p.production_date
      GROUP BY p.production_date, e.temperature, e.humidity""")
    assert got == sorted((r[0], r[1]) for r in lit.collect())
    assert (dt.date(2024, 1, 5), 10.0) in got and (dt.date(2024, 1, 5), 5.0) in got   # ×2 and ×1
    plan = A.milk_frame(prod, hourly, device, env)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_forecast_dispatch(spark):
    rows = [("dev", dt.date(2024, 1, 1) + dt.timedelta(days=i), 20.0 + 0.1 * i, 5.0 + i, 30.0 + (i % 3), 1.0 + 0.01 * i,
             400 + i, 100 + 2 * i) for i in range(12)]
    df = spark.createDataFrame(rows, "device_alias string, date date, day_production_per_cow_kg double, device_kwh double, "
                                     "fed_per_cow_total_kg double, feed_efficiency double, rumination_minutes int, "
                                     "average_lactation_days int").withColumn("day_of_year", F.dayofyear("date"))
    coefs = A.ols_per_device(df)
    assert A.forecast(df, coefs, "approach_1").count() == 7
    assert A.forecast(df, coefs, "approach_3").count() == 21
    assert A.forecast(df, coefs, "approach_4").count() == 7
    assert A.forecast(df, coefs, "approach_2") is None
    fit = A.last7_fit(df, coefs).collect()
    assert len(fit) == 7 and all(abs(r["actual"] - r["predicted"]) < 1e-6 for r in fit)   # exact linear data
