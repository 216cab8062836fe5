"""Warehouse views and dashboard queries.

Each view is a function of DataFrames (and an ``as_of`` instant where the
reference uses ``NOW()``), so it can run over any snapshot.  Views return
*unsorted* frames: a view-level ORDER BY would cost a range shuffle for every
consumer; sorting is left to presentation, except for the top-k queries where
the order *is* the result (``orderBy().limit()`` → TakeOrderedAndProject).

``as_of`` may be a literal or a Column; when omitted it is the newest
timestamp of the table, computed in-plan as a scalar subquery (one tiny
aggregate, no driver round trip).
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from pasture.functions.numeric import avg_dec, epoch_micros, fixed, ratio_units, round_dec
from pasture.operators.joins import join_dimension

AsOf = Column | _dt.datetime | _dt.date | str | None


def _as_of(df: DataFrame, ts_col: str, as_of: AsOf) -> Column:
    if as_of is None:
        return df.select(F.max(ts_col)).scalar()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz")


def _since(df: DataFrame, ts_col: str, as_of: AsOf, days: int = 0, hours: int = 0) -> Column:
    return F.col(ts_col) >= _as_of(df, ts_col, as_of) - F.make_dt_interval(F.lit(days), F.lit(hours))


# ---------------------------------------------------------------- energy (H1–H3)

def energy_hourly_view(fact: DataFrame, device: DataFrame) -> DataFrame:
    """H1 ``v_energy_hourly``: hourly fact ⋈ device, labelled 'hourly'."""
    d = device.select("id", "device_token", "client", "alias")
    j = join_dimension(fact.select("device_id", "ts", "energy_kwh"), d, F.col("device_id") == F.col("id"))
    return j.select("device_token", "client", "alias", "ts", "energy_kwh", F.lit("hourly").alias("granularity"))


def energy_daily_view(fact: DataFrame, device: DataFrame) -> DataFrame:
    """H2 ``v_energy_daily``: daily fact ⋈ device, day widened to a timestamp."""
    d = device.select("id", "device_token", "client", "alias")
    j = join_dimension(fact.select("device_id", "ts", "energy_kwh"), d, F.col("device_id") == F.col("id"))
    return j.select("device_token", "client", "alias", F.col("ts").cast("timestamp_ntz").alias("ts"),
                    "energy_kwh", F.lit("daily").alias("granularity"))


def energy_monthly(fact: DataFrame, device: DataFrame) -> DataFrame:
    """H3 ``v_energy_monthly``: kWh and row count per device and month.

    Aggregated *before* the join (device id is the dimension's key, so the
    grouping is the same): the join then sees one row per device-month instead
    of every reading.
    """
    m = (fact.groupBy("device_id", F.trunc("ts", "MM").alias("month"))
             .agg(F.sum("energy_kwh").alias("total_energy_kwh"), F.count(F.lit(1)).alias("data_points")))
    d = device.select("id", "device_token", "client", "alias")
    j = join_dimension(m, d, F.col("device_id") == F.col("id"))
    return j.select("device_token", "client", "alias", "month", "total_energy_kwh", "data_points")


# ---------------------------------------------------------------- dairy (H4–H6)

def production_daily(dp: DataFrame) -> DataFrame:
    """H4 ``v_dairy_production_daily``: total production and guarded efficiency ratio."""
    prod, fed = F.col("day_production_per_cow_kg"), F.col("fed_per_cow_total_kg")
    ratio = ratio_units((prod * 100).cast("long"), (fed * 100).cast("long"), 4)
    return dp.select(
        "production_date", "day_production_per_cow_kg", "number_of_animals", "average_lactation_days",
        "fed_per_cow_total_kg", "fed_per_cow_water_kg", "feed_efficiency", "rumination_minutes",
        (prod * F.col("number_of_animals")).cast("decimal(18,2)").alias("total_daily_production_kg"),
        F.when(fed > 0, fixed(ratio, 4)).alias("calculated_feed_efficiency"),
    )


def feed_efficiency(dp: DataFrame) -> DataFrame:
    """H5 ``v_feed_efficiency_analysis``: rows with a positive feed efficiency."""
    return dp.filter(F.col("feed_efficiency") > 0).select(
        "production_date", "feed_efficiency", "fed_per_cow_total_kg", "day_production_per_cow_kg",
        "rumination_minutes", "number_of_animals", "average_lactation_days")


def production_monthly(dp: DataFrame) -> DataFrame:
    """H6 ``v_production_summary``: monthly averages with the view's roundings."""
    prod = F.col("day_production_per_cow_kg")
    return dp.groupBy(F.trunc("production_date", "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("days_recorded"),
        avg_dec(prod, 2, 2).alias("avg_production_per_cow_kg"),
        round_dec(F.max(prod), 2).alias("max_production_per_cow_kg"),
        round_dec(F.min(prod), 2).alias("min_production_per_cow_kg"),
        avg_dec(F.col("number_of_animals"), 0, 0).alias("avg_animals"),
        avg_dec(F.col("average_lactation_days"), 0, 1).alias("avg_lactation_days"),
        avg_dec(F.col("feed_efficiency"), 4, 4).alias("avg_feed_efficiency"),
        avg_dec(F.col("rumination_minutes"), 0, 1).alias("avg_rumination_minutes"),
    )


# ---------------------------------------------------------------- environment (H7–H9)

def env_daily(env: DataFrame) -> DataFrame:
    """H7 ``v_environmental_metrics_daily``: 15 rounded aggregates + count per day."""
    c = F.col
    return env.groupBy(F.to_date("timestamp").alias("measurement_date")).agg(
        avg_dec(c("atm_pressure"), 2, 2).alias("avg_atm_pressure"),
        round_dec(F.min("atm_pressure"), 2).alias("min_atm_pressure"),
        round_dec(F.max("atm_pressure"), 2).alias("max_atm_pressure"),
        avg_dec(c("noise_level_db"), 2, 2).alias("avg_noise_level_db"),
        round_dec(F.max("noise_level_db"), 2).alias("max_noise_level_db"),
        avg_dec(c("temperature"), 2, 2).alias("avg_temperature"),
        round_dec(F.min("temperature"), 2).alias("min_temperature"),
        round_dec(F.max("temperature"), 2).alias("max_temperature"),
        avg_dec(c("humidity"), 2, 2).alias("avg_humidity"),
        avg_dec(c("pm10"), 2, 2).alias("avg_pm10"),
        round_dec(F.max("pm10"), 2).alias("max_pm10"),
        avg_dec(c("wind_speed"), 2, 2).alias("avg_wind_speed"),
        round_dec(F.max("wind_speed"), 2).alias("max_wind_speed"),
        avg_dec(c("pm2p5"), 2, 2).alias("avg_pm2p5"),
        round_dec(F.max("pm2p5"), 2).alias("max_pm2p5"),
        F.count(F.lit(1)).alias("record_count"),
    )


# Air-quality band limits (inclusive upper bounds) of the view.
PM10_BANDS = ((40, "Good"), (80, "Fair"), (120, "Moderate"))
PM2P5_BANDS = ((12, "Good"), (35.4, "Moderate"))


def _band(c: Column, bands) -> Column:
    out = None
    for limit, label in bands:
        lim = F.lit(Decimal(str(limit)))
        out = F.when(c <= lim, label) if out is None else out.when(c <= lim, label)
    return out.otherwise("Poor")  # a NULL average also falls through to Poor


def air_quality(env: DataFrame) -> DataFrame:
    """H8 ``v_air_quality_analysis``: daily PM averages and quality bands."""
    g = env.groupBy(F.to_date("timestamp").alias("measurement_date")).agg(
        avg_dec(F.col("pm10"), 2, 2).alias("avg_pm10"),
        round_dec(F.max("pm10"), 2).alias("max_pm10"),
        avg_dec(F.col("pm2p5"), 2, 2).alias("avg_pm2p5"),
        round_dec(F.max("pm2p5"), 2).alias("max_pm2p5"),
    )
    return g.withColumns({
        "pm10_quality": _band(F.col("avg_pm10"), PM10_BANDS),
        "pm2p5_quality": _band(F.col("avg_pm2p5"), PM2P5_BANDS),
    })


def env_monthly(env: DataFrame) -> DataFrame:
    """H9 ``v_environmental_summary``: monthly count and 9 rounded aggregates."""
    c = F.col
    return env.groupBy(F.trunc(F.to_date("timestamp"), "MM").alias("month")).agg(
        F.count(F.lit(1)).alias("record_count"),
        avg_dec(c("atm_pressure"), 2, 2).alias("avg_atm_pressure"),
        avg_dec(c("noise_level_db"), 2, 2).alias("avg_noise_db"),
        avg_dec(c("temperature"), 2, 2).alias("avg_temperature"),
        avg_dec(c("humidity"), 2, 2).alias("avg_humidity"),
        avg_dec(c("pm10"), 2, 2).alias("avg_pm10"),
        round_dec(F.max("pm10"), 2).alias("max_pm10"),
        avg_dec(c("wind_speed"), 2, 2).alias("avg_wind_speed"),
        avg_dec(c("pm2p5"), 2, 2).alias("avg_pm2p5"),
        round_dec(F.max("pm2p5"), 2).alias("max_pm2p5"),
    )


# ---------------------------------------------------------------- operations

def _avg_seconds(micros: Column) -> Column:
    """Average of a microsecond duration, in seconds rounded to the microsecond."""
    return ratio_units(F.sum(micros), F.count(micros), 0) / F.lit(1e6)


def pipeline_health(pe: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """H10 ``v_pipeline_health``: executions of the last ``days`` by pipeline, stage, status."""
    dur = epoch_micros(F.col("completed_at"), F.col("started_at"))
    return (pe.filter(_since(pe, "started_at", as_of, days=days))
              .groupBy("pipeline_name", "stage", "status").agg(
                  F.count(F.lit(1)).alias("execution_count"),
                  _avg_seconds(dur).alias("avg_duration_seconds"),
                  F.sum("records_in").alias("total_records_in"),
                  F.sum("records_out").alias("total_records_out"),
                  F.sum(F.col("records_in") - F.col("records_out")).alias("total_records_lost"),
                  F.max("completed_at").alias("last_execution")))


def pipeline_health_24h(pe: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The slice of H10 whose last execution is within 24 h of ``as_of``."""
    ref = _as_of(pe, "started_at", as_of)
    return pipeline_health(pe, ref).filter(F.col("last_execution") >= ref - F.make_dt_interval(F.lit(0), F.lit(24)))


def slow_stages(pe: DataFrame, as_of: AsOf = None, hours: int = 24) -> DataFrame:
    """Average and maximum seconds by stage, successful executions only."""
    dur = epoch_micros(F.col("completed_at"), F.col("started_at"))
    return (pe.filter(_since(pe, "started_at", as_of, hours=hours) & (F.col("status") == "success"))
              .groupBy("stage").agg(_avg_seconds(dur).alias("avg_duration"),
                                    (F.max(dur) / F.lit(1e6)).alias("max_duration")))


def failed_top10(pe: DataFrame, n: int = 10) -> DataFrame:
    """Newest failed stage executions (top-k; ties broken by execution id)."""
    return (pe.filter(F.col("status") == "failed")
              .orderBy(F.col("started_at").desc(), F.col("execution_id").desc()).limit(n))


def recent_executions(pe: DataFrame, n: int = 5) -> DataFrame:
    """H24 (second form): newest ``n`` stage executions."""
    return pe.orderBy(F.col("started_at").desc(), F.col("execution_id").desc()).limit(n)


def quality_summary(dq: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """H11 ``v_data_quality_summary``: checks of the last ``days`` by dataset and type."""
    passed = F.col("passed")
    return (dq.filter(_since(dq, "checked_at", as_of, days=days))
              .groupBy("dataset", "check_type").agg(
                  F.count(F.lit(1)).alias("total_checks"),
                  F.count_if(passed).alias("passed_checks"),
                  F.count_if(~passed).alias("failed_checks"),
                  fixed(ratio_units(F.count_if(passed) * 100, F.count(F.lit(1)), 2), 2).alias("pass_rate"),
                  F.max("checked_at").alias("last_check")))


def failing_checks(dq: DataFrame) -> DataFrame:
    """Failed checks (presentation sorts newest first)."""
    return dq.filter(~F.col("passed")).select("check_id", "dataset", "check_type", "failed_count",
                                               "checked_at")


def recent_checks(dq: DataFrame, dataset: str = "environmental_metrics", n: int = 10) -> DataFrame:
    """Newest ``n`` checks of one dataset."""
    return (dq.filter(F.col("dataset") == dataset)
              .orderBy(F.col("checked_at").desc(), F.col("check_id").desc()).limit(n))


def source_comparison(env: DataFrame, hourly: DataFrame, daily: DataFrame, dairy: DataFrame,
                      as_of: AsOf = None, days: int = 30) -> DataFrame:
    """H12 ``v_source_comparison``: per dataset and source, last ``days`` — UNION ALL of 4.

    With ``as_of=None`` each branch measures its window back from its own
    newest record (there is no wall clock in a reproducible query).
    """
    def branch(df: DataFrame, name: str, ts: str) -> DataFrame:
        t = F.col(ts).cast("timestamp_ntz")
        ref = _as_of(df, ts, as_of).cast("timestamp_ntz")
        return (df.filter(t >= ref - F.make_dt_interval(F.lit(days)))
                  .groupBy("source_type").agg(
                      F.count(F.lit(1)).alias("record_count"),
                      F.min(t).alias("earliest_record"), F.max(t).alias("latest_record"),
                      F.count_distinct("source_device_id").alias("unique_devices"))
                  .select(F.lit(name).alias("dataset"), "*"))
    return (branch(env, "environmental_metrics", "timestamp")
            .unionByName(branch(hourly, "fact_energy_hourly", "ts"))
            .unionByName(branch(daily, "fact_energy_daily", "ts"))
            .unionByName(branch(dairy, "dairy_production", "production_date")))


def source_comparison_one(env, hourly, daily, dairy, dataset: str = "environmental_metrics",
                          as_of: AsOf = None) -> DataFrame:
    """One dataset of H12; the literal filter prunes the other branches in Catalyst."""
    return source_comparison(env, hourly, daily, dairy, as_of).filter(F.col("dataset") == dataset)


def source_stats(env: DataFrame, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """Readings, null temperatures, mean and sample stddev of temperature by source."""
    t = F.col("temperature")
    return (env.filter(_since(env, "timestamp", as_of, days=days))
               .groupBy("source_type").agg(
                   F.count(F.lit(1)).alias("records"),
                   F.count_if(t.isNull()).alias("null_temps"),
                   avg_dec(t, 2, 6).alias("avg_temp"),
                   F.round(F.stddev_samp(t.cast("double")), 6).alias("stddev_temp")))


def source_filter_avg(env: DataFrame, source: str = "api", as_of: AsOf = None) -> DataFrame:
    """Readings of one source in the last 24 h, plus mean temperature by source over 7 days."""
    recent = env.filter((F.col("source_type") == source) & _since(env, "timestamp", as_of, hours=24))
    by_src = (env.filter(_since(env, "timestamp", as_of, days=7)).groupBy("source_type")
                 .agg(F.count(F.lit(1)).alias("records"), avg_dec(F.col("temperature"), 2, 6).alias("avg_temp")))
    return recent.select("timestamp", "source_type", "temperature").join(by_src, "source_type", "left")


# ---------------------------------------------------------------- devices

def device_energy(device: DataFrame) -> DataFrame:
    """H13 ``device_energy``: energy devices with two JSON metadata fields."""
    return device.filter(F.col("device_type") == "energy").select(
        "id", "device_id", F.col("alias").alias("display_name"), "client",
        F.get_json_object("metadata", "$.name").alias("name"),
        F.get_json_object("metadata", "$.device_token").alias("device_token"))


def device_weather(device: DataFrame) -> DataFrame:
    """H14 ``device_weather``: weather devices with the JSON location."""
    return device.filter(F.col("device_type") == "weather").select(
        "id", "device_id", F.col("alias").alias("display_name"), "client", "description", "status",
        "timezone", F.get_json_object("metadata", "$.location").alias("location"))


def devices_by_group(device: DataFrame) -> DataFrame:
    """Device counts by type, client and status."""
    return device.groupBy("device_type", "client", "status").agg(F.count(F.lit(1)).alias("count"))
