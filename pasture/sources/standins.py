"""Warehouse tables derived from the driver tables.

The reference's warehouse holds devices, energy facts, dairy production,
environmental readings and two control logs.  The driver ships TPC-H-style
tables instead, so each warehouse table is *derived* from them by a Spark plan
whose work grows with the inputs.  The same definitions are written in DuckDB
SQL in ``pasture.plans.oracle`` so every query can be checked independently.

All derived measures are built from integers (cents, counts) so both engines
produce bit-identical values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pasture.functions.numeric import fixed
from pasture.operators.joins import join_dimension
from pasture.sources.tables import table

# Sensor names of the environmental model, in the order of the
# driver's event types that stand in for them.
SENSOR_OF_EVENT = {
    "click": "temperature",
    "error": "humidity",
    "purchase": "pm10",
    "signup": "pm2p5",
    "view": "noise_level_db",
}
EVENT_TYPES = tuple(SENSOR_OF_EVENT)


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("long")


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``generic_device``: one device per supplier; client = nation, location = region."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions.
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    d = s.join(F.broadcast(geo), s.s_nationkey == geo.n_nationkey)
    key = F.col("s_suppkey").cast("string")
    token = F.substring(F.sha2(F.concat(F.lit("token-"), key), 256), 1, 32)
    return d.select(
        F.col("s_suppkey").alias("id"),
        F.substring(F.sha2(F.concat(F.lit("device-"), key), 256), 1, 24).alias("device_id"),
        F.when(F.col("s_suppkey") % 2 == 0, "energy").otherwise("weather").alias("device_type"),
        F.col("s_name").alias("alias"),
        F.col("n_name").alias("client"),
        F.concat(F.lit("region "), F.col("r_name")).alias("description"),
        F.when(F.col("s_suppkey") % 3 == 0, "online")
         .when(F.col("s_suppkey") % 3 == 1, "offline").otherwise("unknown").alias("status"),
        F.lit("UTC").alias("timezone"),
        F.to_json(F.struct(F.col("s_name").alias("name"), token.alias("device_token"),
                           F.col("r_name").alias("location"))).alias("metadata"),
        token.alias("device_token"),
    )


def energy_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fact_energy_hourly``: kWh per (device, hour) from lineitem quantities."""
    li = table(spark, sf_dir, "lineitem")
    ts = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))
    f = (li.groupBy(F.col("l_suppkey").alias("device_id"), ts.alias("ts"))
           .agg(F.sum("l_quantity").alias("energy_kwh")))
    return f.select(
        "device_id", "ts", "energy_kwh",
        F.when((F.col("device_id") + F.hour("ts")) % 3 == 0, "csv")
         .when((F.col("device_id") + F.hour("ts")) % 3 == 1, "api").otherwise("excel").alias("source_type"),
        F.col("device_id").cast("string").alias("source_device_id"),
        F.lit("batch").alias("ingestion_method"),
    )


def energy_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fact_energy_daily``: kWh per (device, day)."""
    li = table(spark, sf_dir, "lineitem")
    f = (li.groupBy(F.col("l_suppkey").alias("device_id"), F.to_date("l_shipdate").alias("ts"))
           .agg(F.sum("l_quantity").alias("energy_kwh")))
    return f.select(
        "device_id", "ts", "energy_kwh",
        F.when(F.col("device_id") % 2 == 0, "csv").otherwise("api").alias("source_type"),
        F.col("device_id").cast("string").alias("source_device_id"),
        F.lit("batch").alias("ingestion_method"),
    )


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dairy_production``: one row per order date; measures derived from order cents."""
    o = table(spark, sf_dir, "orders")
    g = (o.groupBy(F.to_date("o_orderdate").alias("production_date"))
          .agg(F.count(F.lit(1)).alias("n"), F.sum(_cents(F.col("o_totalprice"))).alias("s"),
               F.min(_cents(F.col("o_totalprice"))).alias("mn"),
               F.max(_cents(F.col("o_totalprice"))).alias("mx"),
               F.count_distinct("o_custkey").alias("nc")))
    n, s, mn, mx, nc = (F.col(c) for c in ("n", "s", "mn", "mx", "nc"))
    avg_cents = ((s - s % n) / n).cast("long")
    return g.select(
        "production_date",
        F.when(n % 19 == 0, None).otherwise(fixed(F.lit(2000) + avg_cents % 1500, 2, 10)).alias("day_production_per_cow_kg"),
        n.cast("int").alias("number_of_animals"),
        F.when(n % 13 == 0, None).otherwise((F.lit(50) + (nc * 37) % 300).cast("int")).alias("average_lactation_days"),
        F.when(n % 11 == 0, None).when(n % 17 == 0, F.lit(Decimal("0.00")).cast("decimal(10,2)"))
         .otherwise(fixed(F.lit(3000) + mn % 2000, 2, 10)).alias("fed_per_cow_total_kg"),
        fixed(F.lit(5000) + mx % 3000, 2, 10).alias("fed_per_cow_water_kg"),
        F.when(n % 7 == 0, F.lit(Decimal("0.0000")).cast("decimal(10,4)"))
         .otherwise(fixed(F.lit(10000) + s % 7000, 4, 10)).alias("feed_efficiency"),
        (F.lit(300) + ((mx - mx % 100) / 100).cast("long") % 300).cast("int").alias("rumination_minutes"),
        F.when(F.dayofmonth("production_date") % 2 == 0, "csv").otherwise("excel").alias("source_type"),
        F.concat(F.lit("farm-"), (n % 3).cast("string")).alias("source_device_id"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long sensor readings: device, sensor, ts, value, seq (arrival order)."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("device"), F.col("event_type").alias("sensor"),
                    "ts", "value", F.col("event_id").alias("seq"))


def environmental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``environmental_metrics``: readings pivoted to one wide row per hour.

    Unique by timestamp alone, as in the reference; last reading wins per sensor.
    The pivot values are listed, so no extra job discovers them.
    """
    e = table(spark, sf_dir, "events")
    hour = F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("timestamp")
    aggs = [F.max_by(F.when(F.col("event_type") == ev, F.col("value")),
                     F.when(F.col("event_type") == ev, F.col("event_id"))).alias(sensor)
            for ev, sensor in SENSOR_OF_EVENT.items()]
    g = e.groupBy(hour).agg(*aggs, F.count(F.lit(1)).alias("n"),
                            F.sum(_cents(F.col("value"))).alias("cents"),
                            F.max_by("user_id", "event_id").alias("last_user"))
    n = F.col("n")
    dec = lambda c, p=6: F.col(c).cast(f"decimal({p},2)")
    return g.select(
        "timestamp",
        fixed(F.lit(100000) + F.col("cents") % 5000, 2, 8).alias("atm_pressure"),
        dec("noise_level_db"),
        dec("temperature"),
        dec("humidity"),
        dec("pm10", 8),
        fixed((n * 37) % 1500, 2, 6).alias("wind_speed"),
        fixed((n % 16) * 100, 2, 6).alias("wind_direction_sectors"),
        fixed(((n * 13) % 360) * 100, 2, 6).alias("wind_angle"),
        dec("pm2p5", 8),
        F.when(F.hour("timestamp") % 2 == 0, "api").otherwise("csv").alias("source_type"),
        F.col("last_user").cast("string").alias("source_device_id"),
    )


def exec_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pipeline_execution``: one stage execution per event."""
    e = table(spark, sf_dir, "events")
    st = F.col("event_id") % 10
    status = F.when(st == 0, "failed").when(st == 1, "running").otherwise("success")
    dur = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value").cast("decimal(18,6)"))
    rin = F.floor("value").cast("int")
    return e.select(
        F.concat(F.lit("file-"), F.col("event_type")).alias("file_id"),
        F.col("event_id").alias("execution_id"),
        F.when(F.col("user_id") % 2 == 0, "csv_pipeline").otherwise("api_pipeline").alias("pipeline_name"),
        F.when(F.col("user_id") % 3 == 0, "extract").when(F.col("user_id") % 3 == 1, "validate")
         .otherwise("load").alias("stage"),
        F.col("ts").alias("started_at"),
        F.when(st == 1, None).otherwise(F.col("ts") + dur).alias("completed_at"),
        status.alias("status"),
        rin.alias("records_in"),
        (rin - (F.col("event_id") % 4).cast("int")).alias("records_out"),
        F.when(st == 0, F.concat(F.lit("stage failed: "), F.col("event_type"))).alias("error_message"),
    )


# Dataset names of the reference's four fact tables.
DATASETS = ("environmental_metrics", "energy_hourly", "energy_daily", "dairy_production")


def dq_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``data_quality_checks``: one check row per event."""
    e = table(spark, sf_dir, "events")
    ds = F.element_at(F.array(*[F.lit(d) for d in DATASETS]), (F.col("user_id") % 4 + 1).cast("int"))
    ct = F.col("event_id") % 3
    failed = (F.col("event_id") % 7).cast("int")
    total = (F.lit(10) + F.col("user_id") % 90).cast("int")
    rate_units = ((failed * 20000 + total) - (failed * 20000 + total) % (total * 2)) / (total * 2)
    return e.select(
        F.concat(F.lit("file-"), F.col("event_type")).alias("file_id"),
        F.col("event_id").alias("check_id"),
        ds.alias("dataset"),
        F.when(ct == 0, "validation").when(ct == 1, "completeness").otherwise("error_type").alias("check_type"),
        F.concat(F.lit("check_"), F.col("event_type")).alias("check_name"),
        (F.col("event_id") % 5 != 0).alias("passed"),
        failed.alias("failed_count"),
        total.alias("total_count"),
        fixed(rate_units.cast("long"), 2, 5).alias("failure_rate"),
        F.col("ts").alias("checked_at"),
    )


def energy_with_devices(spark: SparkSession, sf_dir: str, daily: bool = False) -> DataFrame:
    """Fact ⋈ device (size-checked broadcast of the device dimension)."""
    f = energy_daily(spark, sf_dir) if daily else energy_hourly(spark, sf_dir)
    d = devices(spark, sf_dir).select("id", "device_token", "client", "alias")
    return join_dimension(f, d, f.device_id == d.id)


# The boolean spellings cycled through the feed's flag column.
FLAG_WORDS = ("YES", "No", "1", "0", "true", "n", "maybe", "Y", "FALSE")


def energy_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw delivery of meter readings as dirty text (one 'file' per event type).

    Columns are all strings as a CSV scan yields them: AM/PM and ISO
    timestamps, decimal commas, blanks, junk, out-of-range values.  ``seq`` is
    the line order within the file.
    """
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    cents = _cents(F.col("value"))
    text = F.concat(((cents - cents % 100) / 100).cast("long").cast("string"), F.lit(","),
                    F.lpad((cents % 100).cast("string"), 2, "0"))
    hourly = (F.when(eid % 97 == 0, "").when(eid % 89 == 0, "abc").when(eid % 83 == 0, "-5,0")
               .when(eid % 79 == 0, "1.234,56").when(eid % 73 == 0, F.lit(None))
               .when(eid % 71 == 0, " 12,5 ").when(eid % 67 == 0, "10000,01").when(eid % 61 == 0, "nan")
               .otherwise(text))
    when_text = (F.when(eid % 101 == 0, "not a date")
                  .when(eid % 5 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
                  .otherwise(F.date_format("ts", "M/d/yyyy h:mm:ss a")))
    vtxt = F.col("value").cast("string")
    count = (F.when(eid % 31 == 0, "x").when(eid % 29 == 0, "")
              .when(eid % 2 == 0, vtxt).otherwise(F.concat(F.lit("-"), vtxt)))
    flag = F.element_at(F.array(*[F.lit(w) for w in FLAG_WORDS]), (eid % len(FLAG_WORDS) + 1).cast("int"))
    clock = (F.when(eid % 13 == 0, "24:00:00").when(eid % 17 == 0, "7:5:9")
              .otherwise(F.date_format("ts", "HH:mm:ss")))
    return e.select(
        F.concat(F.lit("feed-"), F.col("event_type")).alias("file_id"),
        eid.alias("seq"), F.col("user_id").alias("device"), F.col("ts").alias("received_at"),
        when_text.alias("Date and Time"), hourly.alias("Hourly"), count.alias("Count"),
        flag.alias("Flag"), clock.alias("Time"))
