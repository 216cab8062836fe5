"""Catalogue entries over the delivery path: lines of events as files, through headers, rows, rules and upsert."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, functions as F

from pasture.operators.rules import get_spec
from pasture.operators.upsert import read_facts, upsert, write_upsert
from pasture.plans import control as K
from pasture.plans import ingest as I
from pasture.plans.oracle import with_standins as W
from pasture.plans.registry import register
from pasture.session import ensure_checkpoint_dir
from pasture.sources import files as FS
from pasture.sources import standins as S
from pasture.sources.tables import table
from pasture.streaming import cursors as CU
from pasture.streaming import delivery as D

_FILLERS = 66
_HEADERS = ("Date and Time,Hourly",
            ",".join(["timestamp", "", *(f"x{i}" for i in range(_FILLERS)), "temperature (°C)", "pm10 (µg/m³)"]),
            "a,b,c")


def lines(spark, sf, e: DataFrame | None = None) -> DataFrame:
    """Every user's events as one file: hourly energy, a 70-column station with an empty header cell, or unknown."""
    e = table(spark, sf, "events") if e is None else e
    n, kind = F.col("event_id"), F.col("user_id") % 3
    reading = F.concat((n % 97).cast("string"), F.lit(","), F.lpad((n % 100).cast("string"), 2, "0"))
    energy = F.concat(F.date_format("ts", "M/d/yyyy h:mm:ss a"), F.lit(',"'), reading, F.lit('"'))
    temperature = F.when(n % 10 == 0, "NA").when(n % 10 == 1, "99").when(n % 10 == 2, "abc").otherwise((n % 40).cast("string"))
    pm10 = F.when(n % 13 == 0, "5000").when(n % 13 == 1, "").otherwise((n % 500).cast("string"))
    station = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(",X,"), F.lit("z," * _FILLERS), temperature,
                       F.lit(","), pm10)
    name = F.concat(F.lit("f"), F.col("user_id").cast("string"), F.lit(".csv"))
    data = e.select(name.alias("file"), F.lit(0).cast("long").alias("block"), n.alias("line_id"),
                    F.when(kind == 0, energy).when(kind == 1, station).otherwise("1,2,3").alias("line"))
    head = e.groupBy("user_id").agg(F.lit(-1).cast("long").alias("line_id"))
    head = head.select(name.alias("file"), F.lit(0).cast("long").alias("block"), "line_id",
                       F.when(kind == 0, _HEADERS[0]).when(kind == 1, _HEADERS[1]).otherwise(_HEADERS[2]).alias("line"))
    return data.unionByName(head).withColumn("cells", FS.csv_cells(F.col("line")))


@register("delivery_headers", f"""
SELECT 'f' || CAST(user_id AS VARCHAR) || '.csv' AS file,
       CASE user_id % 3 WHEN 0 THEN 'energy_hourly' WHEN 1 THEN 'environmental_metrics' END AS dataset,
       CAST(CASE user_id % 3 WHEN 0 THEN 2 WHEN 1 THEN {_FILLERS + 4} ELSE 3 END AS BIGINT) AS n_columns,
       CAST(CASE user_id % 3 WHEN 1 THEN 1 ELSE 0 END AS BIGINT) AS n_unnamed
FROM events GROUP BY user_id""")
def q_delivery_headers(spark, sf):
    c = FS.classify(FS.header_table(lines(spark, sf)))
    return c.select("file", "dataset", F.size("columns").cast("long").alias("n_columns"),
                    F.size(F.filter("columns", lambda x: x == "")).cast("long").alias("n_unnamed"))


def _rows(spark, sf, dataset):
    x = lines(spark, sf)
    return FS.dataset_rows(x, FS.classify(FS.header_table(x)), get_spec(dataset))


_TEMP = """CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN '99' WHEN 2 THEN 'abc' ELSE CAST(event_id % 40 AS VARCHAR) END"""
_PM = """CASE event_id % 13 WHEN 0 THEN '5000' WHEN 1 THEN NULL ELSE CAST(event_id % 500 AS VARCHAR) END"""


@register("delivery_rows", f"""
SELECT 'f' || CAST(user_id AS VARCHAR) || '.csv' AS file_id,
       row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS row_number,
       CASE WHEN user_id % 3 = 0 THEN CAST(event_id % 97 AS VARCHAR) || ',' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0')
            ELSE {_TEMP} END AS first_value,
       CASE WHEN user_id % 3 = 1 THEN {_PM} END AS second_value
FROM events WHERE user_id % 3 < 2""")
def q_delivery_rows(spark, sf):
    a = _rows(spark, sf, "energy_hourly").select("file_id", "row_number", F.col("Hourly").alias("first_value"),
                                                 F.lit(None).cast("string").alias("second_value"))
    b = _rows(spark, sf, "environmental_metrics").select(
        "file_id", "row_number", F.col("`temperature (°C)`").alias("first_value"), F.col("`pm10 (µg/m³)`").alias("second_value"))
    return a.unionByName(b)


@register("error_counts_all", """
WITH e AS (SELECT * FROM events WHERE user_id % 3 = 1)
SELECT * FROM (
  SELECT 'temperature' AS field, CASE event_id % 10 WHEN 0 THEN 'validation' WHEN 1 THEN 'range' ELSE 'type' END AS error_type,
         count(*) AS n FROM e WHERE event_id % 10 < 3 GROUP BY ALL
  UNION ALL
  SELECT 'pm10', 'range', count(*) FROM e WHERE event_id % 13 = 0 HAVING count(*) > 0)""")
def q_error_counts_all(spark, sf):
    s = I.stage_batch(_rows(spark, sf, "environmental_metrics").drop("device_hint"), get_spec("environmental_metrics"))
    # outer: an inner explode would have the optimiser test for empty arrays by a second copy of all the rules
    x = s.select(F.explode_outer("errors").alias("e")).filter("e is not null")
    return x.groupBy(F.col("e.field").alias("field"), F.col("e.error_type").alias("error_type")).agg(F.count(F.lit(1)).alias("n"))


_HOUR = "CASE WHEN event_id % 50 = 0 THEN NULL ELSE date_trunc('hour', ts) END"


@register("upsert_untouched", W("""
SELECT hour, value FROM t WHERE hour IS NULL OR hour NOT IN (SELECT hour FROM b WHERE hour IS NOT NULL)
UNION ALL SELECT hour, value FROM b WHERE hour IS NULL
UNION ALL SELECT hour, arg_max(value, event_id) FROM b WHERE hour IS NOT NULL GROUP BY hour""", ctes=(
    ("t", f"SELECT {_HOUR} AS hour, value FROM events WHERE event_type <> 'click' OR user_id % 7 <> 0"),
    ("b", f"SELECT {_HOUR} AS hour, value, event_id FROM events WHERE event_type = 'click' AND user_id % 7 = 0"))))
def q_upsert_untouched(spark, sf):
    """The table holds several rows per key; only keys that the batch carries change."""
    e = table(spark, sf, "events")
    e = e.withColumn("hour", F.when(F.col("event_id") % 50 != 0, F.date_trunc("hour", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz")))
    new = (F.col("event_type") == "click") & (F.col("user_id") % 7 == 0)
    return upsert(e.filter(~new).select("hour", "value"), e.filter(new).select("hour", "value", "event_id"),
                  ["hour"], "update", seq="event_id").drop("event_id")


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/pasture-queries/{name}-{uuid.uuid4().hex}"


@register("delivery_rejects", """
WITH f AS (
  SELECT user_id, count(*) AS n, user_id % 11 = 5 AS broken, user_id % 3 AS kind,
         count(*) FILTER (WHERE user_id % 3 = 0 OR NOT (event_id % 10 < 3 OR event_id % 13 = 0)) AS valid
  FROM events GROUP BY user_id)
SELECT 'f' || CAST(user_id AS VARCHAR) || '.csv' AS file,
       CASE WHEN broken THEN 'rejected: unreadable' WHEN kind = 2 THEN 'rejected: unknown dataset' ELSE 'accepted' END AS status,
       CASE WHEN broken THEN 'BadZipFile: no workbook' END AS detail,
       CASE WHEN NOT broken AND kind < 2 THEN n END AS extract_records,
       CASE WHEN NOT broken AND kind < 2 THEN valid END AS valid_records,
       CASE WHEN NOT broken AND kind < 2 THEN valid END AS loaded_records
FROM f""")
def q_delivery_rejects(spark, sf):
    """A whole delivery, with some files that break while they are read (J2): every input has its own fate."""
    x = lines(spark, sf)
    user = F.regexp_extract("file", "[0-9]+", 0).cast("bigint")
    broken = x.filter((F.col("line_id") == -1) & (user % 11 == 5)).withColumn("error", F.lit("BadZipFile: no workbook"))
    x = x.withColumn("error", F.lit(None).cast("string")).unionByName(broken.withColumn("line_id", F.lit(1 << 40)))
    wh = D.Warehouse(_folder(spark, "delivery"))
    reg = D.run_delivery(spark, x, wh, "r1", as_of=dt.datetime(2024, 1, 1))
    reg = reg.select(F.col("file_id").alias("file"), "extract_records", "valid_records", "loaded_records")
    why = D.rejections(spark, wh).select("file", "detail")
    return D.read_table(spark, wh.path("inputs")).select("file", "status").join(why, "file", "left").join(reg, "file", "left")


@register("facts_snapshot", W("""
SELECT 1 AS version, hour, arg_max(value, event_id) AS value FROM e WHERE NOT new GROUP BY hour
UNION ALL
SELECT 2, hour, CASE WHEN bool_or(new) THEN arg_max(value, event_id) FILTER (WHERE new) ELSE arg_max(value, event_id) END
FROM e GROUP BY hour""", ctes=(
    ("e", "SELECT date_trunc('hour', ts) AS hour, value, event_id, event_type = 'click' AS new FROM events"),)))
def q_facts_snapshot(spark, sf):
    """Two commits of the fact sink; each version is read as it was committed."""
    e = table(spark, sf, "events")
    e = e.select(F.date_trunc("hour", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz").alias("hour"), "value", "event_id",
                 "event_type")
    path = _folder(spark, "facts")
    for part in (F.col("event_type") != "click", F.col("event_type") == "click"):
        write_upsert(spark, e.filter(part).drop("event_type"), path, ["hour"], "hour", seq="event_id")
    one, two = (read_facts(spark, path, v).select(F.lit(v).alias("version"), "hour", "value") for v in (1, 2))
    return one.unionByName(two)


@register("stage_states", W("""
SELECT execution_id AS run_id, stage,
       CASE WHEN completed_at IS NOT NULL AND execution_id % 5 = 0 THEN completed_at + INTERVAL 1 HOUR ELSE started_at END AS started_at,
       CASE WHEN execution_id % 5 <> 0 THEN completed_at END AS completed_at,
       CASE WHEN completed_at IS NULL OR execution_id % 5 = 0 THEN 'running' ELSE status END AS status
FROM exec_log""", "exec_log"))
def q_stage_states(spark, sf):
    """Stages from their start and end events; every fifth run has been started once more and not ended (G1)."""
    x = S.exec_log(spark, sf).withColumn("run_id", F.col("execution_id"))
    none = F.lit(None).cast("string").alias("status")
    start = x.select("run_id", "stage", F.lit("start").alias("kind"), F.col("started_at").alias("at"), none)
    ended = x.filter("completed_at IS NOT NULL")
    end = ended.select("run_id", "stage", F.lit("end").alias("kind"), F.col("completed_at").alias("at"), "status")
    again = ended.filter(F.col("execution_id") % 5 == 0).select(
        "run_id", "stage", F.lit("start").alias("kind"), (F.col("completed_at") + F.expr("INTERVAL 1 HOUR")).alias("at"), none)
    return K.stage_states(start.unionByName(end).unionByName(again))


_WINNERS = W("""
SELECT run, 'f' || CAST(user_id AS VARCHAR) || '.csv' AS file, count(*) AS extract_records, count(*) FILTER (WHERE valid) AS valid_records,
       count(*) FILTER (WHERE valid AND nth = 1) AS loaded_records, count(*) FILTER (WHERE valid AND nth > 1) AS skipped_records,
       count(*) FILTER (WHERE valid AND nth > 1) AS pending
FROM k GROUP BY run, user_id""", ctes=(
    ("v", """SELECT user_id, event_id, user_id % 6 // 3 AS half, date_trunc('hour', ts) AS hour, user_id % 3 AS kind,
             user_id % 3 = 0 OR NOT (event_id % 10 < 3 OR event_id % 13 = 0) AS valid FROM events WHERE user_id % 3 < 2"""),
    ("k", """SELECT *, CASE half WHEN 0 THEN 'r1' ELSE 'r2' END AS run,
             row_number() OVER (PARTITION BY kind, hour, valid, CASE WHEN kind = 0 THEN user_id END
                                ORDER BY half, user_id, event_id) AS nth FROM v""")))


@register("delivery_skips", _WINNERS)
def q_delivery_skips(spark, sf):
    """Two deliveries whose readings meet in the same hours, under ``ignore`` and ``append`` (F13): what is loaded, skipped
    and pending by file, from ledger, staging and metrics.  The second one is delivered twice, which changes nothing."""
    e = table(spark, sf, "events")
    e = e.withColumn("ts", F.date_trunc("hour", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz"))
    wh = D.Warehouse(_folder(spark, "skips"))
    how = {"environmental_metrics": "ignore", "energy_hourly": "append"}
    for half, run in ((0, "r1"), (1, "r2"), (1, "r2")):
        x = lines(spark, sf, e.filter(F.floor(F.col("user_id") % 6 / 3) == half))
        meter = F.concat(F.lpad(F.regexp_extract("file", "[0-9]+", 0), 20, "0"), F.lit("-"), "file")
        D.run_delivery(spark, x.withColumn("file", meter), wh, run, as_of=dt.datetime(2024, 1, 1), strategies=how)
    reg = D.read_table(spark, wh.path("ingest_file"))
    staged = D.read_table(spark, wh.path("staging")).select("run", "file_id", "row_number", "is_valid")
    pending = staged.filter("is_valid").join(D.read_table(spark, wh.path("loaded")), ["run", "file_id", "row_number"], "left_anti")
    pending = pending.groupBy("run", "file_id").agg(F.count(F.lit(1)).alias("pending"))
    return (reg.join(pending, ["run", "file_id"], "left").fillna(0, ["pending"])
               .select("run", F.substring_index("file_id", "-", -1).alias("file"), "extract_records", "valid_records", "loaded_records",
                       "skipped_records", "pending"))


def _fetches(e: DataFrame) -> DataFrame:
    return e.select(F.lit("sensor_api").alias("connector_id"), F.col("event_type").alias("endpoint_id"),
                    F.col("user_id").cast("string").alias("device_id"), F.col("ts").cast("timestamp_ntz").alias("fetched_at"),
                    F.col("event_id").cast("string").alias("sha256"))


@register("cursor_compaction", """
SELECT 'sensor_api' AS connector_id, event_type AS endpoint_id, CAST(user_id AS VARCHAR) AS device_id,
       max(ts) AS last_fetch_timestamp, max(ts) AS last_fetch_success, count(*) AS fetch_count
FROM events GROUP BY event_type, user_id""")
def q_cursor_compaction(spark, sf):
    """Four runs of fetches, two of them folded into the state, one of these replayed after it."""
    e = table(spark, sf, "events")
    root = _folder(spark, "cursors")
    store = CU.CursorStore(spark, root)
    for n in (0, 1, None, 2, 0, 3):
        if n is None:
            store.compact()
        else:
            D._append(_fetches(e.filter(F.col("event_id") % 4 == n)), store.log, f"r{n}")
    return store.read()


@register("cursor_stream", """
WITH f AS (SELECT event_type AS endpoint_id, CAST(user_id AS VARCHAR) AS device_id, max(ts) AS ts, count(*) AS n
           FROM events GROUP BY event_type, user_id)
SELECT 'sensor_api' AS connector_id, endpoint_id, device_id, ts AS cursor_ts, ts + INTERVAL 1 HOUR AS start_ts, n AS fetch_count,
       CASE WHEN ts + INTERVAL 1 DAY < (SELECT max(ts) FROM events) THEN 'silent' ELSE 'cursor' END AS basis
FROM f""")
def q_cursor_stream(spark, sf):
    """The events as a stream of fetches: each device's next window, and who has been silent for a day."""
    kind = table(spark, sf, "events").schema
    # the pattern fits a single file and a folder of files alike
    e = spark.readStream.schema(kind).option("maxFilesPerTrigger", "8").parquet(f"{sf}/events.parque[t]")
    out = _folder(spark, "windows")
    CU.start_window_stream(_fetches(e), f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return CU.windows(spark, f"{out}/rows")
