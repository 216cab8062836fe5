"""Catalogue entries for reshaping, cleaning and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasture.functions import coerce as C
from pasture.operators import profile as P
from pasture.operators import reshape as R
from pasture.operators.rules import get_spec
from pasture.plans.oracle import ampm_ts, with_standins as W
from pasture.plans.q_ingest import feed
from pasture.plans.registry import register
from pasture.sources import standins as S
from pasture.sources.tables import table

# ------------------------------------------------------------------ projections


@register("map_columns", W("""
SELECT file_id, row_number, "Date and Time" AS ts, "Hourly" AS energy_kwh,
       CASE seq % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'api' WHEN 2 THEN 'excel' ELSE 'unknown' END AS source_type,
       file_id AS source_file, CAST(NULL AS VARCHAR) AS source_api_endpoint,
       CAST(device AS VARCHAR) AS source_device_id, 'batch' AS ingestion_method, received_at AS ingested_at,
       device AS device_id
FROM feed""", "feed"))
def q_map_columns(spark, sf):
    f = feed(spark, sf)
    m = R.map_columns(f, get_spec("energy_hourly").columns,
                      keep=["file_id", "row_number", F.col("seq").alias("_seq"), F.col("device").alias("_device"),
                            F.col("received_at").alias("_received_at")])
    st = F.element_at(F.array(*[F.lit(x) for x in ("csv", "api", "excel", "ftp")]), (F.col("_seq") % 4 + 1).cast("int"))
    m = R.with_provenance(m, "energy_hourly", st, F.col("file_id"), F.col("_device"), ingested_at=F.col("_received_at"))
    return R.strip_internal(m)


_LABELS = ("AVG", "Sum", "TOTAL", "average", " AVG", "Total ")


@register("drop_summary_rows", W("""
SELECT * FROM (
  SELECT file_id, "Date and Time" AS "Date", "Hourly" FROM feed
  UNION ALL
  SELECT file_id, label, CAST(n AS VARCHAR)
  FROM (SELECT file_id, count(*) AS n FROM feed GROUP BY file_id)
  CROSS JOIN (VALUES ('AVG'), ('Sum'), ('TOTAL'), ('average'), (' AVG'), ('Total '), (NULL)) v(label))
WHERE "Date" IS NULL OR upper("Date") NOT IN ('AVG', 'SUM', 'TOTAL', 'AVERAGE')""", "feed"))
def q_drop_summary_rows(spark, sf):
    f = feed(spark, sf)
    rows = f.select("file_id", F.col("Date and Time").alias("Date"), "Hourly")
    labels = F.array(*[F.lit(x) for x in _LABELS], F.lit(None).cast("string"))
    summary = (f.groupBy("file_id").agg(F.count(F.lit(1)).cast("string").alias("Hourly"))
                .select("file_id", F.explode(labels).alias("Date"), "Hourly"))
    return R.drop_summary_rows(rows.unionByName(summary), "Date")


@register("drop_empty_rows", W("""
SELECT file_id, row_number, "Hourly", c AS "Count"
FROM (SELECT *, CASE WHEN row_number % 2 = 1 THEN NULL ELSE "Count" END AS c FROM feed)
WHERE "Hourly" IS NOT NULL OR c IS NOT NULL""", "feed"))
def q_drop_empty_rows(spark, sf):
    f = feed(spark, sf).select("file_id", "row_number", "Hourly",
                               F.when(F.col("row_number") % 2 == 1, None).otherwise(F.col("Count")).alias("Count"))
    return R.drop_empty_rows(f, ["Hourly", "Count"])


@register("row_numbers", W("""
SELECT file_id, seq, row_number() OVER (PARTITION BY file_id ORDER BY seq) AS row_number FROM energy_feed""",
                           "energy_feed"))
def q_row_numbers(spark, sf):
    return R.row_numbers(S.energy_feed(spark, sf).select("file_id", "seq"), "file_id", "seq")


_V = ("CASE WHEN event_id % 50 = 0 THEN CAST('nan' AS DOUBLE) WHEN event_id % 77 = 0 THEN CAST('inf' AS DOUBLE) "
      "WHEN event_id % 91 = 0 THEN CAST('-inf' AS DOUBLE) ELSE value END")


@register("sanitize_json", W(f"""
SELECT event_id AS seq, event_type AS sensor,
       CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS value,
       isnan(v) OR isinf(v) AS value_is_null
FROM (SELECT *, {_V} AS v FROM events)"""))
def q_sanitize_json(spark, sf):
    e = table(spark, sf, "events")
    eid = F.col("event_id")
    v = (F.when(eid % 50 == 0, F.lit(float("nan"))).when(eid % 77 == 0, F.lit(float("inf")))
          .when(eid % 91 == 0, F.lit(float("-inf"))).otherwise(F.col("value")))
    df = e.select(eid.alias("seq"), F.col("event_type").alias("sensor"), v.alias("value"))
    j = R.sanitize_json(df, ["sensor", "value"])
    return j.select("seq", "sensor", F.get_json_object("json", "$.value").cast("double").alias("value"),
                    F.col("json").contains('"value":null').alias("value_is_null"))


# ------------------------------------------------------------------ JSON records

def _responses(spark, sf):
    """All events in response bodies of four shapes, and the same events again where the path finds nothing."""
    e = table(spark, sf, "events")
    page = ((F.col("event_id") - F.col("event_id") % 50) / 50).cast("long")
    k = F.col("page") % 4
    e = e.withColumn("page", page)
    # shapes 0 and 1 hold a page's records as an array, 2 and 3 one record as an object
    g = e.groupBy(F.col("event_type").alias("endpoint"), "page", F.when(k >= 2, F.col("event_id")).alias("one")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("id"), F.col("value").alias("v")))).alias("recs"))
    first = F.element_at("recs", 1)
    body = (F.when(k == 0, F.to_json("recs"))
             .when(k == 1, F.to_json(F.struct(F.struct(F.col("recs").alias("readings")).alias("data"))))
             .when(k == 2, F.to_json(F.struct(F.struct(first.alias("x")).alias("data"))))
             .otherwise(F.to_json(first)))
    path = F.when(k.isin(0, 3), "").when(k == 1, "data.readings").otherwise("data.x")
    lost = F.to_json(F.struct(F.lit(5).alias("data"), F.col("recs").alias("other")))
    shapes = F.explode(F.array(F.struct(body.alias("body"), path.alias("path")),
                               F.struct(lost.alias("body"), F.when(k < 2, "data.readings").otherwise("data.x").alias("path"))))
    return g.select("endpoint", "page", shapes.alias("s")).select("endpoint", "page", "s.*")


@register("records_by_path", "SELECT event_type AS endpoint, event_id // 50 AS page, event_id AS id, value AS v FROM events")
def q_records_by_path(spark, sf):
    r = _responses(spark, sf)
    parts = [R.records_by_path(r.filter(F.col("path") == p), "body", p) for p in ("", "data.readings", "data.x")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.select("endpoint", "page", F.get_json_object("record", "$.id").cast("long").alias("id"),
                    F.get_json_object("record", "$.v").cast("double").alias("v"))


ALLOWED = ("click", "error", "purchase", "signup")


def _sensor_bodies(spark, sf):
    e = table(spark, sf, "events")
    eid = F.col("event_id")
    ts_text = F.when(eid % 41 == 0, "").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:00:00"))
    val = F.when(eid % 37 == 0, None).otherwise(F.col("value"))
    # one response per device and page of 1000 consecutive events: bounded whatever the device's share
    page = ((eid - eid % 1000) / 1000).cast("long")
    s = (e.groupBy(F.col("user_id").alias("device"), page.alias("page"), "event_type")
          .agg(F.array_sort(F.collect_list(F.struct(eid.alias("k"), F.struct(ts_text.alias("timestamp"),
                                                                             val.alias("value")).alias("r"))))
               .alias("vals")))
    s = s.select("device", "page", F.struct(F.col("event_type").alias("key"),
                                           F.struct(F.transform("vals", lambda x: x["r"]).alias("values"))
                                           .alias("value")).alias("kv"))
    b = s.groupBy("device", "page").agg(F.map_from_entries(F.collect_list("kv")).alias("sensors"))
    return b.select("device", "page", F.to_json(F.struct("sensors")).alias("body"))


_PIV = ", ".join(f"arg_max(value, event_id) FILTER (WHERE event_type = '{s}') AS {s}" for s in ALLOWED)


@register("sensor_pivot", W(f"""
SELECT user_id AS device, event_id // 1000 AS page, strftime(ts, '%Y-%m-%dT%H:00:00') AS timestamp, {_PIV}
FROM events
WHERE event_type IN ('click', 'error', 'purchase', 'signup') AND event_id % 37 <> 0 AND event_id % 41 <> 0
GROUP BY 1, 2, 3"""))
def q_sensor_pivot(spark, sf):
    b = R.sensor_objects(_sensor_bodies(spark, sf), "body")
    return R.sensor_pivot(b, "sensors", ["device", "page"], ALLOWED)


# ------------------------------------------------------------------ nulls

_PROD_COLS = ("production_date", "day_production_per_cow_kg", "number_of_animals", "average_lactation_days",
              "fed_per_cow_total_kg", "fed_per_cow_water_kg", "feed_efficiency", "rumination_minutes",
              "source_type", "source_device_id")


@register("missing_counts", W("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM production" for c in _PROD_COLS),
    "production"))
def q_missing_counts(spark, sf):
    p = S.production(spark, sf)
    wide = p.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in _PROD_COLS])
    return wide.unpivot([], list(_PROD_COLS), "column_name", "missing")


@register("drop_null_rows", W("""
SELECT * FROM production
WHERE day_production_per_cow_kg IS NOT NULL AND fed_per_cow_total_kg IS NOT NULL AND feed_efficiency IS NOT NULL
  AND rumination_minutes IS NOT NULL AND average_lactation_days IS NOT NULL""", "production"))
def q_drop_null_rows(spark, sf):
    p = S.production(spark, sf)
    return p.filter(F.col("day_production_per_cow_kg").isNotNull()).dropna(
        subset=["fed_per_cow_total_kg", "feed_efficiency", "rumination_minutes", "average_lactation_days"])


# ------------------------------------------------------------------ detection and profile

# Synthetic headers of the five kinds of delivered files.
HEADERS = {
    "click": ("timestamp", "temperature (°C)", "humidity (%)", "pm10 (µg/m³)"),
    "error": ("Date", "Nr. animals", "Feed efficiency"),
    "purchase": ("Date and Time", "Hourly"),
    "signup": ("Date and Time", "Daily"),
    "view": ("Date and Time", "Value", "Note"),
}
DEFAULT_DEVICES = {"environmental_metrics": "weather-default", "dairy_production": "farm-default"}


def _sql_list(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


_HDR_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {_sql_list(v)}" for k, v in HEADERS.items()) + " END"
_LOW = "list_transform(cols, lambda x: lower(x))"


@register("detect_dataset", W(f"""
SELECT file_name, dataset,
       coalesce(nullif(regexp_extract(file_name, '^([a-f0-9]{{20,}})-', 1), ''),
                CASE dataset WHEN 'environmental_metrics' THEN 'weather-default'
                             WHEN 'dairy_production' THEN 'farm-default' END) AS device_id
FROM (
  SELECT file_name,
         CASE WHEN list_has_any({_LOW}, {_sql_list(P.ENV_NAMES)})
                   OR len(list_filter({_LOW}, lambda x: contains(x, 'µg/m') OR contains(x, 'hpa'))) > 0
                THEN 'environmental_metrics'
              WHEN list_has_any({_LOW}, {_sql_list(P.DAIRY_NAMES)})
                   OR len(list_filter({_LOW}, lambda x: contains(x, 'production') AND contains(x, 'cow'))) > 0
                THEN 'dairy_production'
              WHEN list_contains({_LOW}, 'date and time') AND len(cols) = 2 THEN
                CASE WHEN len(list_filter({_LOW}, lambda x: x <> 'date and time' AND contains(x, 'hourly'))) > 0
                     THEN 'energy_hourly' ELSE 'energy_daily' END
         END AS dataset
  FROM (SELECT DISTINCT
               CASE WHEN user_id % 3 = 0 THEN substr(sha256('device-' || CAST(user_id % 7 AS VARCHAR)), 1, 24) || '-'
                    ELSE '' END || event_type || '-' || CAST(user_id % 7 AS VARCHAR) || '.csv' AS file_name,
               {_HDR_CASE} AS cols
        FROM events))"""))
def q_detect_dataset(spark, sf):
    e = table(spark, sf, "events")
    uid = F.col("user_id") % 7
    prefix = F.when(F.col("user_id") % 3 == 0, F.concat(F.substring(F.sha2(F.concat(
        F.lit("device-"), uid.cast("string")), 256), 1, 24), F.lit("-"))).otherwise(F.lit(""))
    name = F.concat(prefix, F.col("event_type"), F.lit("-"), uid.cast("string"), F.lit(".csv"))
    hdr = None
    for k, v in HEADERS.items():
        arr = F.array(*[F.lit(x) for x in v])
        hdr = F.when(F.col("event_type") == k, arr) if hdr is None else hdr.when(F.col("event_type") == k, arr)
    files = e.select(name.alias("file_name"), hdr.alias("cols")).distinct()
    ds = P.detect_dataset(F.col("cols"))
    return files.select("file_name", ds.alias("dataset")).select(
        "file_name", "dataset", P.resolve_device_hint(F.col("dataset"), F.col("file_name"), DEFAULT_DEVICES)
        .alias("device_id"))


_FILE_KEY_SQL = "CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE event_type || '-' || CAST(user_id AS VARCHAR) END"


@register("input_profile", W(f"""
SELECT f.file_id, 'Date and Time' AS time_column, coalesce(p.n_timestamps, 0) AS n_timestamps,
       p.start_date, p.end_date, coalesce(p.granularity, 'daily') AS granularity
FROM (SELECT DISTINCT file_id FROM pf) f
LEFT JOIN (
  SELECT file_id, count(*) AS n_timestamps, min(CAST(t AS DATE)) AS start_date, max(CAST(t AS DATE)) AS end_date,
         CASE WHEN count(*) <= 1 THEN 'daily' WHEN median(gap) < 7200000000 THEN 'hourly' ELSE 'daily' END AS granularity
  FROM (SELECT file_id, t, epoch_us(t) - epoch_us(lag(t) OVER (PARTITION BY file_id ORDER BY t)) AS gap
        FROM pf WHERE t IS NOT NULL)
  GROUP BY file_id) p ON f.file_id = p.file_id""", "energy_feed", ctes=(("pf", f"""
SELECT {_FILE_KEY_SQL.replace('user_id', 'device').replace('event_type', 'et')} AS file_id, {ampm_ts('"Date and Time"')} AS t
FROM (SELECT *, substr(file_id, 6) AS et FROM energy_feed)"""),)))
def q_input_profile(spark, sf):
    f = S.energy_feed(spark, sf)
    et = F.substring("file_id", 6, 100)
    key = F.when(et.isin("click", "view"), et).otherwise(F.concat(et, F.lit("-"), F.col("device").cast("string")))
    t = f.select(key.alias("file_id"), C.datetime_ampm("Date and Time").alias("t"))
    prof = P.time_profile(t, "file_id", "t")
    files = t.select("file_id").distinct()
    cols = list(f.columns)
    tc = P.time_column([c for c in cols if c not in ("file_id", "seq", "device", "received_at")])
    j = files.join(prof, "file_id", "left")
    return j.select("file_id", F.lit(tc).alias("time_column"),
                    F.coalesce("n_timestamps", F.lit(0)).alias("n_timestamps"), "start_date", "end_date",
                    F.coalesce("granularity", F.lit("daily")).alias("granularity"))
