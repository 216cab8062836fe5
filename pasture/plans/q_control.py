"""Catalogue entries for upsert, staging ledger, inputs, devices, cursors and stage log (F, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasture.operators import upsert as U
from pasture.plans import control as K
from pasture.plans.oracle import cents, micros, with_standins as W
from pasture.plans.q_ingest import _CHECKED, staged_feed
from pasture.plans.registry import register
from pasture.sources import standins as S
from pasture.sources.tables import table

KEYS = ["device", "hour"]


def _keyed(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.col("user_id").alias("device"), F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("hour"),
                    "value", F.col("event_type").alias("sensor"), F.col("event_id").alias("seq"))


def _target_batch(spark, sf):
    k = _keyed(spark, sf)
    target = U.upsert(None, k.filter(F.col("seq") % 2 == 0), KEYS, "ignore", seq="seq").drop("seq")
    return target, k.filter(F.col("seq") % 2 == 1)


_T = """
SELECT user_id AS device, date_trunc('hour', ts) AS hour, arg_min(value, event_id) AS value,
       arg_min(event_type, event_id) AS sensor
FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2"""
_B = """
SELECT user_id AS device, date_trunc('hour', ts) AS hour, value, event_type AS sensor, event_id AS seq
FROM events WHERE event_id % 2 = 1"""
_U = "SELECT device, hour, value, sensor, -1 AS ord FROM t UNION ALL SELECT device, hour, value, sensor, seq FROM b"
_TBU = (("t", _T), ("b", _B), ("u", _U))


@register("upsert_update", W("""
SELECT device, hour, arg_max(value, ord) AS value, arg_min(sensor, ord) AS sensor FROM u GROUP BY device, hour""",
                             ctes=_TBU))
def q_upsert_update(spark, sf):
    t, b = _target_batch(spark, sf)
    return U.upsert(t, b, KEYS, "update", ["value"], seq="seq").drop("seq")


@register("upsert_ignore", W("""
SELECT device, hour, arg_min(value, ord) AS value, arg_min(sensor, ord) AS sensor FROM u GROUP BY device, hour""",
                             ctes=_TBU))
def q_upsert_ignore(spark, sf):
    t, b = _target_batch(spark, sf)
    return U.upsert(t, b, KEYS, "append", seq="seq").drop("seq")


@register("upsert_conflicts", W("""
SELECT device, hour, count(*) AS rows FROM u GROUP BY device, hour HAVING count(*) > 1""", ctes=_TBU))
def q_upsert_conflicts(spark, sf):
    t, b = _target_batch(spark, sf)
    return U.conflict_keys(t, b, KEYS)


_KX = """
SELECT kb.device, kb.hour, kb.n, tk.device IS NOT NULL AS ex
FROM (SELECT device, hour, count(*) AS n FROM b GROUP BY device, hour) kb
LEFT JOIN (SELECT DISTINCT device, hour FROM t) tk ON kb.device = tk.device AND kb.hour = tk.hour"""


@register("upsert_outcome", W("""
SELECT 'update' AS strategy, CAST(sum(n) AS BIGINT) AS batch_rows, CAST(sum(n) AS BIGINT) AS loaded,
       CAST(0 AS BIGINT) AS skipped, count(*) FILTER (WHERE NOT ex) AS inserted_keys,
       count(*) FILTER (WHERE ex) AS updated_keys FROM kx
UNION ALL
SELECT 'ignore', CAST(sum(n) AS BIGINT), count(*) FILTER (WHERE NOT ex),
       CAST(sum(n) - count(*) FILTER (WHERE NOT ex) AS BIGINT),
       count(*) FILTER (WHERE NOT ex), count(*) FILTER (WHERE ex) FROM kx""", ctes=(*_TBU, ("kx", _KX))))
def q_upsert_outcome(spark, sf):
    t, b = _target_batch(spark, sf)
    return U.outcome(t, b, KEYS, "update").unionByName(U.outcome(t, b, KEYS, "ignore"))


@register("insert_plain", W("""
SELECT device, hour, value, sensor FROM t UNION ALL SELECT device, hour, value, sensor FROM b""", ctes=_TBU))
def q_insert_plain(spark, sf):
    t, b = _target_batch(spark, sf)
    return U.upsert(t, b.drop("seq"), [])


# ------------------------------------------------------------------ staging ledger

def _loaded(staged):
    """Ledger of rows already loaded: every third valid row (stand-in for earlier loads)."""
    return staged.filter(F.col("is_valid") & (F.col("row_number") % 3 == 0)).select("file_id", "row_number")


_LOADED = "SELECT file_id, row_number FROM checked WHERE is_valid AND row_number % 3 = 0"


def _st(body, *extra):
    return W(body, "feed", ctes=(("checked", _CHECKED), ("loaded", _LOADED), *extra))


@register("staging_stats", _st("""
SELECT c.file_id, count(*) AS total, count(*) FILTER (WHERE is_valid) AS valid,
       count(*) FILTER (WHERE NOT is_valid) AS invalid, count(l.row_number) AS loaded,
       count(*) FILTER (WHERE is_valid) - count(l.row_number) AS pending
FROM checked c LEFT JOIN loaded l ON c.file_id = l.file_id AND c.row_number = l.row_number
GROUP BY c.file_id"""))
def q_staging_stats(spark, sf):
    s = staged_feed(spark, sf)
    return K.staging_stats(s, _loaded(s))


@register("pending_rows", _st("""
SELECT c.file_id, c.row_number, c.ts, c.energy_kwh FROM checked c
WHERE c.is_valid AND NOT EXISTS (SELECT 1 FROM loaded l WHERE l.file_id = c.file_id AND l.row_number = c.row_number)"""))
def q_pending_rows(spark, sf):
    s = staged_feed(spark, sf)
    return K.pending_rows(s, _loaded(s)).select("file_id", "row_number", "ts", "energy_kwh")


@register("invalid_rows", _st("""
SELECT file_id, row_number, raw_data, error_count FROM checked WHERE NOT is_valid"""))
def q_invalid_rows(spark, sf):
    s = staged_feed(spark, sf)
    return K.invalid_rows(s).select("file_id", "row_number", "raw_data", F.size("errors").alias("error_count"))


@register("invalid_sample", _st("""
SELECT file_id, row_number, raw_data, error_count FROM checked WHERE NOT is_valid
ORDER BY file_id, row_number LIMIT 10"""))
def q_invalid_sample(spark, sf):
    s = staged_feed(spark, sf)
    return (K.invalid_rows(s).select("file_id", "row_number", "raw_data", F.size("errors").alias("error_count"))
             .orderBy("file_id", "row_number").limit(10))


@register("retention_counts", _st("""
SELECT c.file_id AS table_name, count(*) AS deleted_count
FROM checked c JOIN loaded l ON c.file_id = l.file_id AND c.row_number = l.row_number
WHERE c.created_at < (SELECT max(created_at) FROM checked) - INTERVAL 7 DAY
GROUP BY c.file_id"""))
def q_retention_counts(spark, sf):
    s = staged_feed(spark, sf)
    as_of = s.select(F.max("created_at")).scalar()
    return K.retention_counts(s, _loaded(s), as_of)


@register("staged_recent_totals", _st("""
SELECT count(*) AS total, count(*) FILTER (WHERE is_valid) AS valid, count(*) FILTER (WHERE NOT is_valid) AS invalid
FROM checked WHERE created_at >= (SELECT max(created_at) FROM checked) - INTERVAL 24 HOUR"""))
def q_staged_recent_totals(spark, sf):
    s = staged_feed(spark, sf)
    as_of = s.select(F.max("created_at")).scalar()
    r = s.filter(F.col("created_at") >= as_of - F.make_dt_interval(F.lit(0), F.lit(24)))
    return r.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_valid").alias("valid"),
                 F.count_if(~F.col("is_valid")).alias("invalid"))


# ------------------------------------------------------------------ inputs

def _inputs(spark, sf):
    e = table(spark, sf, "events")
    day = F.to_date("ts")
    g = e.groupBy("event_type", day.alias("day")).agg(F.count(F.lit(1)).alias("n"),
                                                       F.sum(F.round(F.col("value") * 100).cast("long")).alias("c"))
    files = g.select(F.concat_ws("-", "event_type", F.col("day").cast("string")).alias("file_name"),
                     K.content_hash(F.col("event_type"), F.col("day"), F.col("n"), F.col("c")).alias("sha256"), "day")
    copies = files.filter(F.dayofmonth("day") % 5 == 0).withColumn("file_name", F.concat("file_name", F.lit(".copy")))
    batch = files.unionByName(copies)
    registered = files.filter(F.dayofmonth("day") % 2 == 0)
    return batch, registered


_FILES = f"""
SELECT event_type || '-' || CAST(day AS VARCHAR) AS file_name,
       sha256(event_type || '|' || CAST(day AS VARCHAR) || '|' || CAST(n AS VARCHAR) || '|' || CAST(c AS VARCHAR)) AS sha256,
       day
FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, sum({cents('value')}) AS c
      FROM events GROUP BY 1, 2)"""


@register("new_inputs", W("""
SELECT sha256, min(file_name) AS file_name FROM batch
WHERE sha256 NOT IN (SELECT sha256 FROM files WHERE day(day) % 2 = 0)
GROUP BY sha256""", ctes=(("files", _FILES), ("batch", """
SELECT file_name, sha256, day FROM files
UNION ALL SELECT file_name || '.copy', sha256, day FROM files WHERE day(day) % 5 = 0"""))))
def q_new_inputs(spark, sf):
    batch, registered = _inputs(spark, sf)
    return K.new_inputs(batch, registered)


@register("sha256_keys", W("""
SELECT event_type AS endpoint, user_id AS device, count(*) AS records,
       sha256(event_type || ':' || CAST(user_id AS VARCHAR) || ':' || strftime(min(ts), '%Y-%m-%d %H:%M:%S')
              || ':' || strftime(max(ts), '%Y-%m-%d %H:%M:%S') || ':' || CAST(count(*) AS VARCHAR)) AS sha256
FROM events GROUP BY event_type, user_id"""))
def q_sha256_keys(spark, sf):
    e = table(spark, sf, "events")
    g = e.groupBy(F.col("event_type").alias("endpoint"), F.col("user_id").alias("device")).agg(
        F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.count(F.lit(1)).alias("records"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return g.select("endpoint", "device", "records",
                    K.content_hash(F.col("endpoint"), F.col("device"), F.date_format("t0", fmt),
                                   F.date_format("t1", fmt), F.col("records"), sep=":").alias("sha256"))


# ------------------------------------------------------------------ devices

def _user_inputs(spark, sf):
    e = table(spark, sf, "events").select("user_id").distinct()
    ext = F.substring(F.sha2(F.concat(F.lit("device-"), (F.col("user_id") % 120).cast("string")), 256), 1, 24)
    return e.select("user_id", ext.alias("external_id"))


@register("resolve_device", W("""
SELECT u.user_id, u.external_id, d.id AS internal_id, d.id IS NULL AS rejected
FROM (SELECT DISTINCT user_id, substr(sha256('device-' || CAST(user_id % 120 AS VARCHAR)), 1, 24) AS external_id
      FROM events) u
LEFT JOIN device d ON u.external_id = d.device_id""", "device"))
def q_resolve_device(spark, sf):
    return K.resolve_device(_user_inputs(spark, sf), S.devices(spark, sf)).select(
        "user_id", "external_id", "internal_id", "rejected")


def _legacy_generic(spark, sf):
    d = S.devices(spark, sf)
    legacy = d.select(
        "device_id", F.col("alias").alias("name"), "device_token",
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("alias")).alias("alias"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("client")).alias("client"))
    generic = d.filter(F.col("id") % 4 == 0)
    return legacy, generic


@register("migrate_devices", W("""
SELECT device_id, device_type, alias, client, metadata FROM device WHERE id % 4 = 0
UNION ALL
SELECT device_id, 'energy', coalesce(CASE WHEN id % 5 = 0 THEN NULL ELSE alias END, ''),
       coalesce(CASE WHEN id % 7 = 0 THEN NULL ELSE client END, 'Unknown'),
       '{"name":"' || alias || '","device_token":"' || device_token || '"}'
FROM device WHERE device_id NOT IN (SELECT device_id FROM device WHERE id % 4 = 0)""", "device"))
def q_migrate_devices(spark, sf):
    legacy, generic = _legacy_generic(spark, sf)
    return K.migrate_devices(legacy, generic)


# ------------------------------------------------------------------ cursors

def _fetches(spark, sf):
    e = table(spark, sf, "events")
    half = e.select(F.max("event_id")).scalar() / 2
    f = e.select(F.lit("sensor_api").alias("connector_id"), F.col("event_type").alias("endpoint_id"),
                 F.col("user_id").alias("device_id"), F.col("ts").alias("fetched_at"), F.col("event_id").alias("seq"))
    old = (f.filter(F.col("seq") < half).groupBy(*K.TRIPLE)
            .agg(F.max_by("fetched_at", "seq").alias("last_fetch_timestamp"),
                 F.max_by("fetched_at", "seq").alias("last_fetch_success"),
                 F.count(F.lit(1)).alias("fetch_count")))
    return old, f.filter(F.col("seq") >= half)


_FETCH = """
SELECT 'sensor_api' AS connector_id, event_type AS endpoint_id, user_id AS device_id, ts AS fetched_at, event_id AS seq
FROM events"""
_OLD = """
SELECT connector_id, endpoint_id, device_id, arg_max(fetched_at, seq) AS last_fetch_timestamp, count(*) AS fetch_count
FROM fetches WHERE seq < (SELECT max(event_id) FROM events) / 2 GROUP BY 1, 2, 3"""
_NEW = """
SELECT connector_id, endpoint_id, device_id, arg_max(fetched_at, seq) AS ts, count(*) AS n
FROM fetches WHERE seq >= (SELECT max(event_id) FROM events) / 2 GROUP BY 1, 2, 3"""


@register("cursor_upsert", W("""
SELECT coalesce(o.connector_id, n.connector_id) AS connector_id, coalesce(o.endpoint_id, n.endpoint_id) AS endpoint_id,
       coalesce(o.device_id, n.device_id) AS device_id,
       coalesce(n.ts, o.last_fetch_timestamp) AS last_fetch_timestamp,
       coalesce(n.ts, o.last_fetch_timestamp) AS last_fetch_success,
       coalesce(o.fetch_count, 0) + coalesce(n.n, 0) AS fetch_count
FROM old o FULL OUTER JOIN new n
  ON o.connector_id = n.connector_id AND o.endpoint_id = n.endpoint_id AND o.device_id = n.device_id""",
                             ctes=(("fetches", _FETCH), ("old", _OLD), ("new", _NEW))))
def q_cursor_upsert(spark, sf):
    old, new = _fetches(spark, sf)
    return K.cursor_upsert(old, new)


@register("cursor_next_window", W("""
SELECT u.device_id,
       coalesce(coalesce(c.cursor_ts, r.max_ts) + INTERVAL 1 HOUR, (SELECT max(ts) FROM events) - INTERVAL 1 DAY) AS start_ts,
       (SELECT max(ts) FROM events) AS end_ts,
       CASE WHEN c.cursor_ts IS NOT NULL THEN 'cursor' WHEN r.max_ts IS NOT NULL THEN 'readings' ELSE 'lookback' END AS basis
FROM (SELECT DISTINCT user_id AS device_id FROM events) u
LEFT JOIN (SELECT device_id, max(last_fetch_timestamp) AS cursor_ts FROM old
           WHERE device_id IN (SELECT user_id FROM events GROUP BY 1 HAVING arg_max(event_type, event_id) <> 'error') GROUP BY 1) c
  ON u.device_id = c.device_id
LEFT JOIN (SELECT user_id AS device_id, max(ts) AS max_ts FROM events GROUP BY 1
           HAVING arg_min(event_type, event_id) <> 'signup') r ON u.device_id = r.device_id""", ctes=(("fetches", _FETCH), ("old", _OLD))))
def q_cursor_next_window(spark, sf):
    """A device whose newest event is an error has lost its cursor; one that began with a sign-up has no readings yet."""
    old, _ = _fetches(spark, sf)
    e = table(spark, sf, "events")
    ends = e.groupBy(F.col("user_id").alias("device_id")).agg(
        F.max_by("event_type", "event_id").alias("newest"), F.min_by("event_type", "event_id").alias("oldest"))
    devices = ends.select("device_id")
    cursors = old.groupBy("device_id").agg(F.max("last_fetch_timestamp").alias("cursor_ts"))
    cursors = cursors.join(ends.filter("newest != 'error'"), "device_id", "left_semi")
    hw = K.max_reading(e, "user_id", "ts").withColumnRenamed("user_id", "device_id")
    hw = hw.join(ends.filter("oldest != 'signup'"), "device_id", "left_semi")
    as_of = e.select(F.max("ts")).scalar()
    return K.next_window(devices, cursors, hw, as_of)


@register("page_cursor", W("""
SELECT endpoint_id, count(*) AS pages, CAST(sum(record_count) AS BIGINT) AS next_offset, max(max_ts) AS max_ts,
       arg_max(next_cursor, page) AS last_cursor, max(page) + 1 AS next_page
FROM (SELECT event_type AS endpoint_id, event_id // 100 AS page, count(*) AS record_count, max(ts) AS max_ts,
             'c' || CAST(max(event_id) AS VARCHAR) AS next_cursor
      FROM events GROUP BY 1, 2)
GROUP BY endpoint_id"""))
def q_page_cursor(spark, sf):
    e = table(spark, sf, "events")
    pages = e.groupBy(F.col("event_type").alias("endpoint_id"),
                      ((F.col("event_id") - F.col("event_id") % 100) / 100).cast("long").alias("page")).agg(
        F.count(F.lit(1)).alias("record_count"), F.max("ts").alias("max_ts"),
        F.concat(F.lit("c"), F.max("event_id").cast("string")).alias("next_cursor"))
    return K.page_cursor(pages)


# ------------------------------------------------------------------ stage log

@register("stage_log", W(f"""
SELECT s.execution_id AS run_id, s.file_id, s.stage, s.started_at, e.completed_at,
       coalesce(e.status, 'running') AS status,
       {micros('e.completed_at', 's.started_at')} / 1000000.0 AS duration_seconds
FROM exec_log s
LEFT JOIN (SELECT execution_id, stage, completed_at, status FROM exec_log WHERE completed_at IS NOT NULL) e
  ON s.execution_id = e.execution_id AND s.stage = e.stage""", "exec_log"))
def q_stage_log(spark, sf):
    x = S.exec_log(spark, sf)
    starts = x.select(F.col("execution_id").alias("run_id"), "file_id", "stage", "started_at")
    ends = x.filter(F.col("completed_at").isNotNull()).select(
        F.col("execution_id").alias("run_id"), "stage", "completed_at", "status")
    return K.stage_log(starts, ends)


@register("devices_online", W("""
SELECT *, coalesce(json_extract_string(metadata, '$.external_id'), device_id) AS external_id
FROM device WHERE device_type = 'weather' AND status = 'online'""", "device"))
def q_devices_online(spark, sf):
    return K.devices_by_type(S.devices(spark, sf), "weather", "online")
