"""Control tables: inputs, devices, cursors, staging ledger, stage log.

All are set operations over append-only tables; what the reference does with
UPDATE statements becomes a join of the append log with its ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pasture.functions.numeric import epoch_micros
from pasture.operators.joins import join_dimension


# ------------------------------------------------------------------ inputs

def new_inputs(batch: DataFrame, registered: DataFrame, sha: str = "sha256", name: str = "file_name") -> DataFrame:
    """inputs whose content hash is not registered; one input per hash in the batch.

    The anti join shuffles only the hash column of the registry; among inputs
    sharing a hash the smallest name is kept (deterministic, unlike dropDuplicates).
    """
    fresh = batch.join(registered.select(sha).distinct(), sha, "left_anti")
    return fresh.groupBy(sha).agg(F.min(name).alias(name))


def content_hash(*parts: Column, sep: str = "|") -> Column:
    """sha256 over a deterministic description of an input (no wall clock)."""
    return F.sha2(F.concat_ws(sep, *[p.cast("string") for p in parts]), 256)


def file_sha256(binary_files: DataFrame) -> DataFrame:
    """A5: content hash of whole files read with ``format('binaryFile')``."""
    return binary_files.select("path", "length", F.sha2(F.col("content"), 256).alias("sha256"))


# ------------------------------------------------------------------ devices

def resolve_device(inputs: DataFrame, device: DataFrame, ext_col: str = "external_id") -> DataFrame:
    """F16: external → internal device id; unresolved inputs are marked rejected."""
    d = device.select(F.col("device_id").alias(ext_col), F.col("id").alias("internal_id"))
    j = join_dimension(inputs, d, ext_col, "left")
    return j.withColumn("rejected", F.col("internal_id").isNull())


def devices_by_type(device: DataFrame, device_type: str, status: str | None = "online") -> DataFrame:
    """devices of a type (and status) with the JSON external id."""
    f = device.filter(F.col("device_type") == device_type)
    if status is not None:
        f = f.filter(F.col("status") == status)
    return f.withColumn("external_id", F.coalesce(F.get_json_object("metadata", "$.external_id"), F.col("device_id")))


def migrate_devices(legacy: DataFrame, generic: DataFrame) -> DataFrame:
    """legacy devices inserted into the unified table if absent (ON CONFLICT DO NOTHING)."""
    new = legacy.join(generic.select("device_id"), "device_id", "left_anti")
    migrated = new.select(
        "device_id", F.lit("energy").alias("device_type"),
        F.coalesce(F.col("alias"), F.lit("")).alias("alias"),
        F.coalesce(F.col("client"), F.lit("Unknown")).alias("client"),
        F.to_json(F.struct(F.col("name"), F.col("device_token")), {"ignoreNullFields": "false"}).alias("metadata"))
    return generic.select("device_id", "device_type", "alias", "client", "metadata").unionByName(migrated)


# ------------------------------------------------------------------ cursors

TRIPLE = ("connector_id", "endpoint_id", "device_id")


def cursor_upsert(old: DataFrame, fetches: DataFrame, ts: str = "fetched_at", seq: str = "seq") -> DataFrame:
    """new cursor state: last fetch time (by order), fetch count incremented per fetch."""
    new = fetches.groupBy(*TRIPLE).agg(F.max_by(ts, seq).alias("_ts"), F.count(F.lit(1)).alias("_n"))
    j = old.join(new, list(TRIPLE), "full")
    return j.select(*TRIPLE,
                    F.coalesce("_ts", "last_fetch_timestamp").alias("last_fetch_timestamp"),
                    F.coalesce("_ts", "last_fetch_success").alias("last_fetch_success"),
                    (F.coalesce("fetch_count", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("fetch_count"))


def max_reading(readings: DataFrame, device: str = "source_device_id", ts: str = "timestamp") -> DataFrame:
    """high-water mark per device."""
    return readings.groupBy(device).agg(F.max(ts).alias("max_ts"))


def next_window(devices: DataFrame, cursors: DataFrame, readings_hw: DataFrame, as_of: Column,
                lookback_days: int = 1, key: str = "device_id") -> DataFrame:
    """next fetch window per device — cursor (or reading high-water) + 1 h, else as_of − lookback."""
    j = devices.join(cursors, key, "left").join(readings_hw, key, "left")
    start = F.coalesce(F.col("cursor_ts"), F.col("max_ts")) + F.make_dt_interval(F.lit(0), F.lit(1))
    return j.select(key, F.coalesce(start, as_of - F.make_dt_interval(F.lit(lookback_days))).alias("start_ts"),
                    as_of.alias("end_ts"),
                    F.when(F.col("cursor_ts").isNotNull(), "cursor").when(F.col("max_ts").isNotNull(), "readings")
                     .otherwise("lookback").alias("basis"))


def page_cursor(pages: DataFrame, endpoint: str = "endpoint_id", page: str = "page") -> DataFrame:
    """pagination state per endpoint from landed pages: offset, time and cursor advance."""
    return pages.groupBy(endpoint).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("record_count").alias("next_offset"),
        F.max("max_ts").alias("max_ts"),
        F.max_by("next_cursor", page).alias("last_cursor"),
        (F.max(page) + 1).alias("next_page"))


# ------------------------------------------------------------------ staging ledger

def staging_stats(staged: DataFrame, loaded: DataFrame) -> DataFrame:
    """total, valid, invalid, loaded and pending (valid − loaded) per file."""
    s = staged.join(loaded.select("file_id", "row_number").withColumn("_loaded", F.lit(True)),
                    ["file_id", "row_number"], "left")
    g = s.groupBy("file_id").agg(F.count(F.lit(1)).alias("total"), F.count_if("is_valid").alias("valid"),
                                 F.count_if(~F.col("is_valid")).alias("invalid"),
                                 F.count_if(F.col("_loaded").isNotNull()).alias("loaded"))
    return g.withColumn("pending", F.col("valid") - F.col("loaded"))


def pending_rows(staged: DataFrame, loaded: DataFrame) -> DataFrame:
    """valid rows not yet loaded (anti join with the loaded ledger)."""
    return staged.filter("is_valid").join(loaded.select("file_id", "row_number"), ["file_id", "row_number"], "left_anti")


def invalid_rows(staged: DataFrame) -> DataFrame:
    """invalid rows with their errors."""
    return staged.filter(~F.col("is_valid"))


def retention_counts(staged: DataFrame, loaded: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """rows a retention purge deletes (loaded and older than ``days``), per file."""
    old = staged.filter(F.col("created_at") < as_of - F.make_dt_interval(F.lit(days)))
    d = old.join(loaded.select("file_id", "row_number"), ["file_id", "row_number"], "left_semi")
    return d.groupBy(F.col("file_id").alias("table_name")).agg(F.count(F.lit(1)).alias("deleted_count"))


# ------------------------------------------------------------------ stage log

def stage_log(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """pipeline_execution = start events ⟕ end events on (run, stage)."""
    j = starts.join(ends, ["run_id", "stage"], "left")
    return j.select("run_id", "file_id", "stage", "started_at", "completed_at",
                    F.coalesce("status", F.lit("running")).alias("status"),
                    (epoch_micros(F.col("completed_at"), F.col("started_at")) / F.lit(1e6)).alias("duration_seconds"))


def stage_states(events: DataFrame, keys: tuple[str, ...] = ("run_id", "stage")) -> DataFrame:
    """The state of every stage from its start and end events (``kind``, ``at``, and what an end event says).

    The last event decides: an end closes the attempt with its status, a start that no end follows is ``running``, also
    where an earlier attempt has ended.  At one instant an end comes after a start.
    """
    what = [c for c in events.columns if c not in (*keys, "kind", "at")]
    last = F.max(F.struct("at", F.when(F.col("kind") == "end", 1).otherwise(0).alias("closed"), *what)).alias("last")
    g = events.groupBy(*keys).agg(last, F.max(F.when(F.col("kind") == "start", F.col("at"))).alias("started_at"))
    closed = F.col("last.closed") == 1
    cols = [F.when(closed, F.col(f"last.{c}")).alias(c) for c in what if c != "status"]
    return g.select(*keys, "started_at", F.when(closed, F.col("last.at")).alias("completed_at"),
                    F.when(closed, F.col("last.status")).otherwise("running").alias("status"), *cols)
