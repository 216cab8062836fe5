"""File-drop ingestion as a batch function and as a Structured Streaming query.

``run_delivery`` is the whole reference pipeline for a set of files at once:
classify → reject unknown/duplicate inputs → map/coerce/validate → stage →
upsert valid rows into month-partitioned facts (one atomic commit per table) → quality checks, run metrics,
input registry and stage log.  ``start_file_stream`` runs it per micro-batch
with ``foreachBatch`` over a file source; the checkpoint plus idempotent
writes (staging, ledger and quality keyed by run id, facts by key upsert,
inputs by content id, a run never counting as its own predecessor) make a
replayed batch change nothing.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from pasture.operators import profile as P
from pasture.operators import snapshots as SN
from pasture.operators import upsert as U
from pasture.operators.joins import join_dimension
from pasture.operators.rules import get_spec, list_datasets
from pasture.plans import ingest as I
from pasture.sources import files as FS
from pasture.streaming.cursors import CursorStore

# User hooks — dataset name → function(DataFrame) → DataFrame applied to raw rows.
_ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_adapter(dataset: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Override extraction/transform for a dataset (applied before validation)."""
    _ADAPTERS[dataset] = fn


@dataclass
class Warehouse:
    """Folder layout of the Parquet warehouse (a shared, durable location on a cluster)."""
    root: str

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)


_exists = U.table_exists
_INFER = "spark.sql.sources.partitionColumnTypeInference.enabled"


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """A warehouse table with its partition values as text: run '001' stays '001'.

    ``like``: the frame it was written from, which gives the schema where nothing has been written yet.
    """
    if like is not None:
        return spark.read.schema(T.StructType([*like.schema.fields]).add("run", "string")).parquet(path)
    before = spark.conf.get(_INFER)
    spark.conf.set(_INFER, "false")          # read when the file listing is made, that is, in load()
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(_INFER, before)


def _append(df: DataFrame, path: str, run_id: str, by: tuple[str, ...] = ()) -> None:
    """Idempotent append: a run (re)writes only its own ``run=`` partition(s)."""
    (df.withColumn("run", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by, "run").parquet(path))


def _fact_rows(staged: DataFrame, spec, devices: DataFrame | None, method: str = "batch") -> DataFrame:
    """Valid staged rows → fact columns (storage types) + provenance."""
    v = staged.filter("is_valid")
    cols = []
    for r in spec.fields:
        c = F.col(r.name)
        if r.store:
            # decimals cannot hold NaN/±Inf (an unbounded field may carry them): stored as NULL
            scale = int(r.store.split(",")[1].rstrip(")"))
            c = F.round(c, scale).try_cast(r.store)
        cols.append(c.alias(r.name))
    out = v.select("file_id", "row_number", "device_hint", "_order", *cols)
    if "energy" in spec.dataset:
        if devices is not None:    # F16: external → internal id (size-checked broadcast)
            d = devices.select(F.col("device_id").alias("device_hint"), F.col("id").alias("device_id"))
            out = join_dimension(out, d, "device_hint", "left")
        else:
            out = out.withColumn("device_id", F.col("device_hint"))
    out = out.withColumns({
        "source_type": FS.source_type_of(F.col("file_id")),
        "source_file": F.col("file_id"),
        "source_device_id": F.col("device_hint"),
        "ingestion_method": F.lit(method),
    })
    return out


_EVENT = ("dataset string, pipeline_name string, stage string, kind string, at timestamp_ntz, status string, "
          "records_in long, records_out long, error_message string, run string")


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


class StageLog:
    """An event file at every stage's start and end, so a stage shows while it runs and after a kill.

    ``close`` folds a run's events into its partition of ``pipeline_execution`` and removes them.
    """

    def __init__(self, spark: SparkSession, wh: Warehouse, run_id: str) -> None:
        self.spark, self.wh, self.run_id = spark, wh, run_id
        self.folder = wh.path("pipeline_events", f"run={run_id}")

    def event(self, dataset: str, stage: str, kind: str, **more) -> None:
        row = {"dataset": dataset, "pipeline_name": f"{dataset}_pipeline", "stage": stage, "kind": kind,
               "at": _now().isoformat(timespec="microseconds"), **more}
        SN.write_text(self.spark, f"{self.folder}/{dataset}-{stage}-{kind}.json", json.dumps(row))

    def stage(self, dataset: str, stage: str):
        log = self

        class _Ctx:
            def __enter__(self):
                self.records_in = self.records_out = None
                log.event(dataset, stage, "start")
                return self

            def __exit__(self, et, ev, tb):
                log.event(dataset, stage, "end", status="success" if et is None else "failed", records_in=self.records_in,
                          records_out=self.records_out, error_message=None if ev is None else repr(ev)[:500])
                return False          # re-raise (G7)
        return _Ctx()

    def close(self) -> None:
        if SN.names(self.spark, self.folder):
            # bounded: two events per stage of one run
            rows = open_stages(self.spark, self.wh).filter(F.col("run") == self.run_id).drop("run")
            _append(rows, self.wh.path("pipeline_execution"), self.run_id)
            U.drop_path(self.spark, self.folder)


_STAGE_COLUMNS = ("dataset", "pipeline_name", "stage", "started_at", "completed_at", "status", "records_in", "records_out",
                  "error_message", "run")


def open_stages(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """G1: stages of runs that have not ended, by their events: ``running`` where nothing follows a start."""
    from pasture.plans import control as K

    path = wh.path("pipeline_events")
    ev = (spark.read.schema(_EVENT).option("recursiveFileLookup", "false").json(path) if _exists(spark, path)
          else spark.createDataFrame([], _EVENT))
    return K.stage_states(ev, ("run", "dataset", "pipeline_name", "stage")).select(*_STAGE_COLUMNS)


def executions(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Every stage of every run, the running and the killed ones among them; a run's open events come before
    what an earlier attempt of the same run has left in the table."""
    live = open_stages(spark, wh)
    path = wh.path("pipeline_execution")
    if not _exists(spark, path):
        return live
    done = read_table(spark, path).select(*_STAGE_COLUMNS)
    return done.join(live.select("run", "dataset", "stage"), ["run", "dataset", "stage"], "left_anti").select(
        *_STAGE_COLUMNS).unionByName(live)


def rejections(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """Inputs rejected and not accepted since: (file, attempts, status, detail, rejected_at) of the last attempt.

    A rejected input is nowhere registered, so offering its file again (mended or not) takes it up anew.
    """
    if not _exists(spark, wh.path("rejected_inputs")):
        return spark.createDataFrame([], "file string, attempts long, status string, detail string, rejected_at timestamp_ntz")
    r = read_table(spark, wh.path("rejected_inputs"))
    r = r.groupBy("file").agg(F.count(F.lit(1)).alias("attempts"), F.max(F.struct("seen_at", "run", "status", "detail")).alias("last"))
    ok = read_table(spark, wh.path("inputs")).filter("status IN ('accepted', 'duplicate')")
    ok = ok.groupBy("file").agg(F.max(F.struct("seen_at", "run")).alias("ok"))
    open_ = r.join(ok, "file", "left").filter("ok IS NULL OR ok < struct(last.seen_at, last.run)")
    return open_.select("file", "attempts", "last.status", "last.detail", F.col("last.seen_at").alias("rejected_at"))


def run_delivery(spark: SparkSession, lines: DataFrame, wh: Warehouse, run_id: str,
                 as_of: _dt.datetime | None = None, devices: DataFrame | None = None,
                 defaults: dict[str, str] | None = None, ingestion_method: str = "batch",
                 offered: DataFrame | None = None, strategies: dict[str, str] | None = None) -> DataFrame:
    """Process every file in ``lines``; returns the per-file registry rows written.

    ``strategies``: conflict strategy by dataset, in place of the mapping's.  Files whose lines carry an ``error``, and files of ``offered`` (file) that have no line, are rejected.
    ``ingestion_method`` is recorded on every fact row: 'batch' or 'streaming' (decision Q3).
    """
    as_of = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    started = _dt.datetime.now(_dt.timezone.utc)
    t0 = F.lit(as_of).cast("timestamp_ntz")
    # one pass over the text: header lines, data lines and content ids all read this copy, so their line ids agree
    kept = wh.path("_tmp", f"lines-{run_id}")
    if "error" not in lines.columns:
        lines = lines.withColumn("error", F.lit(None).cast("string"))
    lines = lines.select("file", "block", "line_id", "line", "cells", "error")
    lines.write.mode("overwrite").parquet(kept)
    lines, broken = FS.split_broken(spark.read.schema(lines.schema).parquet(kept), offered)
    hashes = FS.content_ids(lines)
    lines = FS.join_quoted(lines)
    headers = FS.classify(FS.header_table(lines), defaults)
    reg_path = wh.path("ingest_file")
    registered = (read_table(spark, reg_path).filter(F.col("run") != run_id).select("sha256")
                  if _exists(spark, reg_path) else None)
    files = headers.join(hashes, "file")
    if registered is not None:
        files = files.join(registered.withColumn("_dup", F.lit(True)).dropDuplicates(["sha256"]), "sha256", "left")
    else:
        files = files.withColumn("_dup", F.lit(None).cast("boolean"))
    # one input per content; the rest of the batch and registered contents are duplicates
    first = files.groupBy("sha256").agg(F.min("file").alias("_first"))
    files = files.join(first, "sha256", "left")
    strange = F.lit(False)
    if devices is not None:      # F16: an energy input of a device nobody knows is rejected before anything is staged
        known = devices.select(F.col("device_id").alias("device_hint"), F.lit(True).alias("_known")).dropDuplicates(["device_hint"])
        files = join_dimension(files, known, "device_hint", "left")
        strange = F.col("dataset").contains("energy") & F.col("_known").isNull()
    files = files.withColumn(
        "status", F.when(F.col("dataset").isNull(), "rejected: unknown dataset")
                   .when(F.coalesce(strange, F.lit(False)), "rejected: unknown device")
                   .when(F.col("_dup") | (F.col("file") != F.col("_first")), "duplicate").otherwise("accepted"))
    files = files.select("file", "dataset", "device_hint", "sha256", "status", "header_id", "columns", t0.alias("seen_at"))
    # What cannot be read is an input of its own fate, not of its delivery's
    lost = broken.select("file", F.lit("rejected: unreadable").alias("status"), t0.alias("seen_at"))
    _append(files.unionByName(lost, allowMissingColumns=True), wh.path("inputs"), run_id)
    refused = read_table(spark, wh.path("inputs"), files).filter((F.col("run") == run_id) & F.col("status").startswith("rejected"))
    _append(refused.select("file", "status", "seen_at").join(broken, "file", "left"), wh.path("rejected_inputs"), run_id)
    accepted = read_table(spark, wh.path("inputs"), files).filter((F.col("run") == run_id) & (F.col("status") == "accepted"))
    accepted = accepted.select("file", "header_id", "columns", "dataset", "device_hint")
    present = [r[0] for r in accepted.select("dataset").distinct().collect() if r[0] in list_datasets()]
    fsize = FS.files_bytes(accepted)          # measured, decides the broadcast of the per-file table
    registry = []
    log = StageLog(spark, wh, run_id)
    try:
        for ds in sorted(present):                   # bounded: one pass per known dataset
            registry.append(_load_dataset(spark, lines, accepted, ds, wh, run_id, t0, devices, log, fsize,
                                          ingestion_method, (strategies or {}).get(ds)))
    finally:
        log.close()
    if not registry:
        U.drop_path(spark, kept)
        return spark.createDataFrame([], "file_id string")
    reg = registry[0]
    for r in registry[1:]:
        reg = reg.unionByName(r)
    took = (_dt.datetime.now(_dt.timezone.utc) - started).total_seconds()
    reg = (reg.join(hashes.withColumnRenamed("file", "file_id"), "file_id", "left").withColumn("ingested_at", t0)
              .withColumn("execution_seconds", F.lit(float(took))))
    _append(reg, reg_path, run_id)
    U.drop_path(spark, kept)
    return read_table(spark, reg_path).filter(F.col("run") == run_id)


def _load_facts(spark, facts: DataFrame, spec, wh: Warehouse, run_id: str, t0, time_col: str) -> DataFrame:
    """Upsert fact rows; returns the ledger of the batch rows the table took (F5, F13): all, or the winners of their keys."""
    path = wh.path("facts", spec.target_table)
    took = facts.select("file_id", "row_number")
    skips = spec.strategy in U.KEEP_FIRST and spec.primary_key
    if skips:
        facts = facts.withColumn(U.ROW, F.struct(F.lit(run_id).alias("run"), "file_id", F.col("row_number").cast("long").alias("row_number")))
    snapshot, months = U.commit_upsert(
        spark, facts.drop("file_id", "row_number", "device_hint").withColumn("ingested_at", t0), path, spec.primary_key, time_col,
        spec.strategy, spec.update_columns, seq="_order", grain=spec.partition_by or "month")
    if skips and months:
        took = U.loaded_rows(spark, path, snapshot, months, run_id)
    return took.withColumn("loaded_at", t0)


def _load_dataset(spark, lines, accepted, ds, wh, run_id, t0, devices, log: StageLog,
                  fsize: int | None = None, method: str = "batch", strategy: str | None = None) -> DataFrame:
    spec = get_spec(ds) if strategy is None else replace(get_spec(ds), strategy=strategy)
    with log.stage(ds, "extract") as st:
        rows = FS.dataset_rows(lines, accepted, spec, files_size=fsize)
        if ds in _ADAPTERS:
            rows = _ADAPTERS[ds](rows)
    with log.stage(ds, "validate") as st:
        staged = I.stage_batch(rows, spec, created_at=t0, keep=("file_id", "row_number", "device_hint"))
        # Counts observed while the staging table is written (no extra pass over the data)
        obs = Observation("staged")
        staged = staged.observe(obs, F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("valid"))
        stage_path = wh.path("staging", f"dataset={ds}")
        _append(staged, stage_path, run_id)
        staged = read_table(spark, stage_path, staged).filter(F.col("run") == run_id).drop("run")   # lineage cut
        counts = (obs.get["n"], obs.get["valid"])
        st.records_in, st.records_out = counts[0], counts[1]
    time_col = next(r.name for r in spec.fields if r.type in ("datetime", "date"))
    with log.stage(ds, "load") as st:
        # later files win over earlier ones, then line order
        facts = _fact_rows(staged.withColumn("_order", F.struct("file_id", "row_number")), spec, devices, method)
        if "energy" in ds and devices is not None:
            facts = facts.filter(F.col("device_id").isNotNull())   # F16: unresolved device → not loaded
        ledger = _load_facts(spark, facts, spec, wh, run_id, t0, time_col)
        # what was loaded is a ledger of its own; staging rows never change
        _append(ledger, wh.path("loaded", f"dataset={ds}"), run_id)
        loaded = read_table(spark, wh.path("loaded", f"dataset={ds}"), ledger).filter(F.col("run") == run_id)
        st.records_in, st.records_out = counts[1], loaded.count()
    with log.stage(ds, "quality") as st:
        q = I.error_breakdown(staged, sample_rows=None).unionByName(
            I.overall_quality(staged).drop("summary").withColumn("sample_failures", F.lit(None).cast("string")))
        _append(q.withColumn("dataset", F.lit(ds)).withColumn("checked_at", t0), wh.path("data_quality_checks"),
                run_id, by=("dataset",))
    # device, dates and granularity of every input
    profile = P.time_profile(staged.withColumn("_t", F.col(time_col).cast("timestamp_ntz")), "file_id", "_t").drop("n_timestamps")
    about = accepted.select(F.col("file").alias("file_id"), F.col("device_hint").alias("device"))
    return (I.run_metrics(staged, loaded).withColumn("dataset", F.lit(ds))
            .join(profile, "file_id", "left").join(about, "file_id", "left"))


def ingest_directory(spark: SparkSession, path: str, wh: Warehouse, run_id: str, **kw) -> DataFrame:
    """Batch form: every CSV and .xlsx file under ``path`` (A1, A2, A4, A5); files that cannot be read are rejected."""
    lines = FS.read_lines(spark, path).unionByName(FS.read_excel(spark, path), allowMissingColumns=True)
    return run_delivery(spark, lines, wh, run_id, **{"offered": FS.offered_files(spark, path)} | kw)


def start_file_stream(spark: SparkSession, input_dir: str, wh: Warehouse, checkpoint: str,
                      glob: str = "*.csv", max_files_per_trigger: int | None = 1000,
                      available_now: bool = True, processing_time: str | None = None,
                      archive_dir: str | None = None, workbooks: str | None = "*.xlsx", **kw):
    """Poll ``input_dir``; each micro-batch of new files runs ``run_delivery``.

    Text files and workbooks are two sources of one query with one checkpoint, which records the files consumed, so a
    restart adds nothing.  A workbook that cannot be read is rejected (``rejections``) and the batch goes on.
    ``cleanSource=archive`` moves processed files (the reference's ack); ``workbooks=None`` reads text only.
    """
    def source(kind: str, pattern: str):
        r = spark.readStream.format(kind).option("pathGlobFilter", pattern)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        if archive_dir:
            r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
        return r

    none = {"value": "string", "line_id": "bigint", "line": "string", "cells": "array<string>", "error": "string"}
    src = source("text", glob).load(input_dir).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value",
        *(F.lit(None).cast(t).alias(c) for c, t in none.items() if c != "value"), F.lit(True).alias("is_text"))
    if workbooks:
        books = FS.workbook_lines(source("binaryFile", workbooks).schema(FS._BINARY).load(input_dir))
        src = src.unionByName(books.withColumns({"value": F.lit(None).cast("string"), "is_text": F.lit(False)}))

    def batch(df: DataFrame, batch_id: int) -> None:
        text = FS.parse_lines(df.filter("is_text").select("value", "file", "block"))
        sheets = df.filter("NOT is_text").select("file", "block", "line_id", "line", "cells", "error")
        run_delivery(spark, text.unionByName(sheets, allowMissingColumns=True), wh, f"batch-{batch_id:08d}",
                     ingestion_method="streaming", **kw)

    w = src.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    return w.start()


# Sensors accepted from the sensor API (the allow-list of the reference's connector).
API_SENSORS = ("temperature", "humidity", "pm10", "pm2p5", "atm_pressure", "noise_level_db",
               "wind_speed", "wind_direction", "wind_angle")
_API_COLUMN = {"wind_direction": "wind_direction_sectors"}


def ingest_responses(spark: SparkSession, path: str, wh: Warehouse, run_id: str, endpoint: str = "sensors",
                     connector: str = "sensor_api", as_of: _dt.datetime | None = None,
                     dataset: str = "api_environmental_metrics", compact_after: int = 50) -> DataFrame:
    """§3.2 API entry point over landed responses (A3, B2, B3, E10, F8, F19, J4); see ``load_responses``."""
    return load_responses(spark, FS.read_responses(spark, path), wh, run_id, endpoint, connector, as_of, dataset, compact_after)


def start_response_stream(spark: SparkSession, input_dir: str, wh: Warehouse, checkpoint: str, glob: str = "*.json",
                          max_files_per_trigger: int | None = 1000, available_now: bool = True,
                          processing_time: str | None = None, **kw):
    """Poll ``input_dir`` for landed responses; each micro-batch runs ``load_responses`` under a run id of its own, so
    a batch that is repeated after a crash rewrites its own partitions and counts its fetches once."""
    r = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = r.load(input_dir).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))

    def batch(df: DataFrame, batch_id: int) -> None:
        load_responses(spark, df, wh, f"response-{batch_id:08d}", **kw)

    w = src.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    return w.start()


def load_responses(spark: SparkSession, resp: DataFrame, wh: Warehouse, run_id: str, endpoint: str = "sensors",
                   connector: str = "sensor_api", as_of: _dt.datetime | None = None,
                   dataset: str = "api_environmental_metrics", compact_after: int = 50) -> DataFrame:
    """Load responses (file, body) as one run.

    One JSON response per file, named ``<device>-….json``.  Sensors are
    pivoted to wide rows, validated with the API dataset's rules, upserted by
    (device, timestamp), and the fetch cursor of every device advances to the
    newest loaded reading.  Once more than ``compact_after`` runs lie in the fetch
    log, they are folded into the cursor state.  Returns the new cursor rows.
    """
    from pasture.operators import reshape as R

    as_of = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    t0 = F.lit(as_of).cast("timestamp_ntz")
    spec = get_spec(dataset)
    name = F.element_at(F.split("file", "/"), -1)
    resp = resp.withColumn("device_hint", F.coalesce(P.device_from_name(name),
                                                     F.regexp_extract(name, r"^([^-.]+)", 1)))
    wide = R.sensor_pivot(R.sensor_objects(resp, "body"), "sensors", ["file", "device_hint"], API_SENSORS)
    raw = wide.select(F.col("file").alias("file_id"), "device_hint", F.col("timestamp"),
                      *[F.col(s).cast("string").alias(_API_COLUMN.get(s, s)) for s in API_SENSORS])
    raw = R.row_numbers(raw, "file_id", "timestamp", bucket=F.lit(0))
    staged = I.stage_batch(raw, spec, created_at=t0, keep=("file_id", "row_number", "device_hint"))
    stage_path = wh.path("staging", f"dataset={dataset}")
    _append(staged, stage_path, run_id)
    staged = read_table(spark, stage_path, staged).filter(F.col("run") == run_id).drop("run")      # lineage cut
    staged = staged.withColumn("_order", F.col("row_number").cast("long"))
    facts = _fact_rows(staged, spec, None).withColumn("source_type", F.lit("api")).withColumn(
        "source_api_endpoint", F.lit(endpoint))
    _append(_load_facts(spark, facts, spec, wh, run_id, t0, "timestamp"), wh.path("loaded", f"dataset={dataset}"), run_id)
    # one fetch per response and run, so a run replayed counts once; the newest reading orders them
    fetches = staged.filter("is_valid").groupBy("file_id", "device_hint").agg(F.max("timestamp").alias("fetched_at"))
    fetches = fetches.join(resp.select(F.col("file").alias("file_id"), F.sha2("body", 256).alias("sha256")), "file_id")
    fetches = fetches.groupBy("device_hint", "sha256").agg(F.max("fetched_at").alias("fetched_at"))
    fetches = fetches.select(F.lit(connector).alias("connector_id"), F.lit(endpoint).alias("endpoint_id"),
                             F.col("device_hint").alias("device_id"), "fetched_at", "sha256")
    log_path = wh.path("api_fetch_log")
    _append(fetches, log_path, run_id)
    store = CursorStore(spark, wh.root)
    if store.open_runs() > compact_after:
        store.compact()
    return store.read()


def cursors(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The fetch cursor of every device: the compacted state and the fetches that came after it."""
    return CursorStore(spark, wh.root).read()


def purge_staging(spark: SparkSession, wh: Warehouse, as_of: _dt.datetime, days: int = 7) -> DataFrame:
    """delete loaded staging rows older than ``days``; returns (table_name, deleted_count).

    Loaded is what the ledger says.  A run that keeps rows gets its new partition in one dynamic overwrite; only then
    are runs that keep nothing removed.  Stopped in between, a second call finishes the work; no kept row is ever
    without a copy in the table.
    """
    root = wh.path("staging")
    if not _exists(spark, root):
        return spark.createDataFrame([], "table_name string, deleted_count long")
    st = read_table(spark, root)
    key = ["dataset", "run", "file_id", "row_number"]
    done = (spark.read.schema("file_id string, row_number long, loaded_at timestamp_ntz, dataset string, run string")
            .parquet(wh.path("loaded")).select(*key).distinct().withColumn("_loaded", F.lit(True))
            if _exists(spark, wh.path("loaded")) else None)
    st = st.withColumn("_loaded", F.lit(None).cast("boolean")) if done is None else st.join(done, key, "left")
    old = F.coalesce(F.col("_loaded"), F.lit(False)) & (F.col("created_at") < F.lit(as_of).cast("timestamp_ntz")
                                                        - F.make_dt_interval(F.lit(days)))
    st = st.withColumn("_old", old)
    counts = (st.groupBy("dataset", "run").agg(F.count_if("_old").alias("gone"), F.count_if(~F.col("_old")).alias("kept"))
                .filter("gone > 0").withColumn("gone", F.col("gone").cast("long")))
    runs = counts.collect()                                            # bounded: one row per run with old rows
    tables = [r[0] for r in st.select("dataset").distinct().collect()]
    result = [(f"staging_{t}", sum(r["gone"] for r in runs if r["dataset"] == t)) for t in sorted(tables)]
    part = [(r["dataset"], r["run"]) for r in runs if r["kept"]]
    if part:
        keys = spark.createDataFrame(part, "dataset string, run string")
        kept = st.filter(~F.col("_old")).drop("_old", "_loaded").join(F.broadcast(keys), ["dataset", "run"], "left_semi")
        tmp = wh.path("_tmp", f"purge-{as_of:%Y%m%d%H%M%S}")
        kept.write.mode("overwrite").parquet(tmp)
        (spark.read.schema(kept.schema).parquet(tmp).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("dataset", "run").parquet(root))
        U.drop_path(spark, tmp)
    for r in runs:
        if not r["kept"]:
            U.drop_path(spark, wh.path("staging", f"dataset={r['dataset']}", f"run={r['run']}"))
    return spark.createDataFrame(result, "table_name string, deleted_count long")
