"""Fetch cursors: a compacted state with the tail of the fetch log, and a stream of next windows.

    <root>/api_fetch_log/run=<run>/…    one row per response and device; a run rewrites only its own folder
    <root>/api_cursors/                 table of snapshots: partition ``state`` (one row per cursor) and ``runs`` (folded)

A cursor is (newest reading, number of fetches).  Two of them merge by maximum and sum, so it does not matter which runs
the state holds and which still lie in the log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pasture.operators import snapshots as SN
from pasture.operators import upsert as U
from pasture.plans.control import TRIPLE

LOG = "connector_id string, endpoint_id string, device_id string, fetched_at timestamp_ntz, sha256 string"
_STATE = ("connector_id string, endpoint_id string, device_id string, last_fetch_timestamp timestamp_ntz, fetch_count long, "
          "folder string, kind string")


def merge(states: DataFrame) -> DataFrame:
    """partial cursors (``last_fetch_timestamp``, ``fetch_count``) → one per connector, endpoint and device."""
    return states.groupBy(*TRIPLE).agg(F.max("last_fetch_timestamp").alias("last_fetch_timestamp"),
                                       F.sum("fetch_count").alias("fetch_count"))


def _of_log(log: DataFrame) -> DataFrame:
    return log.select(*TRIPLE, F.col("fetched_at").alias("last_fetch_timestamp"), F.lit(1).cast("long").alias("fetch_count"))


class CursorStore:
    """The cursors below a warehouse root.

    ``compact`` folds the runs of the log into the state by one atomic commit, which also names them, so no death in
    between counts a run twice or not at all; a folded run that is replayed changes nothing.  Folders of folded runs are
    removed by a later compaction, so readers of the previous snapshot still find theirs.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.log, self.path = spark, f"{root.rstrip('/')}/api_fetch_log", f"{root.rstrip('/')}/api_cursors"

    def _look(self) -> tuple[SN.Snapshot, list[str], list[str]]:
        """Snapshot, folders of the log still to be folded, folders folded already."""
        # the folders first: one that is folded meanwhile is named by the snapshot read after it
        there = [n for n in SN.names(self.spark, self.log) if n.startswith("run=")]
        s = SN.load(self.spark, self.path)
        if s.schema is None or not there:
            return s, there, []
        # at most one name per folder of the log, that is, per run since the last two compactions
        named = self.spark.createDataFrame([(n,) for n in there], "folder string")
        done = {r[0] for r in SN.read(self.spark, self.path, s, ["runs"]).select("folder").join(named, "folder", "left_semi").collect()}
        return s, [n for n in there if n not in done], [n for n in there if n in done]

    def _parts(self, s: SN.Snapshot, part: str) -> DataFrame:
        return self.spark.createDataFrame([], _STATE) if s.schema is None else SN.read(self.spark, self.path, s, [part])

    def _merged(self, s: SN.Snapshot, fresh: Sequence[str]) -> DataFrame:
        known = self._parts(s, "state").select(*TRIPLE, "last_fetch_timestamp", "fetch_count")
        if not fresh:
            return known
        tail = self.spark.read.schema(LOG).parquet(*[f"{self.log}/{n}" for n in fresh])
        return merge(known.unionByName(_of_log(tail)))

    def read(self) -> DataFrame:
        """Every cursor (F19, F20): the state merged with the runs it does not hold; nothing else of the log is read."""
        s, fresh, _ = self._look()
        return self._merged(s, fresh).select(*TRIPLE, "last_fetch_timestamp",
                                             F.col("last_fetch_timestamp").alias("last_fetch_success"), "fetch_count")

    def open_runs(self) -> int:
        return len(self._look()[1])

    def compact(self) -> int:
        """Fold the log's open runs into the state; returns their number."""
        for _ in range(U.RETRIES):
            s, fresh, done = self._look()
            for n in done:
                U.drop_path(self.spark, f"{self.log}/{n}")
            if not fresh:
                return 0
            none = {c.split()[0]: c.split()[1] for c in _STATE.split(", ")}
            folders = self._parts(s, "runs").select("folder").unionByName(
                self.spark.createDataFrame([(n,) for n in fresh], "folder string")).distinct()
            new = self._merged(s, fresh).withColumns({"folder": F.lit(None).cast("string"), "kind": F.lit("state")})
            new = new.unionByName(folders.select(
                *[F.lit(None).cast(t).alias(c) for c, t in none.items() if c not in ("folder", "kind")], "folder",
                F.lit("runs").alias("kind")))
            changed = SN.write_parts(new, self.path, "kind")
            try:
                SN.commit(self.spark, self.path, s, changed, new.schema)
                return len(fresh)
            except SN.Conflict:              # another compaction came first: look again
                continue
        raise SN.Conflict(f"{self.path}: other compactions came first {U.RETRIES} times")


# ------------------------------------------------------------------ next windows as a stream

def window_stream(fetches: DataFrame, at: str = "fetched_at") -> DataFrame:
    """Streaming fetches → the next fetch window of every device a batch has changed (output mode ``update``).

    The state is one cursor per (connector, endpoint, device), aggregated within the map tasks first, so a hot device
    sends one row a task.  The window starts one hour after the newest reading.  There is no watermark, since one would
    drop late fetches: these count and never move a cursor back.  Fetches without time are left out.
    """
    x = fetches.filter(F.col(at).isNotNull()).groupBy(*TRIPLE)
    x = x.agg(F.max(at).alias("cursor_ts"), F.count(F.lit(1)).alias("fetch_count"))
    return x.withColumn("start_ts", F.col("cursor_ts") + F.make_dt_interval(F.lit(0), F.lit(1)))


def start_window_stream(fetches: DataFrame, path: str, checkpoint: str, at: str = "fetched_at", available_now: bool = True,
                        processing_time: str | None = None):
    """Keep the windows of ``window_stream`` below ``path``: a batch has a folder of its own, which a repeat overwrites."""
    def batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id:08d}")

    w = window_stream(fetches, at).writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    return w.start()


def windows(spark: SparkSession, path: str, as_of: Column | None = None, silent_after: str = "INTERVAL 1 DAY") -> DataFrame:
    """The present window of every device.  One whose cursor lies more than ``silent_after`` before ``as_of`` (the newest
    cursor by default) has basis ``silent``, any other ``cursor``."""
    rows = spark.read.parquet(path)
    last = F.max(F.struct("fetch_count", "cursor_ts", "start_ts")).alias("w")     # counts only grow
    w = rows.groupBy(*TRIPLE).agg(last).select(*TRIPLE, "w.cursor_ts", "w.start_ts", "w.fetch_count")
    as_of = rows.select(F.max("cursor_ts")).scalar() if as_of is None else as_of
    return w.withColumn("basis", F.when(F.col("cursor_ts") + F.expr(silent_after) < as_of, "silent").otherwise("cursor"))
