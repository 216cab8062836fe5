"""Fetch cursors: compacted state, log tail, stream of windows, streamed responses."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from pasture.operators import snapshots as SN
from pasture.streaming import cursors as CU
from pasture.streaming import delivery as D

FETCH = "connector_id string, endpoint_id string, device_id string, fetched_at timestamp_ntz, sha256 string"
T0 = dt.datetime(2024, 1, 5)


def fetches(spark, rows):
    return spark.createDataFrame([("api", "s", d, None if m is None else T0 + dt.timedelta(minutes=m), str(i))
                                  for i, (d, m) in enumerate(rows)], FETCH).coalesce(1)


def held(store):
    return {r["device_id"]: ((r["last_fetch_timestamp"] - T0).total_seconds() / 60, r["fetch_count"]) for r in store.read().collect()}


def fold(runs):
    out = {}
    for d, m in (x for rows in runs.values() for x in rows):
        last, n = out.get(d, (m, 0))
        out[d] = (max(last, m), n + 1)
    return out


def test_any_compaction_point_gives_the_fold(spark, tmpdir_fresh):
    rnd, store, runs = random.Random(5), CU.CursorStore(spark, tmpdir_fresh), {}
    assert store.read().count() == 0 and store.compact() == 0
    for n in range(4):
        rows = [(rnd.choice("abc"), rnd.randrange(1000)) for _ in range(6)]
        runs[f"r{n}"] = rows
        D._append(fetches(spark, rows), store.log, f"r{n}")
        if n in (1, 2):
            assert store.compact() == (2 if n == 1 else 1) and store.open_runs() == 0
    assert held(store) == fold(runs)
    D._append(fetches(spark, runs["r0"]), store.log, "r0")                      # a folded run is replayed
    assert held(store) == fold(runs) and store.open_runs() == 1
    plan = "".join(store.read().inputFiles())                                    # state and tail, no folded run
    assert "run=r3" in plan and "run=r0" not in plan and "run=r1" not in plan
    assert store.compact() == 1 and SN.names(spark, store.log) == ["run=r3"]      # folders go one compaction later
    assert held(store) == fold(runs)


def test_a_compaction_that_dies_or_comes_second_counts_nothing_twice(spark, tmpdir_fresh, monkeypatch):
    store, runs = CU.CursorStore(spark, tmpdir_fresh), {"r0": [("a", 1), ("b", 2)], "r1": [("a", 0)]}
    D._append(fetches(spark, runs["r0"]), store.log, "r0")
    publish = SN._publish
    monkeypatch.setattr(SN, "_publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        store.compact()
    monkeypatch.setattr(SN, "_publish", publish)
    assert held(store) == fold({"r0": runs["r0"]}) and store.open_runs() == 1
    D._append(fetches(spark, runs["r1"]), store.log, "r1")
    write, other = SN.write_parts, []

    def late(df, path, by):
        changed = write(df, path, by)
        if not other:                         # another compaction commits between this one's write and its commit
            other.append(1)
            assert CU.CursorStore(spark, tmpdir_fresh).compact() == 2
        return changed
    monkeypatch.setattr(SN, "write_parts", late)
    assert store.compact() == 0
    assert held(store) == fold(runs)


def test_windows_of_a_stream_over_batches_late_rows_silence_and_restart(spark, tmpdir_fresh):
    src, out, ck = (os.path.join(tmpdir_fresh, x) for x in ("in", "out", "ck"))

    def run(rows):
        fetches(spark, rows).write.mode("append").parquet(src)
        CU.start_window_stream(spark.readStream.schema(FETCH).parquet(src), out, ck).awaitTermination()
        w = CU.windows(spark, out).drop("batch").collect()
        assert all(r["start_ts"] - r["cursor_ts"] == dt.timedelta(hours=1) for r in w)
        return {r["device_id"]: ((r["cursor_ts"] - T0).total_seconds() / 60, r["fetch_count"], r["basis"]) for r in w}

    assert run([("a", 10), ("a", 5), ("b", 2000), ("c", None)]) == {"a": (10, 2, "silent"), "b": (2000, 1, "cursor")}
    # the late row of b counts and does not move it back; a speaks again
    assert run([("b", 1990), ("a", 2100)]) == {"a": (2100, 3, "cursor"), "b": (2000, 2, "cursor")}


def test_streamed_responses_advance_the_cursor_once(spark, tmpdir_fresh):
    d, wh = os.path.join(tmpdir_fresh, "in"), D.Warehouse(os.path.join(tmpdir_fresh, "wh"))
    os.makedirs(d)

    def put(name, hour):
        with open(os.path.join(d, name), "w") as fh:
            fh.write('{"sensors": {"temperature": {"values": [{"timestamp": "2024-01-05T%02d:00:00", "value": 21}]}}}' % hour)

    def go():
        D.start_response_stream(spark, d, wh, os.path.join(tmpdir_fresh, "ck"), as_of=T0, compact_after=0).awaitTermination()
        return {r["device_id"]: (r["last_fetch_timestamp"].hour, r["fetch_count"]) for r in D.cursors(spark, wh).collect()}
    put("s1-b.json", 7)
    put("s2-a.json", 3)
    assert go() == {"s1": (7, 1), "s2": (3, 1)}
    put("s1-a.json", 4)                                                          # an older response comes late
    assert go() == {"s1": (7, 2), "s2": (3, 1)}
    assert go() == {"s1": (7, 2), "s2": (3, 1)}
    assert D.read_table(spark, wh.path("loaded")).filter(F.col("run") != "").count() == 3
