"""Rejected inputs, running stages and atomic fact commits."""

import datetime as dt
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from pasture.operators import snapshots as SN
from pasture.operators import upsert as U
from pasture.sources import files as FS
from pasture.streaming import delivery as D
from pasture.streaming.delivery import Warehouse, ingest_directory, start_file_stream
from test_delivery import _xlsx_bytes
from test_delivery_faults import AS_OF, ENV, place, status  # noqa: F401

GOOD = ENV + "2024-01-05T00:00:00,21,50,1,1000\n"


def test_one_broken_input_is_rejected_and_can_be_offered_again(spark, place):
    d, wh, put = place
    put("good.csv", GOOD)
    put("empty.csv", "")
    put("noise.xlsx", b"this is no archive", "wb")
    put("cut.xlsx", _xlsx_bytes()[:-40], "wb")
    put("farm.xlsx", _xlsx_bytes(), "wb")
    reg = {r["dataset"]: r["extract_records"] for r in ingest_directory(spark, d, wh, "r1", as_of=AS_OF).collect()}
    assert reg == {"dairy_production": 1, "environmental_metrics": 1}
    gone = "rejected: unreadable"
    assert status(spark, wh) == {"good.csv": "accepted", "farm.xlsx": "accepted", "empty.csv": gone, "noise.xlsx": gone, "cut.xlsx": gone}
    why = {os.path.basename(r["file"]): (r["attempts"], r["detail"]) for r in D.rejections(spark, wh).collect()}
    assert why["empty.csv"] == (1, "empty file") and why["noise.xlsx"][1].startswith("BadZipFile") and len(why) == 3
    put("empty.csv", ENV + "2024-01-06T00:00:00,21,50,1,1000\n")
    ingest_directory(spark, d, wh, "r2", as_of=AS_OF + dt.timedelta(days=1))
    why = {os.path.basename(r["file"]): r["attempts"] for r in D.rejections(spark, wh).collect()}
    assert why == {"noise.xlsx": 2, "cut.xlsx": 2}
    assert U.read_facts(spark, wh.path("facts", "environmental_metrics")).count() == 2


def test_a_workbook_that_breaks_half_way_loses_all_its_rows(spark):
    rows = [("a", 0, 0, "x", ["x"], None), ("a", 0, 1, None, None, "bad"), ("b", 0, 2, "y", ["y"], None)]
    x = spark.createDataFrame(rows, "file string, block long, line_id long, line string, cells array<string>, error string")
    good, bad = FS.split_broken(x)
    assert [r["file"] for r in good.collect()] == ["b"] and [tuple(r) for r in bad.collect()] == [("a", "bad")]


def test_stream_takes_text_and_workbooks_and_passes_broken_ones(spark, place, tmpdir_fresh):
    d, wh, put = place
    put("s.csv", GOOD)
    put("noise.xlsx", b"PK no archive", "wb")
    put("farm.xlsx", _xlsx_bytes(), "wb")
    for k in range(2):                  # a restart adds nothing
        start_file_stream(spark, d, wh, os.path.join(tmpdir_fresh, "ck"), as_of=AS_OF).awaitTermination()
    assert status(spark, wh) == {"s.csv": "accepted", "farm.xlsx": "accepted", "noise.xlsx": "rejected: unreadable"}
    put("t.csv", ENV + "2024-01-07T00:00:00,21,50,1,1000\n")
    start_file_stream(spark, d, wh, os.path.join(tmpdir_fresh, "ck"), as_of=AS_OF).awaitTermination()
    assert U.read_facts(spark, wh.path("facts", "environmental_metrics")).count() == 2
    assert U.read_facts(spark, wh.path("facts", "dairy_production")).count() == 1


def test_worksheets_are_parsed_row_by_row():
    import tracemalloc
    n, out = 60_000, io.BytesIO()
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}"><sheets/></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>' + "".join(
            f'<row r="{i}"><c r="A{i}"><v>{i}</v></c><c r="B{i}" t="b"><v>1</v></c></row>' for i in range(1, n + 1)) + "</sheetData></worksheet>")
    tracemalloc.start()
    try:
        seen = sum(1 for r in FS.iter_xlsx(out.getvalue()) if r == [r[0], "True"])
        assert seen == n and tracemalloc.get_traced_memory()[1] < 6_000_000
    finally:
        tracemalloc.stop()


def test_a_stage_shows_while_it_runs_and_after_a_kill(spark, place):
    d, wh, put = place
    put("s.csv", GOOD)
    seen = []

    def look(rows):
        seen.extend((r["stage"], r["status"]) for r in D.executions(spark, wh).collect())
        return rows
    D.register_adapter("environmental_metrics", look)
    try:
        ingest_directory(spark, d, wh, "r1", as_of=AS_OF)
    finally:
        D._ADAPTERS.clear()
    assert seen == [("extract", "running")]
    done = {(r["run"], r["stage"]): r["status"] for r in D.executions(spark, wh).collect()}
    assert set(done.values()) == {"success"} and len(done) == 4 and SN.names(spark, wh.path("pipeline_events")) == []
    D.StageLog(spark, wh, "r2").stage("environmental_metrics", "load").__enter__()           # and then nothing: killed
    live = [r for r in D.executions(spark, wh).collect() if r["run"] == "r2"]
    assert [(r["stage"], r["status"], r["completed_at"]) for r in live] == [("load", "running", None)] and live[0]["started_at"]
    put("t.csv", ENV + "2024-01-07T00:00:00,21,50,1,1000\n")
    ingest_directory(spark, d, wh, "r2", as_of=AS_OF)                                         # the same run, taken up again
    assert {r["status"] for r in D.executions(spark, wh).collect()} == {"success"}


SCHEMA = "k int, ts timestamp_ntz, v double"
JAN, FEB = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)


def rows_of(spark, path, version=None):
    return sorted((r["k"], r["v"]) for r in U.read_facts(spark, path, version).collect())


def test_a_writer_that_dies_before_its_commit_changes_nothing(spark, tmpdir_fresh, monkeypatch):
    path = os.path.join(tmpdir_fresh, "facts")
    U.write_upsert(spark, spark.createDataFrame([(1, JAN, 1.0), (2, FEB, 2.0)], SCHEMA), path, ["k"], "ts")
    with monkeypatch.context() as m:
        m.setattr(SN, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            U.write_upsert(spark, spark.createDataFrame([(1, JAN, 9.0), (2, FEB, 9.0)], SCHEMA), path, ["k"], "ts")
    assert rows_of(spark, path) == [(1, 1.0), (2, 2.0)]
    folders = len(SN.names(spark, f"{path}/_data"))
    assert SN.vacuum(spark, path) == 0 and SN.vacuum(spark, path, min_age_hours=-1) == 1
    assert len(SN.names(spark, f"{path}/_data")) == folders - 1 and rows_of(spark, path) == [(1, 1.0), (2, 2.0)]


@pytest.mark.parametrize("other,again", [(JAN, 2), (FEB, 1)])
def test_two_writers(spark, tmpdir_fresh, monkeypatch, other, again):
    """The second writer starts again only where the first has changed one of its months; neither loses a row."""
    path = os.path.join(tmpdir_fresh, "facts")
    U.write_upsert(spark, spark.createDataFrame([(1, JAN, 1.0)], SCHEMA), path, ["k"], "ts")
    real, calls = SN.write_parts, []

    def slow(df, at, by):
        calls.append(1)
        if len(calls) == 1:             # between this writer's read and its commit
            monkeypatch.setattr(SN, "write_parts", real)
            U.write_upsert(spark, spark.createDataFrame([(1, other, 5.0), (7, other, 7.0)], SCHEMA), path, ["k"], "ts")
            monkeypatch.setattr(SN, "write_parts", slow)
        return real(df, at, by)
    monkeypatch.setattr(SN, "write_parts", slow)
    U.write_upsert(spark, spark.createDataFrame([(2, JAN, 2.0)], SCHEMA), path, ["k"], "ts")
    assert len(calls) == again
    want = [(1, 5.0), (2, 2.0), (7, 7.0)] if other == JAN else [(1, 1.0), (1, 5.0), (2, 2.0), (7, 7.0)]
    assert rows_of(spark, path) == want


def test_a_version_is_published_once_and_readers_keep_theirs(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "facts")
    U.write_upsert(spark, spark.createDataFrame([(1, JAN, 1.0)], SCHEMA), path, ["k"], "ts")
    held = U.read_facts(spark, path)
    U.write_upsert(spark, spark.createDataFrame([(1, JAN, 2.0), (3, None, 3.0)], SCHEMA), path, ["k"], "ts")
    assert sorted(r["v"] for r in held.collect()) == [1.0] and rows_of(spark, path, 1) == [(1, 1.0)]
    assert rows_of(spark, path) == [(1, 2.0), (3, 3.0)] and SN.versions(spark, path) == [1, 2]
    assert not SN._publish(spark, path, SN.load(spark, path)) and len(SN.names(spark, f"{path}/_log")) <= 4
    # rows without a time have a part of their own, and conflict with nothing
    U.write_upsert(spark, spark.createDataFrame([(3, None, 4.0)], SCHEMA), path, ["k"], "ts")
    assert rows_of(spark, path) == [(1, 2.0), (3, 3.0), (3, 4.0)]
    with pytest.raises(ValueError):
        U.read_facts(spark, path, 99)


def test_a_plain_table_is_adopted(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "facts")
    old = spark.createDataFrame([(1, JAN, 1.0), (2, FEB, 2.0)], SCHEMA).withColumn("month", U.month_col("ts"))
    old.write.partitionBy("month").parquet(path)
    U.write_upsert(spark, spark.createDataFrame([(2, FEB, 5.0)], SCHEMA), path, ["k"], "ts")
    assert rows_of(spark, path) == [(1, 1.0), (2, 5.0)]


def skips(spark, wh):
    reg = D.read_table(spark, wh.path("ingest_file")).collect()
    return {os.path.basename(r["file_id"]): (r["valid_records"], r["loaded_records"], r["skipped_records"]) for r in reg}


@pytest.mark.parametrize("strategy", ["append", "update"])
def test_the_ledger_names_the_rows_a_strategy_took(spark, place, strategy):
    d, wh, put = place
    how = {"environmental_metrics": strategy}
    put("a.csv", ENV + "2024-01-05T00:00:00,21,50,1,1000\n2024-01-05T01:00:00,22,50,1,1000\n2024-01-05T00:00:00,23,50,1,1000\n")
    put("b.csv", ENV + "2024-01-05T01:00:00,31,50,1,1000\n2024-02-05T00:00:00,32,50,1,1000\n2024-02-05T00:00:00,x,50,1,1000\n")
    ingest_directory(spark, d, wh, "r1", as_of=AS_OF, strategies=how)
    os.remove(os.path.join(d, "a.csv"))
    os.remove(os.path.join(d, "b.csv"))
    put("c.csv", ENV + "2024-02-05T00:00:00,41,50,1,1000\n2024-02-05T03:00:00,42,50,1,1000\n")
    for _ in range(2):                       # the second time is a replay
        ingest_directory(spark, d, wh, "r2", as_of=AS_OF, strategies=how)
    loaded = sorted((os.path.basename(r["file_id"]), r["row_number"]) for r in D.read_table(spark, wh.path("loaded")).collect())
    facts = U.read_facts(spark, wh.path("facts", "environmental_metrics"))
    assert U.ROW not in facts.columns
    held = sorted(float(r["temperature"]) for r in facts.collect())
    if strategy == "update":
        assert skips(spark, wh) == {"a.csv": (3, 3, 0), "b.csv": (2, 2, 0), "c.csv": (2, 2, 0)}
        assert held == [23.0, 31.0, 41.0, 42.0] and len(loaded) == 7
    else:
        assert skips(spark, wh) == {"a.csv": (3, 2, 1), "b.csv": (2, 1, 1), "c.csv": (2, 1, 1)}
        assert held == [21.0, 22.0, 32.0, 42.0]
        assert loaded == [("a.csv", 1), ("a.csv", 2), ("b.csv", 2), ("c.csv", 2)]


def test_strategies_may_change_over_one_table(spark, place):
    d, wh, put = place
    for n, (strategy, t) in enumerate((("update", 20), ("ignore", 21), ("update", 22))):
        put("x.csv", ENV + f"2024-01-05T00:00:00,{t},50,1,1000\n2024-01-05T0{n + 1}:00:00,{t},50,1,1000\n")
        ingest_directory(spark, d, wh, f"r{n}", as_of=AS_OF, strategies={"environmental_metrics": strategy})
    reg = {r["run"]: r["loaded_records"] for r in D.read_table(spark, wh.path("ingest_file")).collect()}
    assert reg == {"r0": 2, "r1": 1, "r2": 2}
    held = {r["timestamp"].hour: float(r["temperature"]) for r in U.read_facts(spark, wh.path("facts", "environmental_metrics")).collect()}
    assert held == {0: 22.0, 1: 20.0, 2: 21.0, 3: 22.0}
