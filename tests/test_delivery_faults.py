"""Deliveries that once lost or changed data: one test per fault."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pasture.operators.rules import get_spec, validate
from pasture.sources import files as FS
from pasture.streaming import delivery as D
from pasture.operators.upsert import read_facts
from pasture.streaming.delivery import Warehouse, ingest_directory, ingest_responses, purge_staging

DEV = "abcdef0123456789abcdef01"
ENV = "timestamp,temperature (°C),humidity (%),pm10 (µg/m³),atm_pressure (hPa)\n"
AS_OF = dt.datetime(2024, 2, 1)


@pytest.fixture()
def place(tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "in")
    os.makedirs(d)
    wh = Warehouse(os.path.join(tmpdir_fresh, "wh"))

    def put(name, text, mode="w"):
        with open(os.path.join(d, name), mode, **({} if "b" in mode else {"encoding": "utf-8"})) as fh:
            fh.write(text)

    return d, wh, put


def status(spark, wh, run=None):
    t = D.read_table(spark, wh.path("inputs"))
    t = t if run is None else t.filter(F.col("run") == run)
    return {os.path.basename(r["file"]): r["status"] for r in t.collect()}


def env(spark, wh):
    return read_facts(spark, wh.path("facts", "environmental_metrics")).collect()


def test_cells_of_any_width_and_empty_header_cells(spark, place):
    d, wh, put = place
    wide = [f"x{i}" for i in range(66)]
    put("wide.csv", ",".join(["timestamp", "pm10 (µg/m³)", *wide, "temperature (°C)"]) + "\n"
        + ",".join(["2024-01-05T00:00:00", "50", *["z"] * 66, "21"]) + "\n")
    put("gap.csv", "timestamp,,temperature (°C),pm10 (µg/m³)\n2024-01-05T01:00:00,X,22,51\n")
    ingest_directory(spark, d, wh, "r1", as_of=AS_OF)
    got = {r["timestamp"].hour: (float(r["temperature"]), float(r["pm10"])) for r in env(spark, wh)}
    assert got == {0: (21.0, 50.0), 1: (22.0, 51.0)}


def test_csv_cells(spark):
    lines = ['a,"b,c",,"say ""hi""",NA,nan, x ,""', "", "one", '"' + "q" * 20_000 + '",2', ",,"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in lines], "line string").select(FS.csv_cells(F.col("line"))).collect()]
    assert got == [["a", "b,c", None, 'say "hi"', None, None, " x ", ""], [None], ["one"], ["q" * 20_000, "2"], [None, None, None]]


def test_null_tokens_and_quoted_line_breaks(spark, place):
    d, wh, put = place
    put(f"{DEV}-m.csv", 'Date and Time,Hourly\n1/5/2024 1:00:00 AM,NA\n"1/5/2024\n 2:00:00 AM",1\n1/5/2024 3:00:00 AM,"1,5"\n"1/5/2024\n\n 4:00:00 AM","2\n3"\n')
    reg = ingest_directory(spark, d, wh, "r1", as_of=AS_OF).first()
    assert reg["extract_records"] == 4
    facts = {r["ts"].hour: r["energy_kwh"] for r in read_facts(spark, wh.path("facts", "fact_energy_hourly")).collect()}
    assert facts[1] == 0.0 and facts[3] == 1.5 and 4 not in facts


def test_quoted_records_across_blocks(spark):
    rows = [("f", 0, 1, 'a,"x'), ("f", 0, 2, "y"), ("f", 9, 3, 'z",1'), ("f", 9, 4, "b,2"), ("f", 9, 5, '"p'), ("f", 20, 6, 'q"'), ("g", 0, 7, "c,3")]
    lines = spark.createDataFrame(rows, "file string, block long, line_id long, line string").withColumn("cells", FS.csv_cells(F.col("line")))
    got = sorted((r["file"], r["line_id"], r["line"]) for r in FS.join_quoted(lines).collect())
    assert got == [("f", 1, 'a,"x\ny\nz",1'), ("f", 4, "b,2"), ("f", 5, '"p\nq"'), ("g", 7, "c,3")]


def test_header_ids_hold_when_the_scan_is_planned_anew(spark, place):
    d, wh, put = place
    for k in range(6):
        put(f"{k}.csv", ENV + "".join(f"2024-01-{k + 1:02d}T{h:02d}:00:00,2{k},50,{h},1000\n" for h in range(3)))
    lines = FS.read_lines(spark, d)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        run = FS.content_ids
        def other_splits(x):
            spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
            return run(x)
        FS.content_ids = other_splits
        reg = D.run_delivery(spark, lines, wh, "r1", as_of=AS_OF).collect()
    finally:
        FS.content_ids = run
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["extract_records"] for r in reg] == [3] * 6 and len(env(spark, wh)) == 18


def test_delivery_without_a_valid_row(spark, place):
    d, wh, put = place
    put("bad.csv", ENV + "never,21,50,1,1000\n")
    reg = ingest_directory(spark, d, wh, "r1", as_of=AS_OF).first()
    assert (reg["valid_records"], reg["loaded_records"], reg["invalid_records"]) == (0, 0, 1)
    assert not os.path.exists(wh.path("facts", "environmental_metrics"))


def test_replay_of_a_run_changes_nothing(spark, place):
    d, wh, put = place
    put("a file with a space.csv", ENV + "2024-01-05T00:00:00,21,50,1,1000\n")
    put("copy.csv", ENV + "2024-01-05T00:00:00,21,50,1,1000\n")
    put("other1.csv", ENV + "2024-01-06T00:00:00,21,50,1,1000\n")
    put("other2.csv", ENV + "2024-01-07T00:00:00,21,50,1,1000\n")
    ingest_directory(spark, d, wh, "001", as_of=AS_OF)
    first = status(spark, wh, "001")
    assert sorted(first.values()) == ["accepted"] * 3 + ["duplicate"]
    ingest_directory(spark, d, wh, "001", as_of=AS_OF)
    assert status(spark, wh, "001") == first and len(env(spark, wh)) == 3
    ingest_directory(spark, d, wh, "002", as_of=AS_OF)
    assert set(status(spark, wh, "002").values()) == {"duplicate"}


def test_unknown_device_is_rejected_and_counts_are_honest(spark, place):
    d, wh, put = place
    put(f"{DEV}-m.csv", "Date and Time,Hourly\n1/5/2024 1:00:00 AM,1\n")
    put("ffffffffffffffffffffffff-m.csv", "Date and Time,Hourly\n1/5/2024 1:00:00 AM,1\n1/5/2024 2:00:00 AM,2\n")
    devices = spark.createDataFrame([(DEV, 7)], "device_id string, id long")
    reg = ingest_directory(spark, d, wh, "r1", as_of=AS_OF, devices=devices).collect()
    assert status(spark, wh) == {f"{DEV}-m.csv": "accepted", "ffffffffffffffffffffffff-m.csv": "rejected: unknown device"}
    assert [(r["valid_records"], r["loaded_records"], r["skipped_records"], r["device"], r["granularity"]) for r in reg] == [(1, 1, 0, DEV, "daily")]
    assert str(reg[0]["start_date"]) == "2024-01-05" and reg[0]["execution_seconds"] > 0


def test_purge_goes_by_the_ledger_and_keeps_run_names(spark, place):
    d, wh, put = place
    put("s.csv", ENV + "2024-01-05T00:00:00,21,50,1,1000\nnever,21,50,1,1000\n2024-01-05T01:00:00,21,50,1,1000\n")
    put("t.csv", "Date,Nr. animals\n2024-01-05,99999999999\n2024-01-06,12\n")
    ingest_directory(spark, d, wh, "001", as_of=AS_OF)
    before = {(r["dataset"], r["row_number"]) for r in D.read_table(spark, wh.path("staging")).collect()}
    loaded = {(r["dataset"], r["row_number"]) for r in D.read_table(spark, wh.path("loaded")).collect()}
    got = {r["table_name"]: r["deleted_count"] for r in purge_staging(spark, wh, dt.datetime(2024, 3, 1)).collect()}
    after = D.read_table(spark, wh.path("staging"))
    assert {(r["dataset"], r["row_number"]) for r in after.collect()} == before - loaded
    assert sum(got.values()) == len(loaded) and {r["run"] for r in after.collect()} == {"001"}
    assert sum(r["deleted_count"] for r in purge_staging(spark, wh, dt.datetime(2024, 3, 1)).collect()) == 0


def test_a_dirty_number_is_an_error_not_a_failure(spark, place):
    d, wh, put = place
    put("farm.csv", "Date,Nr. animals\n2024-01-05,99999999999\n2024-01-06,12\n")
    reg = ingest_directory(spark, d, wh, "r1", as_of=AS_OF).first()
    assert reg["extract_records"] == 2 and reg["invalid_records"] >= 1


def test_every_broken_rule_of_a_field_is_reported(spark):
    from pasture.operators.rules import DatasetSpec, FieldRule
    spec = DatasetSpec("d", {"code": "code", "n": "n"}, [
        FieldRule("code", pattern="[A-Z]+$", max_length=3), FieldRule("n", type="float", min=0, store="decimal(4,2)")])
    rows = spark.createDataFrame([("abcd", "1"), ("ABC", "12345"), ("ABC", "nan")], "code string, n string")
    got = [[(e["field"], e["error_type"]) for e in r["errors"]] for r in validate(rows, spec).collect()]
    assert got == [[("code", "pattern"), ("code", "length")], [("n", "range")], [("n", "range")]]


def test_api_cursor_goes_to_the_newest_reading(spark, place):
    d, wh, put = place
    body = lambda day: '{"status":"ok","sensors":{"device_id":"q","count":3,"temperature":{"values":[{"timestamp":"2024-01-%02dT00:00:00","value":21}]}}}' % day
    for k in range(8):
        for day in (5, 6):
            put(f"dev{k}-{9 - day}.json", body(day))
    for run in ("r1", "r1"):            # a replay is one fetch
        cur = ingest_responses(spark, d, wh, run, as_of=AS_OF).collect()
        assert {(r["last_fetch_timestamp"], r["fetch_count"]) for r in cur} == {(dt.datetime(2024, 1, 6), 2)} and len(cur) == 8
    assert len(env(spark, wh)) == 16


def test_excel_and_csv_in_one_directory(spark, place):
    from test_delivery import _xlsx_bytes
    d, wh, put = place
    put("farm.xlsx", _xlsx_bytes(), "wb")
    put("s.csv", ENV + "2024-01-05T00:00:00,21,50,1,1000\n")
    reg = {r["dataset"]: r["extract_records"] for r in ingest_directory(spark, d, wh, "r1", as_of=AS_OF).collect()}
    assert reg == {"dairy_production": 1, "environmental_metrics": 1}


def test_error_counts_cover_all_rows(spark):
    from pasture.plans.ingest import error_breakdown, stage_batch
    rows = spark.range(400).select(F.lit("f").alias("file_id"), F.col("id").alias("row_number"), F.lit("x").alias("Date and Time"), F.lit("1").alias("Hourly"))
    got = error_breakdown(stage_batch(rows, get_spec("energy_hourly"))).collect()
    assert [(r["failed_count"], r["total_count"], len(r["sample_failures"].split("; "))) for r in got] == [(400, 400, 10)]
