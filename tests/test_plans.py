"""Physical-plan properties the design relies on."""

import __spark_entry__ as E

from conftest import SF_SMALL

Q = E.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ingestion_has_no_python_on_row_path(spark):
    for k in ("validated_feed", "european_float", "ampm_datetime", "staging_stats"):
        p = plan(Q[k](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k


def test_device_dimension_is_broadcast(spark):
    df = Q["energy_monthly"](spark, SF_SMALL)
    p = plan(df)
    assert "BroadcastHashJoin" in p
    # the month roll-up happens before the device join: partial and final aggregates sit under it
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert opt.index("Join") < opt.index("Aggregate")


def test_no_cartesian_products(spark):
    for k in ("milk_frame_fanout", "device_frame", "forecast_scenario", "drop_summary_rows", "records_by_path"):
        p = plan(Q[k](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = Q["failed_top10"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in p
    from pyspark.sql import functions as F
    from pasture.sources.tables import table
    e = table(spark, SF_SMALL, "events").filter(F.col("event_type") == "click").select("ts")
    p2 = plan(e)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p2
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in p2


def test_top_k_per_group_is_limited_before_shuffle(spark):
    p = plan(Q["trend_slope"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_broadcast_only_behind_size_check(spark):
    from pasture.operators.joins import broadcast_if_small, plan_size_bytes
    from pasture.sources.tables import table
    small = table(spark, SF_SMALL, "region")
    assert plan_size_bytes(small) is not None and plan_size_bytes(small) < 10_000
    assert "broadcast" in broadcast_if_small(small)._jdf.queryExecution().analyzed().toString().lower()
    big = table(spark, SF_SMALL, "lineitem")
    assert broadcast_if_small(big, max_bytes=1000) is big


def test_delivery_lines_not_shuffled_by_file(spark, tmpdir_fresh):
    import os
    from pasture.operators.rules import get_spec
    from pasture.sources import files as FS
    d = os.path.join(tmpdir_fresh, "in")
    os.makedirs(d)
    with open(os.path.join(d, "m.csv"), "w") as fh:
        fh.write("Date and Time,Hourly\n1/5/2024 1:00:00 AM,1\n")
    lines = FS.read_lines(spark, d)
    cls = FS.classify(FS.header_table(lines))
    rows = FS.dataset_rows(lines, cls, get_spec("energy_hourly"), files_size=FS.files_bytes(cls))
    p = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert rows.count() == 1


def test_error_sample_is_bounded_before_shuffle(spark):
    p = plan(Q["error_breakdown"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p
