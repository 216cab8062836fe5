"""Upsert strategies (F8–F13) and their properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pasture.operators import upsert as U

K = ["k"]


def frames(spark):
    target = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0)], "k int, s string, v double")
    batch = spark.createDataFrame([(2, "x", 21.0, 1), (3, "y", 30.0, 2), (3, "z", None, 3)],
                                  "k int, s string, v double, seq int")
    return target, batch


def as_dict(df):
    return {r["k"]: (r["s"], r["v"]) for r in df.collect()}


def test_update_last_wins_other_columns_keep_first(spark):
    t, b = frames(spark)
    got = as_dict(U.upsert(t, b, K, "update", ["v"], seq="seq").drop("seq"))
    assert got == {1: ("a", 10.0), 2: ("b", 21.0), 3: ("y", None)}   # NULL from the last row is carried


def test_update_all_columns_and_ignore(spark):
    t, b = frames(spark)
    assert as_dict(U.upsert(t, b, K, "update", seq="seq").drop("seq")) == {1: ("a", 10.0), 2: ("x", 21.0), 3: ("z", None)}
    for strategy in ("ignore", "append"):
        assert as_dict(U.upsert(t, b, K, strategy, seq="seq").drop("seq")) == {1: ("a", 10.0), 2: ("b", 20.0), 3: ("y", 30.0)}


def test_fail_and_plain_insert(spark):
    t, b = frames(spark)
    with pytest.raises(ValueError):
        U.upsert(t, b, K, "fail", seq="seq")
    assert U.upsert(t, b.drop("seq"), []).count() == 5
    assert sorted(r["k"] for r in U.conflict_keys(t, b, K).collect()) == [2, 3]


def test_untouched_rows_and_null_keys_stay(spark):
    """Rows the batch does not touch never change, even where they share a key; a NULL key conflicts with nothing."""
    t = spark.createDataFrame([(7, "p", 1.0), (7, "q", 2.0), (None, "n", 3.0), (8, "r", 4.0)], "k int, name string, v double")
    b = spark.createDataFrame([(8, "new", 5.0, 1), (None, "m", 6.0, 2), (None, "m", 7.0, 3)], "k int, name string, v double, seq int")
    for strategy, eight in (("update", ("new", 5.0)), ("ignore", ("r", 4.0))):
        got = sorted(((r["k"], r["name"], r["v"]) for r in U.upsert(t, b, K, strategy, seq="seq").collect()), key=str)
        assert got == sorted([(7, "p", 1.0), (7, "q", 2.0), (8, *eight), (None, "n", 3.0), (None, "m", 6.0), (None, "m", 7.0)], key=str)


def test_sink_lets_read_errors_rise_and_skips_empty_batches(spark, tmpdir_fresh):
    import glob
    import os
    path = os.path.join(tmpdir_fresh, "facts")
    b = spark.createDataFrame([(1, dt.datetime(2024, 1, 5), 1.0), (2, dt.datetime(2024, 1, 6), 2.0)], "k int, ts timestamp_ntz, v double")
    assert U.write_upsert(spark, b.limit(0), path, K, "ts") == 0 and not os.path.exists(path)
    U.write_upsert(spark, b, path, K, "ts")
    assert U.write_upsert(spark, b.limit(0), path, K, "ts") == 0 and U.read_facts(spark, path).count() == 2
    U.write_upsert(spark, b.limit(1).withColumn("v", F.lit(9.0)), path, K, "ts")
    assert sorted(r["v"] for r in U.read_facts(spark, path).collect()) == [2.0, 9.0]
    for f in glob.glob(path + "/_data/*/part=2024-01/*.parquet"):
        with open(f, "r+b") as fh:
            fh.truncate(4)
    with pytest.raises(Exception):
        U.write_upsert(spark, b.limit(1), path, K, "ts")
    assert glob.glob(path + "/_data/*/part=2024-01/*.parquet")          # nothing was replaced


def test_idempotent_and_partition_independent(spark):
    t, b = frames(spark)
    once = U.upsert(t, b, K, "update", ["v"], seq="seq").drop("seq")
    twice = U.upsert(once, b, K, "update", ["v"], seq="seq").drop("seq")
    assert as_dict(once) == as_dict(twice)
    scattered = U.upsert(t.repartition(3), b.repartition(5), K, "update", ["v"], seq="seq").drop("seq")
    assert as_dict(scattered) == as_dict(once)


def test_outcome_counts(spark):
    t, b = frames(spark)
    upd = U.outcome(t, b, K, "update").first()
    ign = U.outcome(t, b, K, "ignore").first()
    assert (upd["batch_rows"], upd["loaded"], upd["skipped"]) == (3, 3, 0)
    assert (ign["loaded"], ign["skipped"], ign["inserted_keys"], ign["updated_keys"]) == (1, 2, 1, 1)


def test_write_upsert_touches_only_batch_months(spark, tmpdir_fresh):
    path = f"{tmpdir_fresh}/fact"
    first = spark.createDataFrame([(1, dt.datetime(2024, 1, 5), 1.0, 1), (1, dt.datetime(2024, 2, 5), 2.0, 2)],
                                  "d int, ts timestamp_ntz, v double, seq int")
    assert U.write_upsert(spark, first, path, ["d", "ts"], "ts", seq="seq") == 2
    second = spark.createDataFrame([(1, dt.datetime(2024, 2, 5), 5.0, 1), (2, dt.datetime(2024, 2, 6), 6.0, 2)],
                                   "d int, ts timestamp_ntz, v double, seq int")
    assert U.write_upsert(spark, second, path, ["d", "ts"], "ts", "update", ["v"], seq="seq") == 1
    got = {(r["d"], r["ts"].month): r["v"] for r in U.read_facts(spark, path).collect()}
    assert got == {(1, 1): 1.0, (1, 2): 5.0, (2, 2): 6.0}
