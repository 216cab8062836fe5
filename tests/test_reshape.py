"""JSON record extraction and sensor pivot on the FIXTURES.md §1.5/§1.6 cases."""

from pyspark.sql import functions as F

from pasture.operators import reshape as R


def _records(spark, body, path):
    df = spark.createDataFrame([(body,)], "body string")
    return [r["record"] for r in R.records_by_path(df, "body", path).collect()]


def test_records_by_path_cases(spark):
    assert len(_records(spark, '[{"a":1},{"a":2}]', "")) == 2
    assert _records(spark, '{"a":1}', "") == ['{"a":1}']
    assert len(_records(spark, '{"data":{"readings":[{"a":1},{"a":2},{"a":3}]}}', "data.readings")) == 3
    assert _records(spark, '{"other":1}', "data.readings") == []
    assert _records(spark, '{"data":5}', "data.x") == []
    assert _records(spark, '{"data":{"x":7}}', "data.x") == ["7"]


def test_sensor_pivot_example(spark):
    body = ('{"sensors": {"temperature": {"values": [{"timestamp": "2024-01-05T00:00:00", "value": 21.5},'
            '{"timestamp": "2024-01-05T00:00:00", "value": 21.7}, {"timestamp": "2024-01-05T01:00:00", "value": null}]},'
            '"wind_direction": {"values": [{"timestamp": "2024-01-05T00:00:00", "value": 3}]},'
            '"not_listed": {"values": [{"timestamp": "2024-01-05T00:00:00", "value": 1}]}}}')
    df = R.sensor_objects(spark.createDataFrame([("d1", body)], "device string, body string"), "body")
    rows = R.sensor_pivot(df, "sensors", ["device"], ["temperature", "wind_direction"]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["timestamp"], r["temperature"], r["wind_direction"]) == ("2024-01-05T00:00:00", 21.7, 3.0)


def test_summary_and_empty_rows(spark):
    df = spark.createDataFrame([("AVG", "1"), ("Sum", "2"), (" AVG", "3"), (None, "4"), ("2024-01-05", "5"),
                                (None, None)], "Date string, v string")
    kept = R.drop_summary_rows(R.drop_empty_rows(df), "Date").collect()
    assert sorted(r["v"] for r in kept) == ["3", "4", "5"]


def test_row_numbers_bucketed(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).cast("string").alias("f"), F.col("id").alias("o"))
    out = R.row_numbers(df, "f", "o", bucket_rows=64)
    got = {(r["f"], r["o"]): r["row_number"] for r in out.collect()}
    for f in ("0", "1", "2"):
        ids = sorted(o for (ff, o) in got if ff == f)
        assert [got[(f, o)] for o in ids] == list(range(1, len(ids) + 1))
