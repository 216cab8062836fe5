"""Rule engine: bounds, blanks, missing columns, dataset null policies."""

import math

import pytest
from pyspark.sql import functions as F

from pasture.operators.rules import get_spec, list_datasets, register_dataset, validate


def errors_of(spark, dataset, rows, cols):
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    out = validate(df, get_spec(dataset)).collect()
    return out, [[(e["field"], e["error_type"]) for e in r["errors"]] for r in out]


def test_energy_hourly_bounds_and_blank(spark):
    rows = [("1/5/2024 1:00:00 AM", "12,5"), ("2024-01-05T13:00:00", ""), ("x", "1"), ("2024-01-05", "-1"),
            ("2024-01-05", "10000,01"), ("2024-01-05", "abc"), ("2024-01-05", "1.234,56"), ("2024-01-05", "0"),
            ("2024-01-05", "10000"), ("2024-01-05", "nan"), (None, None)]
    out, errs = errors_of(spark, "energy_hourly", rows, ["Date and Time", "Hourly"])
    assert errs[0] == [] and out[0]["energy_kwh"] == 12.5
    assert errs[1] == [] and out[1]["energy_kwh"] == 0.0          # blank kWh → 0.0, valid
    assert errs[2] == [("ts", "type")]
    assert errs[3] == [("energy_kwh", "range")]
    assert errs[4] == [("energy_kwh", "range")]
    assert errs[5] == [("energy_kwh", "type")]
    assert errs[6] == [("energy_kwh", "type")]
    assert errs[7] == [] and errs[8] == []                          # bounds are inclusive
    assert errs[9] == [("energy_kwh", "range")]                     # text nan on a bounded field
    assert errs[10] == [("ts", "type")]                             # blank datetime is a type error


def test_missing_column_and_unexpected_warning(spark):
    out, errs = errors_of(spark, "energy_hourly", [("2024-01-05", "x")], ["Date and Time", "Other"])
    assert errs[0] == [("energy_kwh", "missing")]
    assert out[0]["warnings"] == ["Unexpected field: Other"]


def test_environmental_temperature_required(spark):
    cols = ["timestamp", "temperature (°C)", "humidity (%)", "atm_pressure (hPa)"]
    rows = [("2024-01-05T10:00:00", "", "50", "nan"), ("2024-01-05T10:00:00", "61", "101", "1000"),
            ("2024-01-05T10:00:00", "-50", "nan", "1,5")]
    out, errs = errors_of(spark, "environmental_metrics", rows, cols)
    assert errs[0] == [("temperature", "validation")]              # required value blank → generic error
    assert math.isnan(out[0]["atm_pressure"])                        # unbounded: NaN passes
    assert errs[1] == [("temperature", "range"), ("humidity", "range")]
    assert errs[2] == [("humidity", "range")]


def test_dairy_null_policies(spark):
    cols = ["Date", "Nr. animals", "Rumination minutes"]
    rows = [("12/25/2024 13:00:00 PM", "", ""), ("2024-12-25", "12.7", "1441"), ("2024-12-25", "5", None)]
    out, errs = errors_of(spark, "dairy_production", rows, cols)
    assert errs[0] == [("number_of_animals", "range")]             # null animals → 0 → range
    assert out[0]["rumination_minutes"] == 0                         # null → 0
    assert out[0]["average_lactation_days"] == 0                     # absent → 0
    assert out[1]["number_of_animals"] == 12 and errs[1] == [("rumination_minutes", "range")]
    assert errs[2] == []


def test_schema_errors_stop_option(spark):
    df = spark.createDataFrame([("2024-01-05", "x")], "`Date and Time` string, Other string")
    spec = get_spec("energy_hourly")
    r = validate(df, spec, stop_on_schema_errors=True).first()
    assert [e["error_type"] for e in r["errors"]] == ["missing"]


def test_registry_yaml():
    assert {"energy_hourly", "energy_daily", "environmental_metrics", "dairy_production"} <= set(list_datasets())
    spec = register_dataset("""
dataset: custom_probe
columns: {"A": a}
fields:
  a: {type: int, min: 1, max: 3, required: true}
""")
    assert spec.rule("a").max == 3
    with pytest.raises(KeyError):
        get_spec("nope")


def test_validation_is_one_projection(spark):
    df = spark.createDataFrame([("2024-01-05", "1")], "`Date and Time` string, Hourly string")
    plan = validate(df, get_spec("energy_hourly"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "Exchange" not in plan
