"""Catalogue entries for the remaining scalar checks and dataset rules (B9, D5, D7–D9, E2, E8, E9b, E9d)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasture.functions import coerce as C
from pasture.operators import reshape as R
from pasture.operators.rules import DatasetSpec, FieldRule, get_spec, validate
from pasture.plans.registry import register
from pasture.sources.tables import table


@register("iso_text", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def q_iso_text(spark, sf):
    return table(spark, sf, "events").select("event_id", R.iso_text("ts").alias("iso"))


_RAW = """
SELECT event_id, CASE event_id % 7
         WHEN 0 THEN '  ' || CAST(event_id AS VARCHAR) || ' ' WHEN 1 THEN '+' || CAST(user_id AS VARCHAR)
         WHEN 2 THEN CAST(event_id AS VARCHAR) || '.5' WHEN 3 THEN event_type WHEN 4 THEN '-0' || CAST(user_id AS VARCHAR)
         WHEN 5 THEN '' END AS raw FROM events"""


def _raw(spark, sf):
    e = table(spark, sf, "events")
    n, u, k = F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("event_id") % 7
    raw = (F.when(k == 0, F.concat(F.lit("  "), n, F.lit(" "))).when(k == 1, F.concat(F.lit("+"), u))
            .when(k == 2, F.concat(n, F.lit(".5"))).when(k == 3, F.col("event_type")).when(k == 4, F.concat(F.lit("-0"), u))
            .when(k == 5, ""))
    return e.select("event_id", raw.alias("raw"))


@register("number_checks", f"""
SELECT event_id, trim(raw) AS stripped,
       CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN CAST(trim(raw) AS BIGINT) END AS as_int,
       TRY_CAST(trim(raw) AS DOUBLE) AS as_float
FROM ({_RAW})""")
def q_number_checks(spark, sf):
    return _raw(spark, sf).select("event_id", C.strip("raw").alias("stripped"), C.int_text("raw").alias("as_int"),
                                  C.float_text("raw").alias("as_float"))


@register("uuid_check", """
SELECT event_id, CASE WHEN event_id % 5 < 4 THEN
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) END AS id
FROM (SELECT event_id, md5(CAST(event_id AS VARCHAR)) AS h FROM events)""")
def q_uuid_check(spark, sf):
    h, k = F.md5(F.col("event_id").cast("string")), F.col("event_id") % 5
    dashed = F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    raw = (F.when(k == 0, h).when(k == 1, F.upper(dashed)).when(k == 2, F.concat(F.lit(" {"), dashed, F.lit("} ")))
            .when(k == 3, F.concat(F.lit("urn:uuid:"), dashed)).otherwise(F.substring(h, 1, 31)))
    return table(spark, sf, "events").select("event_id", C.uuid_text(raw).alias("id"))


@register("iso_date_check", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(ts AS DATE) WHEN 1 THEN CAST(ts AS DATE) END AS day FROM events""")
def q_iso_date_check(spark, sf):
    k = F.col("event_id") % 4
    raw = (F.when(k == 0, F.date_format("ts", "yyyy-MM-dd")).when(k == 1, F.date_format("ts", " yyyy-M-d "))
            .when(k == 2, F.date_format("ts", "dd/MM/yyyy")).otherwise("2024-02-31"))
    return table(spark, sf, "events").select("event_id", C.iso_date(raw).alias("day"))


@register("energy_daily_rules", """
SELECT event_id, CASE WHEN event_id % 11 > 0 THEN CAST(ts AS DATE) END AS day,
       CAST(CASE event_id % 5 WHEN 0 THEN 0.0 WHEN 1 THEN NULL WHEN 2 THEN 100000.01 ELSE user_id + 0.5 END AS DOUBLE) AS energy_kwh,
       CASE WHEN event_id % 11 = 0 THEN 'ts:type;' ELSE '' END || CASE event_id % 5 WHEN 1 THEN 'energy_kwh:type;' WHEN 2 THEN 'energy_kwh:range;' ELSE '' END AS errors
FROM events""")
def q_energy_daily_rules(spark, sf):
    n = F.col("event_id")
    e = table(spark, sf, "events").select(
        n, F.when(n % 11 == 0, "").otherwise(F.date_format("ts", "M/d/yyyy h:mm:ss a")).alias("Date and Time"),
        F.when(n % 5 == 0, F.lit(None)).when(n % 5 == 1, "x").when(n % 5 == 2, "100000,01")
         .otherwise(F.concat(F.col("user_id").cast("string"), F.lit(",5"))).alias("Daily"))
    v = validate(e, get_spec("energy_daily"), keep=["event_id"])
    return v.select("event_id", F.to_date("ts").alias("day"), "energy_kwh", _listed("errors").alias("errors"))


def _listed(errors: str):
    return F.array_join(F.transform(errors, lambda e: F.concat(e["field"], F.lit(":"), e["error_type"], F.lit(";"))), "")


@register("dairy_rules", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 20000 ELSE CAST(o_custkey % 900 + 1 AS INTEGER) END AS number_of_animals,
       0 AS rumination_minutes,
       CASE o_orderkey % 5 WHEN 0 THEN 'number_of_animals:type;' WHEN 1 THEN 'number_of_animals:range;'
         WHEN 2 THEN 'number_of_animals:range;' WHEN 3 THEN 'number_of_animals:range;' ELSE '' END
       || CASE WHEN o_orderkey % 7 = 0 THEN 'day_production_per_cow_kg:range;' ELSE '' END AS errors,
       'Unexpected field: Comment' AS warnings
FROM orders""")
def q_dairy_rules(spark, sf):
    """A column nobody mapped is a warning; a number beyond the integer range is an error, not a failed job."""
    n = F.col("o_orderkey")
    e = table(spark, sf, "orders").select(
        n, F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"), F.lit("c").alias("Comment"),
        F.when(n % 5 == 0, "99999999999").when(n % 5 == 1, "").when(n % 5 == 2, "0").when(n % 5 == 3, "20000")
         .otherwise((F.col("o_custkey") % 900 + 1).cast("string")).alias("Nr. animals"),
        F.when(n % 7 == 0, "100,5").otherwise("30").alias("Day production/cow (kg)"))
    v = validate(e.withColumnRenamed("o_orderkey", "_key"), get_spec("dairy_production"), keep=["_key"])
    return v.select(F.col("_key").alias("o_orderkey"), "number_of_animals", F.col("rumination_minutes").cast("int").alias("rumination_minutes"),
                    _listed("errors").alias("errors"), F.array_join("warnings", "; ").alias("warnings"))


_SPEC = DatasetSpec("stop", {"kind": "kind", "n": "n"}, [
    FieldRule("absent", required=True), FieldRule("kind", pattern="[a-z]+$", max_length=5), FieldRule("n", type="float", min=0, max=50)])


@register("schema_stop", """
SELECT event_id, 'absent:missing;' AS stopped,
       'absent:missing;' || CASE WHEN length(event_type) > 5 THEN 'kind:length;' ELSE '' END
         || CASE WHEN value > 50 THEN 'n:range;' ELSE '' END AS collected FROM events""")
def q_schema_stop(spark, sf):
    """E8 both ways: schema errors stop the other checks, or all errors are collected."""
    e = table(spark, sf, "events").select("event_id", F.col("event_type").alias("kind"), F.col("value").cast("string").alias("n"))
    a = validate(e, _SPEC, keep=["event_id"], stop_on_schema_errors=True).select("event_id", _listed("errors").alias("stopped"))
    b = validate(e, _SPEC, keep=["event_id"]).select("event_id", _listed("errors").alias("collected"))
    return a.join(b, "event_id")
