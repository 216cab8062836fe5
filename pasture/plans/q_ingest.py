"""Catalogue entries for coercion, validation, staging and quality (B, D, E, F1–F7, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasture.functions import coerce as C
from pasture.operators import reshape as R
from pasture.operators.rules import FieldRule, field_errors, get_spec, _typed
from pasture.plans import ingest as I
from pasture.plans.oracle import ampm_ts, blank, euro_float, int_from_float, percent, with_standins as W
from pasture.plans.registry import register
from pasture.sources import standins as S


def feed(spark, sf):
    """Energy feed with 1-based line numbers per file."""
    return R.row_numbers(S.energy_feed(spark, sf), "file_id", "seq")


def staged_feed(spark, sf):
    """The feed staged against the hourly-energy dataset rules."""
    f = feed(spark, sf).select("file_id", "row_number", F.col("received_at").alias("created_at"),
                               "Date and Time", "Hourly")
    return I.stage_batch(f, get_spec("energy_hourly"), keep=("file_id", "row_number", "created_at"))


# ------------------------------------------------------------------ scalars

@register("european_float", W(f"""
SELECT file_id, row_number, "Hourly" AS raw, {euro_float('"Hourly"')} AS value,
       NOT {blank('"Hourly"')} AND {euro_float('"Hourly"')} IS NULL AS invalid
FROM feed""", "feed"))
def q_european_float(spark, sf):
    f = feed(spark, sf)
    return f.select("file_id", "row_number", F.col("Hourly").alias("raw"),
                    C.european_float("Hourly").alias("value"), C.european_float_invalid("Hourly").alias("invalid"))


@register("ampm_datetime", W(f"""
SELECT file_id, row_number, "Date and Time" AS raw, {ampm_ts('"Date and Time"')} AS value FROM feed""", "feed"))
def q_ampm_datetime(spark, sf):
    f = feed(spark, sf)
    return f.select("file_id", "row_number", F.col("Date and Time").alias("raw"),
                    C.datetime_ampm("Date and Time").alias("value"))


@register("ampm_date", W(f"""
SELECT file_id, row_number, "Date and Time" AS raw, CAST({ampm_ts('"Date and Time"')} AS DATE) AS value
FROM feed""", "feed"))
def q_ampm_date(spark, sf):
    f = feed(spark, sf)
    return f.select("file_id", "row_number", F.col("Date and Time").alias("raw"),
                    C.date_ampm("Date and Time").alias("value"))


@register("int_from_float", W(f"""
SELECT file_id, row_number, "Count" AS raw, {int_from_float('"Count"')} AS value,
       NOT {blank('"Count"')} AND {int_from_float('"Count"')} IS NULL AS invalid
FROM feed""", "feed"))
def q_int_from_float(spark, sf):
    f = feed(spark, sf)
    return f.select("file_id", "row_number", F.col("Count").alias("raw"), C.int_from_float("Count").alias("value"),
                    C.int_from_float_invalid("Count").alias("invalid"))


@register("bool_parse", W("""
SELECT file_id, row_number, "Flag" AS raw,
       CASE WHEN lower(trim("Flag")) IN ('true', '1', 'yes', 'y') THEN true
            WHEN lower(trim("Flag")) IN ('false', '0', 'no', 'n') THEN false END AS value
FROM feed""", "feed"))
def q_bool_parse(spark, sf):
    f = feed(spark, sf)
    return f.select("file_id", "row_number", F.col("Flag").alias("raw"), C.bool_text("Flag").alias("value"))


_T = "string_split(trim(\"Time\"), ':')"


@register("time_check", W(f"""
SELECT file_id, row_number, "Time" AS raw,
       CASE WHEN regexp_full_match(trim("Time"), '[0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}')
                 AND CAST({_T}[1] AS INTEGER) <= 23 AND CAST({_T}[2] AS INTEGER) <= 59
                 AND CAST({_T}[3] AS INTEGER) <= 61
            THEN CAST({_T}[1] AS INTEGER) * 3600 + CAST({_T}[2] AS INTEGER) * 60 + CAST({_T}[3] AS INTEGER)
       END AS value
FROM feed""", "feed"))
def q_time_check(spark, sf):
    f = feed(spark, sf)
    return f.select("file_id", "row_number", F.col("Time").alias("raw"), C.time_text("Time").alias("value"))


# ------------------------------------------------------------------ rule primitives

def _violations(spark, sf, raw_col: str, rule: FieldRule, only: str | None = None):
    f = feed(spark, sf)
    raw = F.col(f"`{raw_col}`")
    value, bad, blk = _typed(rule, raw)
    errs = field_errors(rule, raw, value, bad, blk)
    e = f.select("file_id", "row_number", F.explode(errs).alias("e"))
    e = e.select("file_id", "row_number", "e.*")
    return e.filter(F.col("error_type") == only) if only else e


_ERR_COLS = "file_id, row_number, field, value, error_type, message, \"constraint\""


@register("validate_required", W(f"""
SELECT {_ERR_COLS} FROM (
  SELECT file_id, row_number, 'Hourly' AS field, "Hourly" AS value, 'missing' AS error_type,
         'Field required' AS message, CAST(NULL AS VARCHAR) AS "constraint"
  FROM feed WHERE "Hourly" IS NULL OR "Hourly" = '')""", "feed"))
def q_validate_required(spark, sf):
    return _violations(spark, sf, "Hourly", FieldRule("Hourly", type="str", on_blank="missing"))


@register("validate_type", W(f"""
SELECT {_ERR_COLS} FROM (
  SELECT file_id, row_number, 'Hourly' AS field, "Hourly" AS value, 'type' AS error_type,
         'Input should be a valid number' AS message, CAST(NULL AS VARCHAR) AS "constraint"
  FROM feed WHERE NOT {blank('"Hourly"')} AND {euro_float('"Hourly"')} IS NULL)""", "feed"))
def q_validate_type(spark, sf):
    return _violations(spark, sf, "Hourly", FieldRule("Hourly", type="float"))


@register("validate_range", W(f"""
SELECT {_ERR_COLS} FROM (
  SELECT file_id, row_number, 'Hourly' AS field, "Hourly" AS value, 'range' AS error_type,
         CASE WHEN v < 0 OR isnan(v) THEN 'Input should be greater than or equal to 0'
              ELSE 'Input should be less than or equal to 10000' END AS message,
         CASE WHEN v < 0 OR isnan(v) THEN '{{"ge": 0}}' ELSE '{{"le": 10000}}' END AS "constraint"
  FROM (SELECT *, {euro_float('"Hourly"')} AS v FROM feed)
  WHERE v < 0 OR isnan(v) OR v > 10000)""", "feed"))
def q_validate_range(spark, sf):
    return _violations(spark, sf, "Hourly", FieldRule("Hourly", type="float", min=0, max=10000), only="range")


_PAT = r"[0-9]{1,2}/"


@register("validate_pattern", W(f"""
SELECT {_ERR_COLS} FROM (
  SELECT file_id, row_number, 'Date and Time' AS field, "Date and Time" AS value, 'pattern' AS error_type,
         'Input should match pattern ''{_PAT}''' AS message, '{{"pattern": "{_PAT}"}}' AS "constraint"
  FROM feed WHERE NOT regexp_matches(trim("Date and Time"), '^(?:{_PAT})'))""", "feed"))
def q_validate_pattern(spark, sf):
    return _violations(spark, sf, "Date and Time", FieldRule("Date and Time", type="str", pattern=_PAT))


@register("validate_allowed", W(f"""
SELECT {_ERR_COLS} FROM (
  SELECT file_id, row_number, 'Flag' AS field, "Flag" AS value, 'allowed_values' AS error_type,
         'Input should be one of [''YES'', ''No'', ''1'', ''0'']' AS message,
         '{{"allowed": ["YES", "No", "1", "0"]}}' AS "constraint"
  FROM feed WHERE trim("Flag") NOT IN ('YES', 'No', '1', '0'))""", "feed"))
def q_validate_allowed(spark, sf):
    return _violations(spark, sf, "Flag", FieldRule("Flag", type="str", allowed=["YES", "No", "1", "0"]))


@register("validate_length", W(f"""
SELECT {_ERR_COLS} FROM (
  SELECT file_id, row_number, 'Time' AS field, "Time" AS value, 'length' AS error_type,
         'Length should be between 8 and 8' AS message,
         '{{"min_length": 8, "max_length": 8}}' AS "constraint"
  FROM feed WHERE length(trim("Time")) < 8 OR length(trim("Time")) > 8)""", "feed"))
def q_validate_length(spark, sf):
    return _violations(spark, sf, "Time", FieldRule("Time", type="str", min_length=8, max_length=8))


# ------------------------------------------------------------------ validated feed, staging, quality

_CHECKED = f"""
SELECT file_id, row_number, created_at, raw_data, ts, energy_kwh, ts_err, kwh_err,
       CAST(ts_err IS NOT NULL AS INTEGER) + CAST(kwh_err IS NOT NULL AS INTEGER) AS error_count,
       ts_err IS NULL AND kwh_err IS NULL AS is_valid
FROM (
  SELECT *, CASE WHEN {blank('h')} THEN 0.0 ELSE hp END AS energy_kwh,
         CASE WHEN ts IS NULL THEN 'type' END AS ts_err,
         CASE WHEN NOT {blank('h')} AND hp IS NULL THEN 'type'
              WHEN hp < 0 OR isnan(hp) OR hp > 10000 THEN 'range' END AS kwh_err
  FROM (SELECT file_id, row_number, received_at AS created_at, "Hourly" AS h,
               json_object('Date and Time', "Date and Time", 'Hourly', "Hourly") AS raw_data,
               {ampm_ts('"Date and Time"')} AS ts, {euro_float('"Hourly"')} AS hp
        FROM feed))"""
_CK = ("feed",)


def _ck(body: str, *extra):
    return W(body, *_CK, ctes=(("checked", _CHECKED), *extra))


@register("validated_feed", _ck("""
SELECT file_id, row_number, ts, energy_kwh, is_valid, error_count,
       coalesce(ts_err, kwh_err) AS first_error_type,
       CASE WHEN ts_err IS NOT NULL THEN 'ts' WHEN kwh_err IS NOT NULL THEN 'energy_kwh' END AS first_error_field
FROM checked"""))
def q_validated_feed(spark, sf):
    s = staged_feed(spark, sf)
    return s.select("file_id", "row_number", "ts", "energy_kwh", "is_valid",
                    F.size("errors").alias("error_count"),
                    I.first_error(F.col("errors"), "error_type").alias("first_error_type"),
                    I.first_error(F.col("errors"), "field").alias("first_error_field"))


_ERRS = """
SELECT file_id, row_number, 0 AS pos, 'ts' AS field, ts_err AS t FROM inv WHERE ts_err IS NOT NULL
UNION ALL
SELECT file_id, row_number, CASE WHEN ts_err IS NULL THEN 0 ELSE 1 END, 'energy_kwh', kwh_err
FROM inv WHERE kwh_err IS NOT NULL"""
_INV = "SELECT * FROM checked WHERE NOT is_valid"
_TOT = "SELECT file_id, count(*) AS total_count FROM checked GROUP BY file_id"


@register("error_breakdown", _ck(f"""
SELECT e.file_id, t AS check_type, t || '_validation' AS check_name, count(*) = 0 AS passed,
       count(*) AS failed_count, tot.total_count,
       {percent('count(*)', 'tot.total_count')} AS failure_rate,
       array_to_string(list_slice(list(CAST(row_number AS VARCHAR) || ':' || field ORDER BY row_number, pos), 1, 10), '; ')
           AS sample_failures
FROM errs e JOIN tot ON e.file_id = tot.file_id
GROUP BY e.file_id, t, tot.total_count""", ("inv", _INV), ("errs", _ERRS), ("tot", _TOT)))
def q_error_breakdown(spark, sf):
    return I.error_breakdown(staged_feed(spark, sf))


_RATE = percent('count(*) FILTER (WHERE NOT is_valid)', 'count(*)')


@register("overall_quality", _ck(f"""
SELECT file_id, 'overall' AS check_type, 'overall_validation' AS check_name,
       count(*) FILTER (WHERE NOT is_valid) = 0 AS passed,
       count(*) FILTER (WHERE NOT is_valid) AS failed_count, count(*) AS total_count,
       CASE WHEN count(*) > 0 THEN {_RATE} ELSE 0.0 END AS failure_rate,
       CAST(count(*) FILTER (WHERE is_valid) AS VARCHAR) || ' valid, '
         || CAST(count(*) FILTER (WHERE NOT is_valid) AS VARCHAR) || ' invalid' AS summary
FROM checked GROUP BY file_id"""))
def q_overall_quality(spark, sf):
    return I.overall_quality(staged_feed(spark, sf))


@register("run_metrics", _ck(f"""
SELECT file_id, count(*) AS extract_records, count(*) FILTER (WHERE is_valid) AS valid_records,
       count(*) FILTER (WHERE NOT is_valid) AS invalid_records,
       count(*) FILTER (WHERE energy_kwh > 0 AND is_valid) AS loaded_records,
       count(*) FILTER (WHERE is_valid) - count(*) FILTER (WHERE energy_kwh > 0 AND is_valid) AS skipped_records,
       CASE WHEN count(*) FILTER (WHERE NOT is_valid) = 0 THEN 'passed' ELSE 'partial' END AS validation_status,
       {percent('count(*) FILTER (WHERE is_valid)', 'count(*)')} AS quality_score
FROM checked GROUP BY file_id"""))
def q_run_metrics(spark, sf):
    """The ledger holds the readings above zero; the other valid rows count as skipped."""
    s = staged_feed(spark, sf)
    return I.run_metrics(s, s.filter("is_valid and energy_kwh > 0").select("file_id", "row_number"))
