"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written from the reference's semantics (views, models, scripts),
not generated from our Spark plans.  Stand-in warehouse tables are CTEs over
the driver views; the helpers reproduce PostgreSQL's exact ``ROUND(numeric)``
with integer arithmetic because DuckDB divides decimals in floating point.
"""

from __future__ import annotations

# ------------------------------------------------------------------ helpers

def ratio_units(num: str, den: str, dp: int) -> str:
    """round(num/den * 10**dp) half away from zero, integers; NULL when den <= 0."""
    return (f"(CASE WHEN ({den}) > 0 THEN sign({num}) * ((abs({num}) * {10 ** dp} * 2 + ({den})) "
            f"// (2 * ({den}))) END)")


def fixed(units: str, scale: int, precision: int = 18) -> str:
    step = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({units} AS DECIMAL(38,0)) * {step} AS DECIMAL({precision},{scale}))"


def avg_dec(col: str, in_scale: int, dp: int, precision: int = 18) -> str:
    num = f"sum(CAST(round({col} * {10 ** in_scale}) AS BIGINT))"
    den = f"(count({col}) * {10 ** in_scale})"
    return fixed(ratio_units(num, den, dp), dp, precision)


def round_ratio(num: str, den: str, dp: int) -> str:
    return f"({ratio_units(num, den, dp)} / {float(10 ** dp)})"


def percent(part: str, total: str) -> str:
    """part / total * 100 in doubles, rounded to two places half-even on the exact binary value (HUGEINT arithmetic)."""
    d = f"(CAST({part} AS DOUBLE) / nullif(CAST({total} AS DOUBLE), 0) * 100.0)"
    f30 = f"(({d} - floor({d})) * 1073741824.0)"
    n = f"((CAST(floor({f30}) AS HUGEINT) * 1073741824 + CAST(floor(({f30} - floor({f30})) * 1073741824.0) AS HUGEINT)) * 100)"
    one = "CAST(1152921504606846976 AS HUGEINT)"
    units = f"(CAST(floor({d}) AS HUGEINT) * 100 + {n} // {one})"
    up = f"CASE WHEN {n} % {one} * 2 > {one} OR ({n} % {one} * 2 = {one} AND {units} % 2 = 1) THEN 1 ELSE 0 END"
    return f"coalesce(CAST({units} + {up} AS DOUBLE) / 100.0, 0.0)"


def round_dec(col: str, dp: int, precision: int = 18) -> str:
    return f"CAST(round(CAST({col} AS DECIMAL(38,10)), {dp}) AS DECIMAL({precision},{dp}))"


def micros(later: str, earlier: str) -> str:
    return f"(epoch_us({later}) - epoch_us({earlier}))"


def cents(col: str) -> str:
    return f"CAST(round({col} * 100) AS BIGINT)"


# ------------------------------------------------------------------ stand-ins

_TOKEN = "substr(sha256('token-' || CAST(s.s_suppkey AS VARCHAR)), 1, 32)"

STANDINS: dict[str, tuple[tuple[str, ...], str]] = {
    "device": ((), f"""
SELECT s.s_suppkey AS id,
       substr(sha256('device-' || CAST(s.s_suppkey AS VARCHAR)), 1, 24) AS device_id,
       CASE WHEN s.s_suppkey % 2 = 0 THEN 'energy' ELSE 'weather' END AS device_type,
       s.s_name AS alias, n.n_name AS client, 'region ' || r.r_name AS description,
       CASE s.s_suppkey % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'offline' ELSE 'unknown' END AS status,
       'UTC' AS timezone,
       '{{"name":"' || s.s_name || '","device_token":"' || {_TOKEN} || '","location":"' || r.r_name || '"}}' AS metadata,
       {_TOKEN} AS device_token
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "energy_hourly": ((), """
SELECT device_id, ts, energy_kwh,
       CASE (device_id + hour(ts)) % 3 WHEN 0 THEN 'csv' WHEN 1 THEN 'api' ELSE 'excel' END AS source_type,
       CAST(device_id AS VARCHAR) AS source_device_id, 'batch' AS ingestion_method
FROM (SELECT l_suppkey AS device_id, l_shipdate + to_hours(CAST(l_linenumber AS BIGINT)) AS ts,
             sum(l_quantity) AS energy_kwh
      FROM lineitem GROUP BY 1, 2)"""),
    "energy_daily": ((), """
SELECT device_id, ts, energy_kwh,
       CASE WHEN device_id % 2 = 0 THEN 'csv' ELSE 'api' END AS source_type,
       CAST(device_id AS VARCHAR) AS source_device_id, 'batch' AS ingestion_method
FROM (SELECT l_suppkey AS device_id, CAST(l_shipdate AS DATE) AS ts, sum(l_quantity) AS energy_kwh
      FROM lineitem GROUP BY 1, 2)"""),
    "production": ((), f"""
SELECT production_date,
       CASE WHEN n % 19 = 0 THEN NULL ELSE {fixed('2000 + (s // n) % 1500', 2, 10)} END AS day_production_per_cow_kg,
       CAST(n AS INTEGER) AS number_of_animals,
       CASE WHEN n % 13 = 0 THEN NULL ELSE CAST(50 + (nc * 37) % 300 AS INTEGER) END AS average_lactation_days,
       CASE WHEN n % 11 = 0 THEN NULL WHEN n % 17 = 0 THEN CAST(0 AS DECIMAL(10,2))
            ELSE {fixed('3000 + mn % 2000', 2, 10)} END AS fed_per_cow_total_kg,
       {fixed('5000 + mx % 3000', 2, 10)} AS fed_per_cow_water_kg,
       CASE WHEN n % 7 = 0 THEN CAST(0 AS DECIMAL(10,4)) ELSE {fixed('10000 + s % 7000', 4, 10)} END AS feed_efficiency,
       CAST(300 + (mx // 100) % 300 AS INTEGER) AS rumination_minutes,
       CASE WHEN day(production_date) % 2 = 0 THEN 'csv' ELSE 'excel' END AS source_type,
       'farm-' || CAST(n % 3 AS VARCHAR) AS source_device_id
FROM (SELECT CAST(o_orderdate AS DATE) AS production_date, count(*) AS n,
             sum({cents('o_totalprice')}) AS s, min({cents('o_totalprice')}) AS mn,
             max({cents('o_totalprice')}) AS mx, count(DISTINCT o_custkey) AS nc
      FROM orders GROUP BY 1)"""),
    "readings": ((), """
SELECT user_id AS device, event_type AS sensor, ts, value, event_id AS seq FROM events"""),
    "environmental": ((), f"""
SELECT timestamp,
       {fixed('100000 + cents % 5000', 2, 8)} AS atm_pressure,
       CAST(noise_level_db AS DECIMAL(6,2)) AS noise_level_db,
       CAST(temperature AS DECIMAL(6,2)) AS temperature,
       CAST(humidity AS DECIMAL(6,2)) AS humidity,
       CAST(pm10 AS DECIMAL(8,2)) AS pm10,
       {fixed('(n * 37) % 1500', 2, 6)} AS wind_speed,
       {fixed('(n % 16) * 100', 2, 6)} AS wind_direction_sectors,
       {fixed('((n * 13) % 360) * 100', 2, 6)} AS wind_angle,
       CAST(pm2p5 AS DECIMAL(8,2)) AS pm2p5,
       CASE WHEN hour(timestamp) % 2 = 0 THEN 'api' ELSE 'csv' END AS source_type,
       CAST(last_user AS VARCHAR) AS source_device_id
FROM (SELECT date_trunc('hour', ts) AS timestamp,
             arg_max(value, event_id) FILTER (WHERE event_type = 'click') AS temperature,
             arg_max(value, event_id) FILTER (WHERE event_type = 'error') AS humidity,
             arg_max(value, event_id) FILTER (WHERE event_type = 'purchase') AS pm10,
             arg_max(value, event_id) FILTER (WHERE event_type = 'signup') AS pm2p5,
             arg_max(value, event_id) FILTER (WHERE event_type = 'view') AS noise_level_db,
             count(*) AS n, sum({cents('value')}) AS cents, arg_max(user_id, event_id) AS last_user
      FROM events GROUP BY 1)"""),
    "exec_log": ((), """
SELECT 'file-' || event_type AS file_id, event_id AS execution_id,
       CASE WHEN user_id % 2 = 0 THEN 'csv_pipeline' ELSE 'api_pipeline' END AS pipeline_name,
       CASE user_id % 3 WHEN 0 THEN 'extract' WHEN 1 THEN 'validate' ELSE 'load' END AS stage,
       ts AS started_at,
       CASE WHEN event_id % 10 = 1 THEN NULL
            ELSE ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS completed_at,
       CASE event_id % 10 WHEN 0 THEN 'failed' WHEN 1 THEN 'running' ELSE 'success' END AS status,
       CAST(floor(value) AS INTEGER) AS records_in,
       CAST(floor(value) AS INTEGER) - CAST(event_id % 4 AS INTEGER) AS records_out,
       CASE WHEN event_id % 10 = 0 THEN 'stage failed: ' || event_type END AS error_message
FROM events"""),
    "dq_log": ((), f"""
SELECT 'file-' || event_type AS file_id, event_id AS check_id,
       CASE user_id % 4 WHEN 0 THEN 'environmental_metrics' WHEN 1 THEN 'energy_hourly'
            WHEN 2 THEN 'energy_daily' ELSE 'dairy_production' END AS dataset,
       CASE event_id % 3 WHEN 0 THEN 'validation' WHEN 1 THEN 'completeness' ELSE 'error_type' END AS check_type,
       'check_' || event_type AS check_name,
       event_id % 5 <> 0 AS passed,
       CAST(event_id % 7 AS INTEGER) AS failed_count,
       CAST(10 + user_id % 90 AS INTEGER) AS total_count,
       {fixed('((event_id % 7) * 20000 + (10 + user_id % 90)) // (2 * (10 + user_id % 90))', 2, 5)} AS failure_rate,
       ts AS checked_at
FROM events"""),
    "energy_feed": ((), f"""
SELECT 'feed-' || event_type AS file_id, event_id AS seq, user_id AS device, ts AS received_at,
       CASE WHEN event_id % 101 = 0 THEN 'not a date'
            WHEN event_id % 5 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(ts, '%-m/%-d/%Y %-I:%M:%S %p') END AS "Date and Time",
       CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN 'abc' WHEN event_id % 83 = 0 THEN '-5,0'
            WHEN event_id % 79 = 0 THEN '1.234,56' WHEN event_id % 73 = 0 THEN NULL
            WHEN event_id % 71 = 0 THEN ' 12,5 ' WHEN event_id % 67 = 0 THEN '10000,01'
            WHEN event_id % 61 = 0 THEN 'nan'
            ELSE CAST({cents('value')} // 100 AS VARCHAR) || ',' || lpad(CAST({cents('value')} % 100 AS VARCHAR), 2, '0')
       END AS "Hourly",
       CASE WHEN event_id % 31 = 0 THEN 'x' WHEN event_id % 29 = 0 THEN ''
            WHEN event_id % 2 = 0 THEN CAST(value AS VARCHAR) ELSE '-' || CAST(value AS VARCHAR) END AS "Count",
       ['YES', 'No', '1', '0', 'true', 'n', 'maybe', 'Y', 'FALSE'][event_id % 9 + 1] AS "Flag",
       CASE WHEN event_id % 13 = 0 THEN '24:00:00' WHEN event_id % 17 = 0 THEN '7:5:9'
            ELSE strftime(ts, '%H:%M:%S') END AS "Time"
FROM events"""),
    "feed": (("energy_feed",), """
SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY seq) AS row_number FROM energy_feed"""),
}


def with_standins(body: str, *names: str, ctes: tuple[tuple[str, str], ...] = ()) -> str:
    """Prefix ``body`` with the stand-in CTEs it names (dependencies first) and extra CTEs."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in STANDINS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({STANDINS[n][1]}\n)" for n in order] + [f"{n} AS ({sql}\n)" for n, sql in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


# ------------------------------------------------------------------ text parsers (DuckDB)

NUM_RE = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def float_text(t: str) -> str:
    """Python float() of already-trimmed text t."""
    return (f"(CASE WHEN lower({t}) IN ('nan', '+nan', '-nan') THEN CAST('nan' AS DOUBLE) "
            f"WHEN lower({t}) IN ('inf', '+inf', 'infinity', '+infinity') THEN CAST('inf' AS DOUBLE) "
            f"WHEN lower({t}) IN ('-inf', '-infinity') THEN CAST('-inf' AS DOUBLE) "
            f"WHEN regexp_full_match({t}, '{NUM_RE}') THEN CAST({t} AS DOUBLE) END)")


def euro_float(c: str) -> str:
    return f"(CASE WHEN {blank(c)} THEN NULL ELSE {float_text(f'replace(trim({c}), {chr(39)},{chr(39)}, {chr(39)}.{chr(39)})')} END)"


def int_from_float(c: str) -> str:
    f = float_text(f"trim({c})")
    return (f"(CASE WHEN {blank(c)} THEN NULL WHEN isnan({f}) OR isinf({f}) THEN NULL "
            f"ELSE CAST(trunc({f}) AS BIGINT) END)")


def ampm_ts(c: str) -> str:
    t = f"trim({c})"
    return (f"(CASE WHEN lower({t}) LIKE '%am%' OR lower({t}) LIKE '%pm%' THEN "
            f"(CASE WHEN regexp_full_match({t}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}} [0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}} [AaPp][Mm]') "
            f"THEN try_strptime({t}, '%m/%d/%Y %I:%M:%S %p') END) "
            f"WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_cast({t} AS TIMESTAMP) "
            f"WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]{{2}}(:[0-9]{{2}}(:[0-9]{{2}}([.,][0-9]{{1,6}})?)?)?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?') "
            f"THEN try_cast(regexp_replace(regexp_replace(regexp_replace({t}, '(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$', ''), ',', '.'), "
            f"'([T ][0-9]{{2}})$', '\\1:00') AS TIMESTAMP) "
            f"WHEN regexp_full_match({t}, '[0-9]{{8}}') THEN try_strptime({t}, '%Y%m%d') "
            f"WHEN regexp_full_match({t}, '[0-9]{{8}}T[0-9]{{6}}') THEN try_strptime({t}, '%Y%m%dT%H%M%S') END)")
