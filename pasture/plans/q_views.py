"""Catalogue entries for the warehouse views and dashboard queries."""

from __future__ import annotations

from pasture.plans import views as V
from pasture.plans.oracle import avg_dec, fixed, micros, ratio_units, round_dec, with_standins as W
from pasture.plans.registry import register
from pasture.sources import standins as S

# ------------------------------------------------------------------ energy


@register("energy_hourly_view", W("""
SELECT d.device_token, d.client, d.alias, f.ts, f.energy_kwh, 'hourly' AS granularity
FROM energy_hourly f JOIN device d ON f.device_id = d.id""", "energy_hourly", "device"))
def q_energy_hourly_view(spark, sf):
    return V.energy_hourly_view(S.energy_hourly(spark, sf), S.devices(spark, sf))


@register("energy_daily_view", W("""
SELECT d.device_token, d.client, d.alias, CAST(f.ts AS TIMESTAMP) AS ts, f.energy_kwh, 'daily' AS granularity
FROM energy_daily f JOIN device d ON f.device_id = d.id""", "energy_daily", "device"))
def q_energy_daily_view(spark, sf):
    return V.energy_daily_view(S.energy_daily(spark, sf), S.devices(spark, sf))


@register("energy_monthly", W("""
SELECT d.device_token, d.client, d.alias, CAST(date_trunc('month', f.ts) AS DATE) AS month,
       sum(f.energy_kwh) AS total_energy_kwh, count(*) AS data_points
FROM energy_daily f JOIN device d ON f.device_id = d.id
GROUP BY d.id, d.device_token, d.client, d.alias, date_trunc('month', f.ts)""", "energy_daily", "device"))
def q_energy_monthly(spark, sf):
    return V.energy_monthly(S.energy_daily(spark, sf), S.devices(spark, sf))


# ------------------------------------------------------------------ dairy

_CFE = ratio_units("CAST(day_production_per_cow_kg * 100 AS BIGINT)", "CAST(fed_per_cow_total_kg * 100 AS BIGINT)", 4)


@register("production_daily", W(f"""
SELECT production_date, day_production_per_cow_kg, number_of_animals, average_lactation_days,
       fed_per_cow_total_kg, fed_per_cow_water_kg, feed_efficiency, rumination_minutes,
       CAST(day_production_per_cow_kg * number_of_animals AS DECIMAL(18,2)) AS total_daily_production_kg,
       CASE WHEN fed_per_cow_total_kg > 0 THEN {fixed(_CFE, 4)} END AS calculated_feed_efficiency
FROM production""", "production"))
def q_production_daily(spark, sf):
    return V.production_daily(S.production(spark, sf))


@register("feed_efficiency", W("""
SELECT production_date, feed_efficiency, fed_per_cow_total_kg, day_production_per_cow_kg,
       rumination_minutes, number_of_animals, average_lactation_days
FROM production WHERE feed_efficiency > 0""", "production"))
def q_feed_efficiency(spark, sf):
    return V.feed_efficiency(S.production(spark, sf))


@register("production_monthly", W(f"""
SELECT CAST(date_trunc('month', production_date) AS DATE) AS month, count(*) AS days_recorded,
       {avg_dec('day_production_per_cow_kg', 2, 2)} AS avg_production_per_cow_kg,
       {round_dec('max(day_production_per_cow_kg)', 2)} AS max_production_per_cow_kg,
       {round_dec('min(day_production_per_cow_kg)', 2)} AS min_production_per_cow_kg,
       {avg_dec('number_of_animals', 0, 0)} AS avg_animals,
       {avg_dec('average_lactation_days', 0, 1)} AS avg_lactation_days,
       {avg_dec('feed_efficiency', 4, 4)} AS avg_feed_efficiency,
       {avg_dec('rumination_minutes', 0, 1)} AS avg_rumination_minutes
FROM production GROUP BY 1""", "production"))
def q_production_monthly(spark, sf):
    return V.production_monthly(S.production(spark, sf))


# ------------------------------------------------------------------ environment

@register("env_daily", W(f"""
SELECT CAST(timestamp AS DATE) AS measurement_date,
       {avg_dec('atm_pressure', 2, 2)} AS avg_atm_pressure,
       {round_dec('min(atm_pressure)', 2)} AS min_atm_pressure,
       {round_dec('max(atm_pressure)', 2)} AS max_atm_pressure,
       {avg_dec('noise_level_db', 2, 2)} AS avg_noise_level_db,
       {round_dec('max(noise_level_db)', 2)} AS max_noise_level_db,
       {avg_dec('temperature', 2, 2)} AS avg_temperature,
       {round_dec('min(temperature)', 2)} AS min_temperature,
       {round_dec('max(temperature)', 2)} AS max_temperature,
       {avg_dec('humidity', 2, 2)} AS avg_humidity,
       {avg_dec('pm10', 2, 2)} AS avg_pm10,
       {round_dec('max(pm10)', 2)} AS max_pm10,
       {avg_dec('wind_speed', 2, 2)} AS avg_wind_speed,
       {round_dec('max(wind_speed)', 2)} AS max_wind_speed,
       {avg_dec('pm2p5', 2, 2)} AS avg_pm2p5,
       {round_dec('max(pm2p5)', 2)} AS max_pm2p5,
       count(*) AS record_count
FROM environmental GROUP BY 1""", "environmental"))
def q_env_daily(spark, sf):
    return V.env_daily(S.environmental(spark, sf))


@register("air_quality", W(f"""
SELECT measurement_date, avg_pm10, max_pm10, avg_pm2p5, max_pm2p5,
       CASE WHEN avg_pm10 <= 40 THEN 'Good' WHEN avg_pm10 <= 80 THEN 'Fair'
            WHEN avg_pm10 <= 120 THEN 'Moderate' ELSE 'Poor' END AS pm10_quality,
       CASE WHEN avg_pm2p5 <= 12 THEN 'Good' WHEN avg_pm2p5 <= 35.4 THEN 'Moderate' ELSE 'Poor' END AS pm2p5_quality
FROM (SELECT CAST(timestamp AS DATE) AS measurement_date,
             {avg_dec('pm10', 2, 2)} AS avg_pm10, {round_dec('max(pm10)', 2)} AS max_pm10,
             {avg_dec('pm2p5', 2, 2)} AS avg_pm2p5, {round_dec('max(pm2p5)', 2)} AS max_pm2p5
      FROM environmental GROUP BY 1)""", "environmental"))
def q_air_quality(spark, sf):
    return V.air_quality(S.environmental(spark, sf))


@register("env_monthly", W(f"""
SELECT CAST(date_trunc('month', timestamp) AS DATE) AS month, count(*) AS record_count,
       {avg_dec('atm_pressure', 2, 2)} AS avg_atm_pressure,
       {avg_dec('noise_level_db', 2, 2)} AS avg_noise_db,
       {avg_dec('temperature', 2, 2)} AS avg_temperature,
       {avg_dec('humidity', 2, 2)} AS avg_humidity,
       {avg_dec('pm10', 2, 2)} AS avg_pm10,
       {round_dec('max(pm10)', 2)} AS max_pm10,
       {avg_dec('wind_speed', 2, 2)} AS avg_wind_speed,
       {avg_dec('pm2p5', 2, 2)} AS avg_pm2p5,
       {round_dec('max(pm2p5)', 2)} AS max_pm2p5
FROM environmental GROUP BY 1""", "environmental"))
def q_env_monthly(spark, sf):
    return V.env_monthly(S.environmental(spark, sf))


# ------------------------------------------------------------------ operations

_DUR = micros("completed_at", "started_at")
_AVG_SECONDS = f"({ratio_units(f'sum({_DUR})', f'count({_DUR})', 0)} / 1000000.0)"
_HEALTH = f"""
SELECT pipeline_name, stage, status, count(*) AS execution_count,
       {_AVG_SECONDS} AS avg_duration_seconds,
       CAST(sum(records_in) AS BIGINT) AS total_records_in,
       CAST(sum(records_out) AS BIGINT) AS total_records_out,
       CAST(sum(records_in - records_out) AS BIGINT) AS total_records_lost,
       max(completed_at) AS last_execution
FROM exec_log
WHERE started_at >= (SELECT max(started_at) FROM exec_log) - INTERVAL 7 DAY
GROUP BY pipeline_name, stage, status"""


@register("pipeline_health", W(_HEALTH, "exec_log"))
def q_pipeline_health(spark, sf):
    return V.pipeline_health(S.exec_log(spark, sf))


@register("pipeline_health_24h", W("""
SELECT * FROM health
WHERE last_execution >= (SELECT max(started_at) FROM exec_log) - INTERVAL 24 HOUR""",
                                   "exec_log", ctes=(("health", _HEALTH),)))
def q_pipeline_health_24h(spark, sf):
    return V.pipeline_health_24h(S.exec_log(spark, sf))


@register("slow_stages", W(f"""
SELECT stage, {_AVG_SECONDS} AS avg_duration, max({_DUR}) / 1000000.0 AS max_duration
FROM exec_log
WHERE started_at >= (SELECT max(started_at) FROM exec_log) - INTERVAL 24 HOUR AND status = 'success'
GROUP BY stage""", "exec_log"))
def q_slow_stages(spark, sf):
    return V.slow_stages(S.exec_log(spark, sf))


@register("failed_top10", W("""
SELECT * FROM exec_log WHERE status = 'failed'
ORDER BY started_at DESC, execution_id DESC LIMIT 10""", "exec_log"))
def q_failed_top10(spark, sf):
    return V.failed_top10(S.exec_log(spark, sf))


@register("recent_executions", W("""
SELECT * FROM exec_log ORDER BY started_at DESC, execution_id DESC LIMIT 5""", "exec_log"))
def q_recent_executions(spark, sf):
    return V.recent_executions(S.exec_log(spark, sf))


_PASSED = "count(*) FILTER (WHERE passed)"


@register("quality_summary", W(f"""
SELECT dataset, check_type, count(*) AS total_checks, {_PASSED} AS passed_checks,
       count(*) FILTER (WHERE NOT passed) AS failed_checks,
       {fixed(ratio_units(f'{_PASSED} * 100', 'count(*)', 2), 2)} AS pass_rate,
       max(checked_at) AS last_check
FROM dq_log
WHERE checked_at >= (SELECT max(checked_at) FROM dq_log) - INTERVAL 7 DAY
GROUP BY dataset, check_type""", "dq_log"))
def q_quality_summary(spark, sf):
    return V.quality_summary(S.dq_log(spark, sf))


@register("failing_checks", W("""
SELECT check_id, dataset, check_type, failed_count, checked_at FROM dq_log WHERE NOT passed""", "dq_log"))
def q_failing_checks(spark, sf):
    return V.failing_checks(S.dq_log(spark, sf))


@register("recent_checks", W("""
SELECT * FROM dq_log WHERE dataset = 'environmental_metrics'
ORDER BY checked_at DESC, check_id DESC LIMIT 10""", "dq_log"))
def q_recent_checks(spark, sf):
    return V.recent_checks(S.dq_log(spark, sf))


def _branch(name: str, table: str, ts: str) -> str:
    t = f"CAST({ts} AS TIMESTAMP)"
    return f"""
SELECT '{name}' AS dataset, source_type, count(*) AS record_count, min({t}) AS earliest_record,
       max({t}) AS latest_record, count(DISTINCT source_device_id) AS unique_devices
FROM {table}
WHERE {t} >= CAST((SELECT max({ts}) FROM {table}) AS TIMESTAMP) - INTERVAL 30 DAY
GROUP BY source_type"""


_SOURCE_CMP = "\nUNION ALL\n".join([
    _branch("environmental_metrics", "environmental", "timestamp"),
    _branch("fact_energy_hourly", "energy_hourly", "ts"),
    _branch("fact_energy_daily", "energy_daily", "ts"),
    _branch("dairy_production", "production", "production_date"),
])
_FACTS = ("environmental", "energy_hourly", "energy_daily", "production")


def _facts(spark, sf):
    return (S.environmental(spark, sf), S.energy_hourly(spark, sf), S.energy_daily(spark, sf),
            S.production(spark, sf))


@register("source_comparison", W(_SOURCE_CMP, *_FACTS))
def q_source_comparison(spark, sf):
    return V.source_comparison(*_facts(spark, sf))


@register("source_comparison_one", W("""
SELECT * FROM cmp WHERE dataset = 'environmental_metrics'""", *_FACTS, ctes=(("cmp", _SOURCE_CMP),)))
def q_source_comparison_one(spark, sf):
    return V.source_comparison_one(*_facts(spark, sf))


_ENV_SINCE = "timestamp >= (SELECT max(timestamp) FROM environmental) - INTERVAL {}"


@register("source_stats", W(f"""
SELECT source_type, count(*) AS records, count(*) FILTER (WHERE temperature IS NULL) AS null_temps,
       {avg_dec('temperature', 2, 6)} AS avg_temp,
       round(stddev_samp(CAST(temperature AS DOUBLE)), 6) AS stddev_temp
FROM environmental WHERE {_ENV_SINCE.format('7 DAY')}
GROUP BY source_type""", "environmental"))
def q_source_stats(spark, sf):
    return V.source_stats(S.environmental(spark, sf))


@register("source_filter_avg", W(f"""
SELECT r.timestamp, r.source_type, r.temperature, b.records, b.avg_temp
FROM environmental r LEFT JOIN by_src b ON r.source_type = b.source_type
WHERE r.source_type = 'api' AND r.{_ENV_SINCE.format('24 HOUR')}""", "environmental", ctes=(("by_src", f"""
SELECT source_type, count(*) AS records, {avg_dec('temperature', 2, 6)} AS avg_temp
FROM environmental WHERE {_ENV_SINCE.format('7 DAY')} GROUP BY source_type"""),)))
def q_source_filter_avg(spark, sf):
    return V.source_filter_avg(S.environmental(spark, sf))


# ------------------------------------------------------------------ devices

@register("device_energy", W("""
SELECT id, device_id, alias AS display_name, client,
       json_extract_string(metadata, '$.name') AS name,
       json_extract_string(metadata, '$.device_token') AS device_token
FROM device WHERE device_type = 'energy'""", "device"))
def q_device_energy(spark, sf):
    return V.device_energy(S.devices(spark, sf))


@register("device_weather", W("""
SELECT id, device_id, alias AS display_name, client, description, status, timezone,
       json_extract_string(metadata, '$.location') AS location
FROM device WHERE device_type = 'weather'""", "device"))
def q_device_weather(spark, sf):
    return V.device_weather(S.devices(spark, sf))


@register("devices_by_group", W("""
SELECT device_type, client, status, count(*) AS count FROM device GROUP BY 1, 2, 3""", "device"))
def q_devices_by_group(spark, sf):
    return V.devices_by_group(S.devices(spark, sf))
