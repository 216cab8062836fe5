"""Catalogue entries for the analytics scripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasture.operators import qr as QR, stats as ST
from pasture.plans import analytics as A
from pasture.plans.oracle import with_standins as W
from pasture.plans.registry import ORACLE, register
from pasture.sources import standins as S

CLIENT = "NATION_1"
PCOLS = ", ".join(A.PRODUCTION_COLS)

_DE = f"""
SELECT day, alias AS device_alias, sum(kwh) AS daily_kwh
FROM (SELECT device_id, CAST(ts AS DATE) AS day, sum(energy_kwh) AS kwh FROM energy_hourly GROUP BY ALL)
     INNER JOIN (SELECT id AS device_id, alias FROM device WHERE client = '{CLIENT}') USING (device_id)
GROUP BY ALL"""
_PE = "SELECT day, sum(daily_kwh) AS total_kwh_daily FROM de GROUP BY ALL"
_I3 = f"SELECT day AS date, {PCOLS}, total_kwh_daily FROM pe INNER JOIN (SELECT *, production_date AS day FROM production) USING (day)"
_I6 = f"""
SELECT day AS date, device_alias, {PCOLS}, daily_kwh
FROM (SELECT *, production_date AS day FROM production
      QUALIFY date_diff('day', production_date, max(production_date) OVER ()) <= 180) LEFT JOIN de USING (day)"""
_ENERGY = ("energy_hourly", "device", "production")


def _daily(spark, sf):
    return A.daily_energy(S.energy_hourly(spark, sf), S.devices(spark, sf), CLIENT)


def _i3(spark, sf):
    return A.production_energy(S.production(spark, sf), A.total_daily(_daily(spark, sf)))


def _i6(spark, sf):
    return A.production_energy_device(S.production(spark, sf), _daily(spark, sf))


@register("daily_energy_client", W(_DE, "energy_hourly", "device"))
def q_daily_energy_client(spark, sf):
    return _daily(spark, sf)


@register("production_energy", W(_I3, *_ENERGY, ctes=(("de", _DE), ("pe", _PE))))
def q_production_energy(spark, sf):
    return _i3(spark, sf)


@register("production_energy_device", W(_I6, *_ENERGY, ctes=(("de", _DE),)))
def q_production_energy_device(spark, sf):
    return _i6(spark, sf)


# ------------------------------------------------------------------ correlation

def _corr_sql(frame: str, pairs, group: str | None = None) -> str:
    parts = []
    for a, b in pairs:
        both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        va = f"var_pop(CAST({a} AS DOUBLE)) FILTER (WHERE {both})"
        vb = f"var_pop(CAST({b} AS DOUBLE)) FILTER (WHERE {both})"
        g = f"{group}, " if group else ""
        parts.append(
            f"SELECT {g}'{a}' AS feature_x, '{b}' AS feature_y, "
            f"CASE WHEN {va} = 0 OR {vb} = 0 THEN NULL "
            f"ELSE round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) END AS r, "
            f"count(*) FILTER (WHERE {both}) AS n FROM {frame}" + (f" GROUP BY {group}" if group else ""))
    return "\nUNION ALL\n".join(parts)


_I3_COLS = [*A.PRODUCTION_COLS, "total_kwh_daily"]
_MATRIX = _corr_sql("i3", [(a, b) for a in _I3_COLS for b in _I3_COLS])
_TARGET_COL = _corr_sql("i3", [(A.TARGET, c) for c in _I3_COLS])


@register("correlation_matrix", W(_MATRIX, *_ENERGY, ctes=(("de", _DE), ("pe", _PE), ("i3", _I3))))
def q_correlation_matrix(spark, sf):
    return ST.correlation_long(_i3(spark, sf), _I3_COLS)


@register("strong_correlates", W("SELECT * FROM tc WHERE abs(r) > 0.5", *_ENERGY,
                                 ctes=(("de", _DE), ("pe", _PE), ("i3", _I3), ("tc", _TARGET_COL))))
def q_strong_correlates(spark, sf):
    return ST.correlation_long(_i3(spark, sf), _I3_COLS, target=A.TARGET).filter(F.abs("r") > 0.5)


_I6_COLS = [*A.PRODUCTION_COLS, "daily_kwh"]
_PER_DEV = _corr_sql("i6d", [(A.TARGET, c) for c in _I6_COLS], group="device_alias")
_I6D = """
SELECT * FROM i6 WHERE device_alias IN (SELECT device_alias FROM i6 WHERE device_alias IS NOT NULL
                                         GROUP BY device_alias HAVING count(*) >= 3)"""


@register("correlation_per_device", W(_PER_DEV, *_ENERGY, ctes=(("de", _DE), ("i6", _I6), ("i6d", _I6D))))
def q_correlation_per_device(spark, sf):
    f = _i6(spark, sf).filter(F.col("device_alias").isNotNull())
    keep = f.groupBy("device_alias").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= 3)
    f = f.join(keep.select("device_alias"), "device_alias", "left_semi")
    return ST.correlation_long(f, _I6_COLS, group=["device_alias"], target=A.TARGET)


# ------------------------------------------------------------------ regression frames

# the station's readings, moved to dates on which milk was weighed (the events are of 2024, the orders of the nineties)
SHIFT_DAYS = 9000


def _readings(spark, sf):
    return S.environmental(spark, sf).withColumn("timestamp", F.col("timestamp") - F.make_dt_interval(F.lit(SHIFT_DAYS)))


_SHIFTED = f"SELECT * REPLACE (timestamp - INTERVAL {SHIFT_DAYS} DAY AS timestamp) FROM environmental"
_KWH = """
SELECT CAST(ts AS DATE) AS day, sum(energy_kwh) FILTER (WHERE alias IS NOT NULL) AS kwh
FROM energy_hourly LEFT JOIN (SELECT id AS device_id, alias FROM device) USING (device_id) GROUP BY ALL"""
_WEIGHT = "SELECT CAST(timestamp AS DATE) AS day, temperature, humidity, count(*) AS weight FROM readings GROUP BY ALL"
_FANOUT = f"""
SELECT day AS date, {PCOLS}, coalesce(weight, 1) * coalesce(kwh, 0.0) AS total_device_kwh
FROM (SELECT *, production_date AS day FROM production) LEFT JOIN kwh USING (day) LEFT JOIN weights USING (day)"""
_FAN = (("readings", _SHIFTED), ("kwh", _KWH), ("weights", _WEIGHT))


@register("milk_frame_fanout", W(_FANOUT, *_ENERGY, "environmental", ctes=_FAN))
def q_milk_frame_fanout(spark, sf):
    return A.milk_frame(S.production(spark, sf), S.energy_hourly(spark, sf), S.devices(spark, sf),
                        _readings(spark, sf), "fanout")


_DAY = f"""
SELECT day AS date, {PCOLS}, coalesce(kwh, 0.0) AS total_device_kwh
FROM (SELECT *, production_date AS day FROM production) LEFT JOIN kwh USING (day)"""


@register("milk_frame_day", W(_DAY, *_ENERGY, ctes=(("kwh", _KWH),)))
def q_milk_frame_day(spark, sf):
    return A.milk_frame(S.production(spark, sf), S.energy_hourly(spark, sf), S.devices(spark, sf),
                        _readings(spark, sf), "day")


_DEVFRAME = f"""
SELECT day AS date, {PCOLS}, device_alias, device_kwh
FROM (SELECT *, production_date AS day FROM production) LEFT JOIN (
  SELECT CAST(ts AS DATE) AS day, alias AS device_alias, sum(energy_kwh) AS device_kwh
  FROM energy_hourly LEFT JOIN (SELECT id AS device_id, alias FROM device) USING (device_id) GROUP BY ALL) USING (day)"""


def _device_frame(spark, sf):
    return A.device_frame(S.production(spark, sf), S.energy_hourly(spark, sf), S.devices(spark, sf))


@register("device_frame", W(_DEVFRAME, *_ENERGY))
def q_device_frame(spark, sf):
    return _device_frame(spark, sf)


_CLEAN = """
SELECT *, dayofyear(date) AS day_of_year FROM f1
WHERE device_alias IN (SELECT device_alias FROM f1 GROUP BY 1 HAVING count(*) >= 3)"""
_F0 = """
SELECT * FROM devframe
WHERE day_production_per_cow_kg IS NOT NULL AND device_alias IS NOT NULL AND device_kwh IS NOT NULL"""
_F1 = """
SELECT * FROM f0
WHERE device_alias IN (SELECT device_alias FROM f0 GROUP BY 1 HAVING count(*) >= 3)
  AND fed_per_cow_total_kg IS NOT NULL AND feed_efficiency IS NOT NULL
  AND rumination_minutes IS NOT NULL AND average_lactation_days IS NOT NULL"""
_SLOPES = ", ".join(f"round(regr_slope(CAST({c} AS DOUBLE), CAST(-rk AS DOUBLE)), 6) + 0.0 AS {c}"
                    for c in A.DEVICE_FEATURES)


@register("trend_slope", W(f"""
SELECT device_alias, count(*) AS n, {_SLOPES}
FROM (SELECT *, row_number() OVER (PARTITION BY device_alias ORDER BY date DESC) AS rk FROM clean)
WHERE rk <= 7 GROUP BY device_alias""", *_ENERGY,
                           ctes=(("devframe", _DEVFRAME), ("f0", _F0), ("f1", _F1), ("clean", _CLEAN))))
def q_trend_slope(spark, sf):
    clean = A.clean_device_frame(_device_frame(spark, sf))
    return ST.trend_slopes(clean, ["device_alias"], "date", A.DEVICE_FEATURES)


_POOLED = """
SELECT *, dayofyear(date) AS day_of_year FROM fan
WHERE day_production_per_cow_kg IS NOT NULL AND fed_per_cow_total_kg IS NOT NULL AND feed_efficiency IS NOT NULL
  AND rumination_minutes IS NOT NULL AND average_lactation_days IS NOT NULL AND total_device_kwh IS NOT NULL"""
_POOL = (*_FAN, ("fan", _FANOUT), ("pooled", _POOLED))


def _pooled(spark, sf):
    return A.clean_pooled_frame(q_milk_frame_fanout(spark, sf))


@register("ols_single", W("""
SELECT count(*) AS n,
       round(regr_slope(CAST(day_production_per_cow_kg AS DOUBLE), total_device_kwh), 6) AS slope,
       round(regr_intercept(CAST(day_production_per_cow_kg AS DOUBLE), total_device_kwh), 6) AS intercept,
       round(regr_r2(CAST(day_production_per_cow_kg AS DOUBLE), total_device_kwh), 6) AS r2
FROM pooled""", *_ENERGY, "environmental", ctes=_POOL))
def q_ols_single(spark, sf):
    p = _pooled(spark, sf)
    y, x = F.col(A.TARGET).cast("double"), F.col("total_device_kwh")
    return p.agg(F.count(F.lit(1)).alias("n"), F.round(F.regr_slope(y, x), 6).alias("slope"),
                 F.round(F.regr_intercept(y, x), 6).alias("intercept"), F.round(F.regr_r2(y, x), 6).alias("r2"))


# ------------------------------------------------------------------ fits and forecasts
#
# The SQL fits by successive orthogonalisation: each feature in turn is taken out of the target and of the features
# after it, per group.  Rows of weight 0 are probes: they go through the same steps but give no weight, so their
# fitted value is a prediction, and the probes 0 and e_j give intercept and coefficients.

_K = 6
_X = [f"x{j}" for j in range(_K)]


def _fit_ctes(rows: str = "points") -> tuple[tuple[str, str], ...]:
    """CTEs from ``rows`` (g, tag, date, scenario, w, y, x0..x5) to ``fitted`` (… , p: fitted value, y: residual)."""
    q = "WINDOW q AS (PARTITION BY g)"
    means = ", ".join(f"{x} - avg({x}) FILTER (WHERE w = 1) OVER q AS {x}" for x in _X)
    out = [("o0", f"SELECT g, tag, date, scenario, w, y AS y0, y - avg(y) FILTER (WHERE w = 1) OVER q AS y, "
                  f"avg(y) FILTER (WHERE w = 1) OVER q AS p, {means} FROM {rows} {q}")]
    for k, z in enumerate(_X):
        rest = _X[k + 1:]
        sums = ", ".join(f"sum({z} * {x}) FILTER (WHERE w = 1) OVER q AS c_{x}" for x in ["y", z, *rest])
        share = {x: f"coalesce(c_{x} / nullif(CASE WHEN c_{z} > 1e-9 THEN c_{z} ELSE 0 END, 0), 0) * {z}" for x in ["y", *rest]}
        left = "".join(f", {x} - {share[x]} AS {x}" for x in rest)
        out.append((f"o{k + 1}", f"SELECT g, tag, date, scenario, w, y0, y - {share['y']} AS y, p + {share['y']} AS p{left} "
                                 f"FROM (SELECT *, {sums} FROM o{k} {q})"))
    return (*out, ("fitted", f"SELECT * FROM o{_K}"))


def _points(frame: str, group: str, xs, extra: str = "") -> str:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS x{j}" for j, c in enumerate(xs))
    return f"""
SELECT {group} AS g, 'row' AS tag, date, NULL AS scenario, 1 AS w, CAST({A.TARGET} AS DOUBLE) AS y, {cols} FROM {frame}{extra}"""


def _unit_probes(frame: str, group: str) -> str:
    cols = ", ".join(f"CASE WHEN j = {j} THEN 1.0 ELSE 0.0 END" for j in range(_K))
    return f"""
UNION ALL SELECT g, 'unit' || CAST(j AS VARCHAR), NULL, NULL, 0, NULL, {cols}
FROM (SELECT DISTINCT {group} AS g FROM {frame}) CROSS JOIN (SELECT unnest(range(-1, {_K})) AS j)"""


def _coef_sql(xs, group: str | None) -> str:
    """n, intercept, coefficients and R² of every group, from ``fitted``."""
    at = lambda j: f"max(p) FILTER (WHERE tag = 'unit{j}')"
    coefs = ", ".join(f"round({at(j)} - {at(-1)}, 6) + 0.0 AS b_{c}" for j, c in enumerate(xs))
    spread = "var_pop(y0) FILTER (WHERE w = 1)"
    own = f"g AS {group}, " if group else ""
    return (f"SELECT {own}count(*) FILTER (WHERE w = 1) AS n, round({at(-1)}, 6) + 0.0 AS intercept, "
            f"round(1 - avg(y * y) FILTER (WHERE w = 1) / {spread}, 6) + 0.0 AS r2, {coefs} FROM fitted GROUP BY g")


_DEV = (("devframe", _DEVFRAME), ("f0", _F0), ("f1", _F1), ("clean", _CLEAN))
_RANKED = "SELECT *, row_number() OVER (PARTITION BY device_alias ORDER BY date DESC) AS rk, count(*) OVER (PARTITION BY device_alias) AS n FROM clean"
_DX = list(A.DEVICE_FEATURES)


def _rounded(df, cols):
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in cols})


@register("ols_pooled", W(_coef_sql(A.POOLED_FEATURES, None), *_ENERGY, "environmental", ctes=(
    *_POOL, ("points", _points("pooled", "1", A.POOLED_FEATURES) + _unit_probes("pooled", "1")), *_fit_ctes())))
def q_ols_pooled(spark, sf):
    return _rounded(A.ols_pooled(_pooled(spark, sf)), ["intercept", "r2", *(f"b_{c}" for c in A.POOLED_FEATURES)])


_NEWEST = """
SELECT date, y0 AS actual, round(p, 6) + 0.0 AS predicted FROM fitted
WHERE w = 1 AND date IN (SELECT DISTINCT date FROM pooled ORDER BY date DESC LIMIT 7)"""


@register("last7_pooled", W(_NEWEST, *_ENERGY, "environmental", ctes=(
    *_POOL, ("points", _points("pooled", "1", A.POOLED_FEATURES)), *_fit_ctes())))
def q_last7_pooled(spark, sf):
    p = _pooled(spark, sf)
    return _rounded(A.last7_pooled(p, A.ols_pooled(p)), ["predicted"])


@register("ols_per_device", W(_coef_sql(_DX, "device_alias"), *_ENERGY, ctes=(
    *_DEV, ("points", _points("clean", "device_alias", _DX) + _unit_probes("clean", "device_alias")), *_fit_ctes())))
def q_ols_per_device(spark, sf):
    return _rounded(A.ols_per_device(_clean(spark, sf)), ["intercept", "r2", *(f"b_{c}" for c in _DX)])


@register("ols_qr_pooled", ORACLE["ols_pooled"])
def q_ols_qr_pooled(spark, sf):
    return _rounded(A.ols_pooled(_pooled(spark, sf), QR.ols_fit_qr), ["intercept", "r2", *(f"b_{c}" for c in A.POOLED_FEATURES)])


@register("ols_qr_per_device", ORACLE["ols_per_device"])
def q_ols_qr_per_device(spark, sf):
    return _rounded(A.ols_per_device(_clean(spark, sf), QR.ols_fit_qr), ["intercept", "r2", *(f"b_{c}" for c in _DX)])


def _clean(spark, sf):
    return A.clean_device_frame(_device_frame(spark, sf))


@register("device_feature_correlation", W(_corr_sql("clean", [(A.TARGET, c) for c in _DX], group="device_alias"), *_ENERGY, ctes=_DEV))
def q_device_feature_correlation(spark, sf):
    return ST.correlation_long(_clean(spark, sf), _DX, group=["device_alias"], target=A.TARGET)


@register("last7_fit", W("""
SELECT g AS device_alias, date, y0 AS actual, round(p, 6) + 0.0 AS predicted
FROM fitted INNER JOIN (SELECT device_alias AS g, date FROM ranked WHERE rk <= 7 AND n >= 7) USING (g, date)""", *_ENERGY, ctes=(
    *_DEV, ("ranked", _RANKED), ("points", _points("clean", "device_alias", _DX)), *_fit_ctes())))
def q_last7_fit(spark, sf):
    c = _clean(spark, sf)
    return _rounded(A.last7_fit(c, A.ols_per_device(c)), ["predicted"])


def _forecast_sql(probes: str, approach: str) -> str:
    return W(f"""
SELECT g AS device_alias, date, '{approach}' AS approach, scenario, round(p, 6) + 0.0 AS predicted FROM fitted WHERE tag = 'next'""",
             *_ENERGY, ctes=(*_DEV, ("ranked", _RANKED), ("points", _points("clean", "device_alias", _DX) + probes), *_fit_ctes()))


def _next(values, scenario: str = "NULL", source: str = "") -> str:
    cols = ", ".join(values)
    return f"""
UNION ALL SELECT device_alias, 'next', CAST(last_date + i AS DATE), {scenario}, 0, NULL, {cols}
FROM ({source}) CROSS JOIN (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS i)"""


_MEAN = "SELECT device_alias, max(date) AS last_date, " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS {c}" for c in _DX) + \
    " FROM ranked WHERE rk <= 7 GROUP BY device_alias"
_LAST = "SELECT device_alias, date AS last_date, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _DX) + " FROM ranked WHERE rk = 1"
_PLANS = "SELECT * FROM (VALUES " + ", ".join(f"('{n}', {1 + a})" for n, a in A.SCENARIOS) + ") AS t(plan, factor)"
_SLOPE = "SELECT device_alias, " + ", ".join(
    f"coalesce(regr_slope(CAST({c} AS DOUBLE), CAST(-rk AS DOUBLE)), 0) AS s_{c}" for c in _DX) + " FROM ranked WHERE rk <= 7 GROUP BY device_alias"


def _forecast(spark, sf, approach):
    c = _clean(spark, sf)
    return _rounded(A.forecast(c, A.ols_per_device(c), approach), ["predicted"])


@register("forecast_avg", _forecast_sql(_next(_DX, source=_MEAN), "approach_1"))
def q_forecast_avg(spark, sf):
    return _forecast(spark, sf, "approach_1")


@register("forecast_scenario", _forecast_sql(_next(
    [f"{c} * factor" if c == "device_kwh" else f"{c} + i" if c == "day_of_year" else c for c in _DX], "plan",
    f"SELECT * FROM ({_LAST}) CROSS JOIN ({_PLANS})"), "approach_3"))
def q_forecast_scenario(spark, sf):
    return _forecast(spark, sf, "approach_3")


@register("forecast_trend", _forecast_sql(_next([f"{c} + s_{c} * i" for c in _DX], source=f"""
    SELECT * FROM ({_LAST}) INNER JOIN ({_SLOPE}) USING (device_alias)"""), "approach_4"))
def q_forecast_trend(spark, sf):
    return _forecast(spark, sf, "approach_4")
