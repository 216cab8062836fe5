"""Energy ↔ production analytics.

Every step returns a DataFrame keyed by device and date instead of printing.
Per-device work is a group key carried through aggregates — never a loop.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from pasture.operators import stats as ST
from pasture.operators.joins import join_dimension

TARGET = "day_production_per_cow_kg"
# Production columns used by the scripts and the regression features.
PRODUCTION_COLS = ("day_production_per_cow_kg", "fed_per_cow_total_kg", "feed_efficiency",
                   "rumination_minutes", "average_lactation_days")
DEVICE_FEATURES = ("device_kwh", "fed_per_cow_total_kg", "feed_efficiency", "rumination_minutes",
                   "average_lactation_days", "day_of_year")
POOLED_FEATURES = ("total_device_kwh", "fed_per_cow_total_kg", "feed_efficiency", "rumination_minutes",
                   "average_lactation_days", "day_of_year")
# Scenario adjustments of device energy (low, baseline, high).
SCENARIOS = (("Low Energy", -0.20), ("Medium Energy (Baseline)", 0.00), ("High Energy", 0.20))


def _since(df: DataFrame, col: str, since) -> DataFrame:
    return df if since is None else df.filter(F.col(col) >= F.lit(since).cast("date"))


# ------------------------------------------------------------------ frames

def daily_energy(hourly: DataFrame, device: DataFrame, client: str) -> DataFrame:
    """kWh per (day, device alias) for one client's devices."""
    d = device.filter(F.col("client") == client).select("id", "alias")
    j = join_dimension(hourly.select("device_id", "ts", "energy_kwh"), d, F.col("device_id") == F.col("id"))
    return j.groupBy(F.to_date("ts").alias("day"), F.col("alias").alias("device_alias")).agg(
        F.sum("energy_kwh").alias("daily_kwh"))


def total_daily(daily: DataFrame) -> DataFrame:
    """Total kWh per day."""
    return daily.groupBy("day").agg(F.sum("daily_kwh").alias("total_kwh_daily"))


def production_energy(production: DataFrame, totals: DataFrame) -> DataFrame:
    """Production ⋈ daily energy totals on the date."""
    p = production.select(F.col("production_date").alias("date"), *PRODUCTION_COLS)
    return p.join(totals.withColumnRenamed("day", "date"), "date")


def production_energy_device(production: DataFrame, daily: DataFrame, as_of=None, days: int = 180) -> DataFrame:
    """Production of the last ``days`` ⟕ per-device daily energy."""
    ref = (production.select(F.max("production_date")).scalar() if as_of is None
           else F.lit(as_of).cast("date"))
    p = production.filter(F.col("production_date") >= F.date_sub(ref, days))
    p = p.select(F.col("production_date").alias("date"), *PRODUCTION_COLS)
    return p.join(daily.withColumnRenamed("day", "date"), "date", "left")


def milk_frame(production: DataFrame, hourly: DataFrame, device: DataFrame, env: DataFrame,
               grain: str = "fanout", since=None) -> DataFrame:
    """I8: pooled regression frame (production ⟕ hourly energy ⟕ device ⟕ readings).

    ``grain='fanout'`` reproduces the reference's result exactly — its GROUP BY
    on (temperature, humidity) multiplies a day's kWh by the number of readings
    sharing each pair — but without materialising the join: per-day kWh and
    per-(day, temperature, humidity) reading counts are aggregated first and
    multiplied.  ``grain='day'`` is the un-multiplied one-row-per-day frame.
    """
    p = _since(production, "production_date", since).select(F.col("production_date").alias("date"), *PRODUCTION_COLS)
    d = device.select("id", "alias")
    e = join_dimension(hourly.select("device_id", "ts", "energy_kwh"), d, F.col("device_id") == F.col("id"), "left")
    kwh = e.groupBy(F.to_date("ts").alias("date")).agg(
        F.sum(F.when(F.col("alias").isNotNull(), F.col("energy_kwh")).otherwise(F.lit(0.0))).alias("s"))
    out = p.join(kwh, "date", "left")
    if grain == "day":
        return out.select("date", *PRODUCTION_COLS, F.coalesce("s", F.lit(0.0)).alias("total_device_kwh"))
    k = env.groupBy(F.to_date("timestamp").alias("date"), "temperature", "humidity").agg(
        F.count(F.lit(1)).alias("k"))
    out = out.join(k, "date", "left")
    return out.select("date", *PRODUCTION_COLS,
                      (F.coalesce("k", F.lit(1)) * F.coalesce("s", F.lit(0.0))).alias("total_device_kwh"))


def device_frame(production: DataFrame, hourly: DataFrame, device: DataFrame, since=None) -> DataFrame:
    """Production ⟕ energy ⟕ device, kWh summed per (date, device alias).

    Energy is pre-aggregated per (day, device) before the joins, so the join
    sees one row per device-day, not every reading.
    """
    p = _since(production, "production_date", since).select(F.col("production_date").alias("date"), *PRODUCTION_COLS)
    per_dev = hourly.groupBy(F.to_date("ts").alias("date"), "device_id").agg(F.sum("energy_kwh").alias("kwh"))
    d = device.select("id", F.col("alias").alias("device_alias"))
    e = join_dimension(per_dev, d, F.col("device_id") == F.col("id"), "left")
    e = e.groupBy("date", "device_alias").agg(F.sum("kwh").alias("device_kwh"))
    return p.join(e, "date", "left")


def clean_device_frame(frame: DataFrame, min_rows: int = 3) -> DataFrame:
    """I12 preparation: drop null target/alias/kWh, require ≥ min_rows before and after the
    null drop of the other features, add day of year (B18, D19).

    The frame holds one row per (date, device), so a device's rows are bounded
    by the number of days: one window per device counts both conditions
    without a join back.
    """
    others = ["fed_per_cow_total_kg", "feed_efficiency", "rumination_minutes", "average_lactation_days"]
    f = frame.filter(F.col(TARGET).isNotNull() & F.col("device_alias").isNotNull() & F.col("device_kwh").isNotNull())
    complete = F.lit(True)
    for c in others:
        complete = complete & F.col(c).isNotNull()
    w = Window.partitionBy("device_alias")
    f = f.withColumns({"_n1": F.count(F.lit(1)).over(w), "_n2": F.count_if(complete).over(w)})
    f = f.filter((F.col("_n1") >= min_rows) & (F.col("_n2") >= min_rows) & complete).drop("_n1", "_n2")
    return f.withColumn("day_of_year", F.dayofyear("date"))


def clean_pooled_frame(frame: DataFrame) -> DataFrame:
    """I10 preparation: target not null, drop rows with null features, add day of year."""
    f = frame.filter(F.col(TARGET).isNotNull()).dropna(
        subset=["fed_per_cow_total_kg", "feed_efficiency", "rumination_minutes", "average_lactation_days",
                "total_device_kwh"])
    return f.withColumn("day_of_year", F.dayofyear("date"))


def _num(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


# ------------------------------------------------------------------ fits and forecasts

def ols_per_device(clean: DataFrame, fit: Callable[..., DataFrame] = ST.ols_fit) -> DataFrame:
    """Per-device least squares of production on the six features; ``fit``: from moments, or ``qr.ols_fit_qr``."""
    return fit(_num(clean, [TARGET, *DEVICE_FEATURES]), TARGET, DEVICE_FEATURES, ["device_alias"])


def ols_pooled(clean: DataFrame, fit: Callable[..., DataFrame] = ST.ols_fit) -> DataFrame:
    """Pooled least squares over every day."""
    return fit(_num(clean, [TARGET, *POOLED_FEATURES]), TARGET, POOLED_FEATURES, min_rows=1)


def last7_fit(clean: DataFrame, coefs: DataFrame, k: int = 7) -> DataFrame:
    """In-sample prediction of the last k rows of devices with ≥ k rows."""
    # one row per (date, device): the per-device window is bounded by the number of days
    c = clean.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("device_alias")))
    t = ST.last_rows(c.filter(F.col("_n") >= k).drop("_n"), ["device_alias"], "date", k)
    t = _num(t, DEVICE_FEATURES)
    p = ST.predict(t, coefs, DEVICE_FEATURES, ["device_alias"])
    return p.select("device_alias", "date", F.col(TARGET).cast("double").alias("actual"), "predicted")


def last7_pooled(clean: DataFrame, coefs: DataFrame, k: int = 7) -> DataFrame:
    """I11, pooled: in-sample prediction of the rows of the newest ``k`` dates."""
    days = clean.select("date").distinct().orderBy(F.col("date").desc()).limit(k)       # k rows
    t = clean.join(F.broadcast(days), "date", "left_semi")
    p = ST.predict(_num(t, POOLED_FEATURES), coefs, POOLED_FEATURES)
    return p.select("date", F.col(TARGET).cast("double").alias("actual"), "predicted")


def _future(base: DataFrame, n_days: int) -> DataFrame:
    return base.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(n_days))))


def forecast_avg(clean: DataFrame, coefs: DataFrame, n_days: int = 7) -> DataFrame:
    """Mean of each feature over the last 7 rows, held for ``n_days`` future days."""
    t = ST.last_rows(_num(clean, DEVICE_FEATURES), ["device_alias"], "date", 7)
    a = t.groupBy("device_alias").agg(F.max("date").alias("last_date"), *[F.avg(c).alias(c) for c in DEVICE_FEATURES])
    f = _future(a, n_days).withColumn("date", F.date_add("last_date", F.col("i")))
    p = ST.predict(f, coefs, DEVICE_FEATURES, ["device_alias"])
    return p.select("device_alias", "date", F.lit("approach_1").alias("approach"),
                    F.lit(None).cast("string").alias("scenario"), "predicted")


def forecast_scenario(clean: DataFrame, coefs: DataFrame, n_days: int = 7, scenarios=SCENARIOS) -> DataFrame:
    """Last row as baseline; kWh × (1 + adjustment) per scenario; day of year + i."""
    c = _num(clean, DEVICE_FEATURES)
    last = c.groupBy("device_alias").agg(F.max_by(F.struct(*DEVICE_FEATURES), "date").alias("b"),
                                         F.max("date").alias("last_date"))
    sc = F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(a).alias("adj")) for n, a in scenarios]))
    f = _future(last.select("*", sc.alias("s")), n_days)
    f = f.select("device_alias", F.date_add("last_date", F.col("i")).alias("date"), F.col("s.scenario").alias("scenario"),
                 *[(F.col("b.device_kwh") * (1 + F.col("s.adj"))).alias(x) if x == "device_kwh"
                   else (F.col("b.day_of_year") + F.col("i")).alias(x) if x == "day_of_year"
                   else F.col(f"b.{x}").alias(x) for x in DEVICE_FEATURES])
    p = ST.predict(f, coefs, DEVICE_FEATURES, ["device_alias"])
    return p.select("device_alias", "date", F.lit("approach_3").alias("approach"), "scenario", "predicted")


def forecast_trend(clean: DataFrame, coefs: DataFrame, n_days: int = 7, lookback: int = 7) -> DataFrame:
    """Last value + slope × i per feature, slope over the last ``lookback`` rows."""
    c = _num(clean, DEVICE_FEATURES)
    slopes = ST.trend_slopes(c, ["device_alias"], "date", DEVICE_FEATURES, lookback, digits=None)
    slopes = slopes.select("device_alias", *[F.col(x).alias(f"s_{x}") for x in DEVICE_FEATURES])
    last = c.groupBy("device_alias").agg(F.max_by(F.struct(*DEVICE_FEATURES), "date").alias("b"),
                                         F.max("date").alias("last_date"))
    f = _future(last.join(slopes, "device_alias"), n_days)
    f = f.select("device_alias", F.date_add("last_date", F.col("i")).alias("date"),
                 *[(F.col(f"b.{x}") + F.coalesce(F.col(f"s_{x}"), F.lit(0.0)) * F.col("i")).alias(x)
                   for x in DEVICE_FEATURES])
    p = ST.predict(f, coefs, DEVICE_FEATURES, ["device_alias"])
    return p.select("device_alias", "date", F.lit("approach_4").alias("approach"),
                    F.lit(None).cast("string").alias("scenario"), "predicted")


def forecast(clean: DataFrame, coefs: DataFrame, approach: str = "approach_1", n_days: int = 7) -> DataFrame | None:
    """I16: approach dispatch (1, 3, 4; there is no 2); unknown → None (skipped)."""
    fn = {"approach_1": forecast_avg, "approach_3": forecast_scenario, "approach_4": forecast_trend}.get(approach)
    return fn(clean, coefs, n_days) if fn else None
