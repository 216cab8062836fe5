"""Input profiling and dataset detection.

Detection classifies every input of a batch in one job from a header table
``(file, array<string> columns)``; the time profile computes date range and
granularity per input with bounded state only (no single-task window per file,
no exact percentile buffer).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pasture.functions.numeric import epoch_micros

# Header names and fragments the reference's content sniffing keys on.
ENV_NAMES = ("pm10", "pm2p5", "humidity", "temperature", "atm_pressure")
ENV_FRAGMENTS = ("µg/m", "hpa")
DAIRY_NAMES = ("nr. animals", "feed efficiency", "rumination")
DEVICE_PREFIX = r"^([a-f0-9]{20,})-"
HOURLY_SECONDS = 7200


def detect_dataset(headers: Column) -> Column:
    """Dataset of an input from its column names; first rule that matches wins."""
    low = F.transform(headers, lambda x: F.lower(x))
    env = (F.arrays_overlap(low, F.array(*[F.lit(n) for n in ENV_NAMES]))
           | F.exists(low, lambda x: x.contains(ENV_FRAGMENTS[0]) | x.contains(ENV_FRAGMENTS[1])))
    dairy = (F.arrays_overlap(low, F.array(*[F.lit(n) for n in DAIRY_NAMES]))
             | F.exists(low, lambda x: x.contains("production") & x.contains("cow")))
    energy = F.array_contains(low, "date and time") & (F.size(headers) == 2)
    hourly = F.exists(low, lambda x: (x != "date and time") & x.contains("hourly"))
    return (F.when(env, "environmental_metrics").when(dairy, "dairy_production")
             .when(energy, F.when(hourly, "energy_hourly").otherwise("energy_daily")))


def device_from_name(name: Column) -> Column:
    """Device id from a file-name prefix of ≥ 20 hex characters, else NULL."""
    return F.nullif(F.regexp_extract(name, DEVICE_PREFIX, 1), F.lit(""))


def resolve_device_hint(dataset: Column, name: Column, defaults: dict[str, str] | None = None) -> Column:
    """File-name device, else the mapping's default device for that dataset."""
    d = device_from_name(name)
    if not defaults:
        return d
    dflt = None
    for ds, dev in defaults.items():
        dflt = F.when(dataset == ds, dev) if dflt is None else dflt.when(dataset == ds, dev)
    return F.coalesce(d, dflt)


def time_column(columns: list[str]) -> str | None:
    """C4: first column whose lower-cased name mentions date, time or timestamp (driver side)."""
    return next((c for c in columns if any(k in c.lower() for k in ("date", "time", "timestamp"))), None)


def time_profile(df: DataFrame, part: str, ts: str, threshold_s: int = HOURLY_SECONDS) -> DataFrame:
    """Per input — timestamps, first/last date, granularity.

    Granularity is 'hourly' when the median gap between consecutive
    timestamps is below ``threshold_s``, 'daily' otherwise or with ≤ 1
    timestamp, NULL when none parses.  The median test is exact but needs
    only counts: with n gaps of which c are below T, the median is below T
    iff 2c > n, or 2c = n and (largest gap below T + smallest gap ≥ T) < 2T.

    Bounded state: duplicate timestamps are first collapsed with a count
    (map-side combine; each duplicate is a 0-second gap), gaps between
    distinct timestamps come from windows per (input, minute), and one gap
    per minute boundary from a window over the per-minute summaries.
    """
    t = df.filter(F.col(ts).isNotNull()).groupBy(part, ts).agg(F.count(F.lit(1)).alias("_m"))
    t = t.withColumn("_b", F.date_trunc("minute", ts))
    w = Window.partitionBy(part, "_b").orderBy(ts)
    inner = t.select(part, epoch_micros(F.col(ts), F.lag(ts).over(w)).alias("_gap"))
    buckets = t.groupBy(part, "_b").agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"),
                                        F.sum("_m").alias("_n"), F.sum(F.col("_m") - 1).alias("_zeros"))
    wb = Window.partitionBy(part).orderBy("_b")
    edges = buckets.select(part, epoch_micros(F.col("_first"), F.lag("_last").over(wb)).alias("_gap"))
    gaps = inner.unionByName(edges).filter(F.col("_gap").isNotNull())
    lim = threshold_s * 1_000_000
    below = F.col("_gap") < lim
    g = gaps.groupBy(part).agg(F.count(F.lit(1)).alias("_ng"), F.count_if(below).alias("_c"),
                               F.max(F.when(below, F.col("_gap"))).alias("_a"),
                               F.min(F.when(~below, F.col("_gap"))).alias("_above"))
    rng = buckets.groupBy(part).agg(F.sum("_n").alias("n_timestamps"), F.sum("_zeros").alias("_z"),
                                    F.to_date(F.min("_first")).alias("start_date"),
                                    F.to_date(F.max("_last")).alias("end_date"))
    j = rng.join(g, part, "left")
    z = F.col("_z")
    n = F.coalesce(F.col("_ng"), F.lit(0)) + z
    c2 = (F.coalesce(F.col("_c"), F.lit(0)) + z) * 2
    a = F.when(z > 0, F.greatest(F.coalesce(F.col("_a"), F.lit(0)), F.lit(0))).otherwise(F.col("_a"))
    hourly = (c2 > n) | ((c2 == n) & (a + F.col("_above") < 2 * lim))
    gran = F.when(F.col("n_timestamps") <= 1, "daily").when(hourly, "hourly").otherwise("daily")
    return j.select(part, "n_timestamps", "start_date", "end_date", gran.alias("granularity"))
