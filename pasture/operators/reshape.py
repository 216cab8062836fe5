"""Projection, reshaping and cleaning operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pasture.functions import coerce as C
from pasture.operators.joins import join_dimension

# ------------------------------------------------------------------ B1/B2 JSON records


def records_by_path(df: DataFrame, body: str, path: str, out: str = "record") -> DataFrame:
    """B1: records at a dotted ``path`` of a JSON body, one row per record.

    Empty path: a top-level array gives its elements, an object gives itself.
    Otherwise keys are walked; a missing key or a non-object midway gives no
    record; a final array gives its elements, a final object or scalar one record.
    Records are JSON text (parsed later with the dataset's schema).
    """
    v = F.try_parse_json(F.col(body))
    node = v if not path else F.try_variant_get(v, "$." + path, "variant")
    if path:
        # a key that resolves through a non-object is absent, like the reference's walk
        parents = path.split(".")[:-1]
        for i in range(len(parents)):
            prefix = "$." + ".".join(parents[: i + 1])
            node = F.when(F.schema_of_variant(F.try_variant_get(v, prefix, "variant")).startswith("OBJECT"), node)
        root_ok = F.schema_of_variant(v).startswith("OBJECT")
        node = F.when(root_ok, node)
    kind = F.schema_of_variant(node)
    arr = F.try_variant_get(node, "$", "array<variant>")
    items = (F.when(node.isNull(), F.array().cast("array<variant>"))
              .when(kind.startswith("ARRAY"), arr)
              .when(F.lit(not path) & ~kind.startswith("OBJECT"), F.array().cast("array<variant>"))
              .otherwise(F.array(node)))
    return df.select("*", F.explode(items).alias("_rec")).select(
        *[F.col(c) for c in df.columns], F.to_json(F.col("_rec")).alias(out))


def sensor_objects(df: DataFrame, body: str, out: str = "sensors") -> DataFrame:
    """B2: the ``sensors`` object of a response body if present, else the whole body."""
    v = F.try_parse_json(F.col(body))
    inner = F.try_variant_get(v, "$.sensors", "variant")
    return df.withColumn(out, F.to_json(F.coalesce(inner, v)))


_SERIES = "array<struct<sensor:string,pos:int,v:struct<timestamp:string,value:double>>>"


def _readings(sensor: str, values: Column) -> Column:
    return F.transform(values, lambda e, i: F.struct(
        F.lit(sensor).alias("sensor"), i.alias("pos"),
        F.struct(F.try_variant_get(e, "$.timestamp", "string").alias("timestamp"),
                 F.try_variant_get(e, "$.value", "double").alias("value")).alias("v"))).cast(_SERIES)


def sensor_pivot(df: DataFrame, sensors_json: str, keys: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """Column-oriented sensor series → one wide row per (keys, timestamp).

    Readings with a truthy timestamp and a non-null value of an allowed sensor
    are kept; for one sensor and timestamp the last value in the series wins.
    The pivot columns are the fixed allow-list, so no job discovers them.
    """
    # only the listed sensors are looked at; whatever else the object holds, of any type, does no harm
    x = df.withColumn("_v", F.try_parse_json(F.col(sensors_json)))
    series = []
    for name in allowed:
        values = F.try_variant_get("_v", f"$['{name}'].values", "array<variant>")
        series.append(F.coalesce(_readings(name, values), F.array().cast(_SERIES)))
    p = x.select(*keys, F.explode(F.concat(*series)).alias("r")).select(*keys, "r.sensor", "r.pos", "r.v")
    p = p.filter((F.col("v.timestamp").isNotNull()) & (F.col("v.timestamp") != "") & F.col("v.value").isNotNull())
    aggs = [F.max_by(F.when(F.col("sensor") == s, F.col("v.value")),
                     F.when(F.col("sensor") == s, F.col("pos"))).alias(s) for s in allowed]
    return p.groupBy(*keys, F.col("v.timestamp").alias("timestamp")).agg(*aggs)


# ------------------------------------------------------------------ B4–B14 projections

def map_columns(df: DataFrame, columns: dict[str, str], keep: Iterable[str] = ()) -> DataFrame:
    """Rename mapped source columns that are present; unmapped ones are dropped."""
    sel = [F.col(f"`{src}`").alias(dst) for src, dst in columns.items() if src in df.columns]
    return df.select(*[F.col(k) if isinstance(k, str) else k for k in keep], *sel)


def drop_empty_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose (listed) columns are all NULL."""
    return df.dropna(how="all", subset=list(subset) if subset else None)


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN/±Inf → NULL in floating columns (all of them by default)."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cols = [c for c in (cols or fl) if c in fl]
    return df.withColumns({c: C.nan_to_null(c) for c in cols}) if cols else df


# Summary-row labels removed from spreadsheet exports.
SUMMARY_LABELS = ("AVG", "SUM", "TOTAL", "AVERAGE")


def drop_summary_rows(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """If a column is exactly ``Date``, drop rows labelled AVG/SUM/TOTAL/AVERAGE.

    The comparison is on the upper-cased text without trimming; NULL dates are kept.
    """
    if date_col not in df.columns:
        return df
    return df.filter(~is_summary_row(F.col(f"`{date_col}`")))


def is_summary_row(date_text: Column) -> Column:
    """B8 predicate: the ``Date`` text, upper-cased without trimming, is a summary label (NULL → False)."""
    return F.coalesce(F.upper(date_text).isin(*SUMMARY_LABELS), F.lit(False))


def iso_text(c) -> Column:
    """Timestamp → ``yyyy-MM-ddTHH:mm:ss`` text."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def row_numbers(df: DataFrame, part: str, order: str, name: str = "row_number",
                bucket: Column | None = None, bucket_rows: int = 1 << 16) -> DataFrame:
    """1-based row number within ``part`` in ``order`` — skew-safe.

    A plain ``row_number() over (partition by part)`` sorts a whole file in one
    task; a hot file then stalls the job.  Instead rows are cut into ordered
    buckets (``bucket``, default ``order div bucket_rows``), bucket counts give
    each bucket's offset (a small prefix sum), and rows are ranked only within
    (part, bucket) — every window partition is bounded by the bucket size.
    """
    b = bucket if bucket is not None else F.floor(F.col(order) / F.lit(bucket_rows))
    x = df.withColumn("_rb", b)
    counts = x.groupBy(part, "_rb").agg(F.count(F.lit(1)).alias("_rn"))
    prior = Window.partitionBy(part).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(part, "_rb", F.coalesce(F.sum("_rn").over(prior), F.lit(0)).alias("_off"))
    within = Window.partitionBy(part, "_rb").orderBy(order)
    j = join_dimension(x, offs, [part, "_rb"])
    return j.withColumn(name, F.col("_off") + F.row_number().over(within)).drop("_rb", "_off")


def with_provenance(df: DataFrame, dataset: str, source_type: Column | str, source_file: Column | str | None,
                    device_id: Column | None, ingestion_method: str = "batch", ingested_at=None,
                    api_endpoint: Column | str | None = None) -> DataFrame:
    """Provenance columns; ``device_id`` only for energy datasets."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    cols = {
        "source_type": C.source_type(lit(source_type)),
        "source_file": lit(source_file).cast("string"),
        "source_api_endpoint": lit(api_endpoint).cast("string"),
        "source_device_id": (device_id.cast("string") if device_id is not None else F.lit(None).cast("string")),
        "ingestion_method": F.lit(ingestion_method),
        "ingested_at": (ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)).cast("timestamp_ntz"),
    }
    if "energy" in dataset and device_id is not None:
        cols["device_id"] = device_id
    return df.withColumns(cols)


def strip_internal(df: DataFrame) -> DataFrame:
    """Drop internal columns (names starting with ``_``) before a sink."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def sanitize_json(df: DataFrame, cols: Sequence[str], out: str = "json") -> DataFrame:
    """JSON text of ``cols`` with NaN/±Inf written as null (null keys kept)."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    exprs = [C.nan_to_null(c).alias(c) if c in floats else F.col(c) for c in cols]
    return df.withColumn(out, F.to_json(F.struct(*exprs), {"ignoreNullFields": "false"}))
