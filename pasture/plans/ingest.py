"""Batch ingestion plan: map → coerce → validate → stage → split → metrics.

``stage_batch`` turns a raw all-string frame (many input files at once,
keyed by ``file_id``) into the staging frame in one projection.  The valid
and invalid sides are two filters over that frame; the caller persists the
staging frame once (a written table) so both sides and the metrics read it
instead of recomputing the parse.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pasture.functions.numeric import pct
from pasture.operators.rules import DatasetSpec, validate


def raw_json(df: DataFrame, cols: list[str]) -> Column:
    """the raw record as JSON text (blank values kept as keys)."""
    return F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in cols]), {"ignoreNullFields": "false"})


def stage_batch(raw: DataFrame, spec: DatasetSpec, created_at: Column | None = None,
                keep: tuple[str, ...] = ("file_id", "row_number")) -> DataFrame:
    """One staging row per raw row with typed values, errors and validity."""
    data_cols = [c for c in raw.columns if c not in keep and not c.startswith("_")]
    x = raw.withColumn("raw_data", raw_json(raw, data_cols))
    if created_at is not None:
        x = x.withColumn("created_at", created_at)
        keep = (*keep, "created_at")
    return validate(x, spec, keep=[*keep, "raw_data"])


def first_error(errors: Column, attr: str) -> Column:
    """Attribute of the first error (the rule that fired first)."""
    return F.try_element_at(errors, F.lit(1))[attr]


@dataclass
class BatchResult:
    staged: DataFrame
    valid: DataFrame
    invalid: DataFrame


def split(staged: DataFrame) -> BatchResult:
    """Valid and invalid sides of one staged frame."""
    return BatchResult(staged, staged.filter("is_valid"), staged.filter("NOT is_valid"))


def error_breakdown(staged: DataFrame, sample_rows: int | None = None, sample_size: int = 10) -> DataFrame:
    """Per file and error type — error count, rate over the file's rows, sample.

    All errors count.  The sample holds the first ``sample_size`` failures by row number, cut by a limited rank
    before the shuffle.  ``sample_rows`` restricts counts and sample to the first so many invalid rows of a file.
    """
    key = ["file_id", "check_type"]
    rows = staged.select("file_id", "row_number", "is_valid", "errors")
    if sample_rows is not None:
        w = Window.partitionBy("file_id", "is_valid").orderBy("row_number")
        rows = rows.withColumn("_k", F.row_number().over(w)).withColumn(
            "errors", F.when(F.col("is_valid") | (F.col("_k") <= sample_rows), F.col("errors"))).drop("_k")
    e = rows.select("file_id", "row_number", F.posexplode_outer("errors").alias("pos", "err"))
    e = e.select("file_id", F.col("err.error_type").alias("check_type"), "row_number", "pos", F.col("err.field").alias("field"))
    # one aggregate for both: every row has one entry without position or with position 0
    counts = e.groupBy(*key).agg(F.count("pos").alias("failed_count"),
                                 F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("_rows"))
    counts = counts.withColumn("total_count", F.sum("_rows").over(Window.partitionBy("file_id"))).filter("check_type is not null")
    e = e.filter("check_type is not null")
    first = e.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy("row_number", "pos")))
    first = first.filter(F.col("_k") <= sample_size).groupBy(*key).agg(        # at most sample_size rows a group
        F.array_sort(F.collect_list(F.struct("row_number", "pos", "field"))).alias("_sample"))
    first = first.withColumn("sample_failures", F.array_join(F.transform(
        "_sample", lambda s: F.concat(s["row_number"].cast("string"), F.lit(":"), s["field"])), "; ")).drop("_sample")
    out = counts.join(first, key)
    return out.select("file_id", "check_type", F.concat(F.col("check_type"), F.lit("_validation")).alias("check_name"),
                      (F.col("failed_count") == 0).alias("passed"), "failed_count", "total_count",
                      pct(F.col("failed_count"), F.col("total_count")).alias("failure_rate"), "sample_failures")


def overall_quality(staged: DataFrame) -> DataFrame:
    """Per file — passed iff no invalid row; failure rate; summary text."""
    g = staged.groupBy("file_id").agg(F.count(F.lit(1)).alias("total_count"),
                                      F.count_if("is_valid").alias("valid"),
                                      F.count_if(~F.col("is_valid")).alias("failed_count"))
    return g.select("file_id", F.lit("overall").alias("check_type"), F.lit("overall_validation").alias("check_name"),
                    (F.col("failed_count") == 0).alias("passed"), "failed_count", "total_count",
                    pct(F.col("failed_count"), F.col("total_count")).alias("failure_rate"),
                    F.format_string("%d valid, %d invalid", F.col("valid"), F.col("failed_count")).alias("summary"))


def run_metrics(staged: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Per-file run metrics: extracted, valid, invalid, loaded, skipped, quality."""
    g = staged.groupBy("file_id").agg(F.count(F.lit(1)).alias("extract_records"),
                                      F.count_if("is_valid").alias("valid_records"),
                                      F.count_if(~F.col("is_valid")).alias("invalid_records"))
    if loaded is not None:
        lg = loaded.groupBy("file_id").agg(F.count(F.lit(1)).alias("loaded_records"))
        g = g.join(lg, "file_id", "left").fillna(0, ["loaded_records"])
    else:
        g = g.withColumn("loaded_records", F.col("valid_records"))
    return g.select(
        "file_id", "extract_records", "valid_records", "invalid_records", "loaded_records",
        (F.col("valid_records") - F.col("loaded_records")).alias("skipped_records"),
        F.when(F.col("invalid_records") == 0, "passed").otherwise("partial").alias("validation_status"),
        pct(F.col("valid_records"), F.col("extract_records")).alias("quality_score"))
