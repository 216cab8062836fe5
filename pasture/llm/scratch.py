"""Shared scratch tables: how the operators here cut lineage and reread small intermediate results.

Every table goes to a fresh folder below ``spark.checkpoint.dir``, which driver and executors share, through
Spark's own Parquet writer; a lost executor therefore never takes an intermediate result with it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pasture.session import ensure_checkpoint_dir


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names, as a URI; a new temporary one only in local mode where none is named."""
    return ensure_checkpoint_dir(spark)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/pasture-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back (empty frames included)."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast (name=type); extra columns of the input, whatever their names, are left out."""
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in columns.items()))


def kept(df: DataFrame, condition) -> DataFrame:
    """Rows of ``df`` where ``condition`` holds, tested after ``df``'s columns are computed.

    The optimiser would otherwise copy long column expressions into the filter, once for every use; it moves no filter
    below a column that depends on the partition.
    """
    return df.withColumn("__part", F.spark_partition_id()).where(condition & (F.col("__part") >= 0)).drop("__part")
