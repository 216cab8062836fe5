"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next one.

Every stage takes (spark, docs, sf_dir) and calls one operator of ``pasture.llm``; what it decides takes effect in
the rows that the next stage reads.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pasture.llm.bpe_transducer import round_trip
from pasture.llm.decontaminate import without_benchmark
from pasture.llm.pii_spans import redact
from pasture.llm.quality_ledger import keep_good
from pasture.llm.scratch import stored
from pasture.llm.simhash_dedup import keep_one
from pasture.session import apply_defaults
from pasture.sources.tables import table


TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return keep_one(docs, shingle=3, radius=2, seed=42)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count, ids and decoded text (as digests) of what is left."""
    return round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("pii", mask_pii),
    ("bpe", tokenize),
]

#: SQL cannot express the stages; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the last stage's rows."""
    apply_defaults(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
