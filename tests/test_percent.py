"""Percentages against Python's own rounding of the same doubles."""

from pyspark.sql import functions as F

from pasture.functions.numeric import pct


def test_pct_rounds_like_python(spark):
    pairs = [(k, n) for n in (1, 3, 7, 8, 16, 33, 64, 160, 800, 1600, 4000, 3200, 12_345, 1_000_003) for k in {0, 1, 2, 3, 5, 7, 11, 41, 99, 1234, n // 3, n - 1, n} if k <= n]
    pairs += [(k, 800) for k in range(0, 800, 3)] + [(k, 4000) for k in range(1, 4000, 13)] + [(5, 0)]
    got = spark.createDataFrame(pairs, "k long, n long").select("k", "n", pct(F.col("k"), F.col("n")).alias("p")).collect()
    assert [(r["k"], r["n"], r["p"]) for r in got if r["p"] != (round(r["k"] / r["n"] * 100, 2) if r["n"] else 0.0)] == []
