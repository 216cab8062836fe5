"""Join helpers with an explicit, checked broadcast decision.

Two checks, both on sizes rather than on hope:

1. plan time — a side is hinted for broadcast only when Catalyst's estimate of
   its optimized plan is under a bound.  Without table statistics Catalyst
   over-estimates joins (product of the inputs), so a derived dimension often
   fails this check; that is the safe direction.
2. run time — otherwise the join is planned as sort-merge and AQE replaces it
   with a broadcast only if the *materialised* shuffle output of a side is
   under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits skewed
   partitions when it is not.

Nothing that grows with the data is broadcast without one of these checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_BROADCAST_BYTES = 16 * 1024 * 1024


def plan_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's estimate of ``df``'s size in bytes (None if unavailable)."""
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(v) if isinstance(v, int) else int(v.toString())
    except Exception:  # pragma: no cover - e.g. Spark Connect sessions
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only when its estimated size is under ``max_bytes``."""
    bound = max_bytes if max_bytes is not None else DEFAULT_BROADCAST_BYTES
    size = plan_size_bytes(df)
    if size is not None and size <= bound:
        return F.broadcast(df)
    return df


def join_dimension(fact: DataFrame, dim: DataFrame, on: Column | str | list,
                   how: str = "inner", max_bytes: int | None = None) -> DataFrame:
    """Fact ⋈ dimension, broadcasting the dimension only behind the size check."""
    return fact.join(broadcast_if_small(dim, max_bytes), on, how)
