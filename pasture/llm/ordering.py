"""Ranks within groups of any size, by one range exchange."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pasture.llm.scratch import stored


def _places(batches, group: str):
    """The batches of one sorted range with ``place``: rows of the same group before it in this range."""
    last, held = None, 0                            # the group at the end of the rows so far, and its rows
    for b in batches:
        if not b.num_rows:
            continue
        g = b.column(group)
        new = np.ones(b.num_rows, bool)
        if b.num_rows > 1:
            a, z = g.slice(0, b.num_rows - 1), g.slice(1)
            same = np.asarray(pc.fill_null(pc.equal(a, z), False)) | (
                np.asarray(a.is_null()) & np.asarray(z.is_null()))
            new[1:] = ~same
        starts = np.flatnonzero(new)
        place = np.arange(b.num_rows) - np.repeat(starts, np.diff(starts, append=b.num_rows))
        until = starts[1] if len(starts) > 1 else b.num_rows
        head = (g[0].as_py(),)
        carried = held if last == head else 0
        place[:until] += carried
        last, held = (g[-1].as_py(),), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place, pa.int64())], [*b.schema.names, "place"])


def ranked(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``rank``: 0, 1, 2 … within ``group`` (null is a group) by ``order``, nulls first; a stored table.

    Rows go to ranges of (group, order), so a group of any size spreads over many tasks, and equal rows over several
    (their ranks are interchangeable).  Only the first group of a range can have begun in an earlier one: the offsets
    that are broadcast are at most one row per range.  ``df`` has to be a stored table; it is read twice.
    """
    keys = [group, *order]
    salted = df.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    ranged = salted.repartitionByRange(*keys, "salt").sortWithinPartitions(*keys).drop("salt")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    placed = ranged.mapInArrow(lambda it: _places(it, group), f"{fields}, place bigint")
    placed = stored(placed.withColumn("range", F.spark_partition_id()), name)
    runs = placed.groupBy("range", group).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(F.col("range").alias("at"), F.col(group).alias("of"), F.sum("n").over(before).alias("n"))
    offsets = offsets.where("n > 0")                # one row per range at most
    same = (placed["range"] == offsets["at"]) & placed[group].eqNullSafe(offsets["of"])
    j = placed.join(F.broadcast(offsets), same, "left")
    return j.select(*df.columns, (F.col("place") + F.coalesce("n", F.lit(0))).alias("rank"))
