"""Key-conflict resolution and the partitioned fact sink.

The reference upserts row by row (``INSERT … ON CONFLICT``).  Here the whole
batch is resolved at once: existing rows and batch rows are unioned with an
order column (existing first, then batch line order) and grouped by the key.
``max_by``/``min_by`` pick the last/first row's value per column — a hash
aggregate with map-side partial aggregation, so a hot key collapses before
the shuffle and no window sort is needed.

Strategies: ``update`` (listed columns from the last row, the rest from the
first — existing — row), ``ignore`` and ``append`` (keep the first row),
``fail`` (any conflict is an error), and plain insert when no key is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pasture.operators import snapshots as SN
from pasture.operators.joins import broadcast_if_small

ORDER = "_upsert_order"


def _ordered(target: DataFrame | None, batch: DataFrame, seq: str | None) -> DataFrame:
    # a struct: existing rows first, then the batch by its own order (a number or a struct of any depth)
    own = F.col(seq) if seq else F.monotonically_increasing_id()
    kind = batch.schema[seq].dataType if seq else "long"
    b = batch.withColumn(ORDER, F.struct(F.lit(1).alias("new"), own.alias("at")))
    if target is None:
        return b
    t = target.withColumn(ORDER, F.struct(F.lit(0).alias("new"), F.lit(None).cast(kind).alias("at")))
    if seq and seq not in t.columns:
        t = t.withColumn(seq, F.lit(None).cast(batch.schema[seq].dataType))
    return t.unionByName(b.select(*t.columns), allowMissingColumns=False)


def upsert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], strategy: str = "update",
           update_columns: Sequence[str] | None = None, seq: str | None = None) -> DataFrame:
    """New state of the keyed rows touched by ``batch`` plus all other ``target`` rows.

    ``seq`` orders batch rows (line order); existing rows always come first.
    Only target rows whose key occurs in the batch enter the aggregation; the
    rest are separated by a semi/anti join against the batch's distinct keys
    (broadcast when their size check passes) and never change, even where
    they share a key with each other.  A key with a NULL conflicts with
    nothing, as in a unique constraint: such batch rows are inserted as they are.
    """
    keys = list(keys)
    if not keys:
        return batch if target is None else target.unionByName(batch)            # F12 plain insert
    if strategy == "append":
        strategy = "ignore"                                                       # F11 (decision Q7)
    if strategy == "fail":                                                        # F10
        conflicts = conflict_keys(target, batch, keys)
        if not conflicts.isEmpty():
            raise ValueError(f"upsert(strategy='fail'): conflicting keys, e.g. {conflicts.first()}")
        return _ordered(target, batch, seq).drop(ORDER)
    if strategy not in ("update", "ignore"):
        raise ValueError(f"unknown conflict strategy {strategy!r}")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    loose = batch.filter(~known)
    batch = batch.filter(known)
    untouched = None
    if target is not None:
        bk = broadcast_if_small(batch.select(*keys).distinct())
        untouched = target.join(bk, keys, "left_anti")
        target = target.join(bk, keys, "left_semi")
    u = _ordered(target, batch, seq)
    cols = [c for c in u.columns if c not in keys and c != ORDER]
    if strategy == "update":                                                      # F8
        upd = set(update_columns or cols)
        aggs = [(F.max_by(c, ORDER) if c in upd else F.min_by(c, ORDER)).alias(c) for c in cols]
    else:                                                                         # F9
        aggs = [F.min_by(c, ORDER).alias(c) for c in cols]
    resolved = u.groupBy(*keys).agg(*aggs)
    resolved = resolved.unionByName(loose.select(*resolved.columns))
    if untouched is None:
        return resolved
    if seq and seq not in untouched.columns:
        untouched = untouched.withColumn(seq, F.lit(None).cast(batch.schema[seq].dataType))
    return untouched.unionByName(resolved.select(*untouched.columns))


def conflict_keys(target: DataFrame | None, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys that occur more than once in target ∪ batch, with their row count."""
    sel = [F.col(k) for k in keys]
    u = batch.select(*sel) if target is None else target.select(*sel).unionByName(batch.select(*sel))
    return u.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def outcome(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], strategy: str) -> DataFrame:
    """rows loaded vs skipped for a strategy (one row).

    ``update``: every batch row is applied (loaded); ``ignore``/``append``: a row
    loads only if its key is new and it is the key's first batch row.
    """
    keys = list(keys)
    kb = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if target is not None:
        kt = target.select(*keys).distinct().withColumn("_exists", F.lit(True))
        kb = kb.join(kt, keys, "left")
    else:
        kb = kb.withColumn("_exists", F.lit(None).cast("boolean"))
    new = F.col("_exists").isNull()
    agg = kb.agg(F.sum("n").alias("batch_rows"),
                 F.count_if(new).alias("inserted_keys"),
                 F.count_if(~new).alias("updated_keys"))
    if strategy == "update":
        loaded = F.col("batch_rows")
    else:
        loaded = F.col("inserted_keys")
    return agg.select(F.lit(strategy).alias("strategy"), F.col("batch_rows"), loaded.alias("loaded"),
                      (F.col("batch_rows") - loaded).alias("skipped"), "inserted_keys", "updated_keys")


# ------------------------------------------------------------------ snapshot sink

def month_col(c: str, grain: str = "month") -> Column:
    """Partition value of a time column: ``yyyy-MM`` (month) or ``yyyy-MM-dd`` (day)."""
    return F.date_format(F.col(c), "yyyy-MM-dd" if grain == "day" else "yyyy-MM")


RETRIES = 20
ROW = "_row"       # column of a fact table that no reader sees: the batch row a stored row came from, (run, file_id, row_number)
KEEP_FIRST = ("ignore", "append")      # strategies under which a batch row may be skipped


def write_upsert(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str], time_col: str,
                 strategy: str = "update", update_columns: Sequence[str] | None = None,
                 seq: str | None = None, grain: str = "month") -> int:
    """Upsert ``batch`` into the month-partitioned table of snapshots at ``path``; read it with ``read_facts``.

    Returns touched partitions; see ``commit_upsert``.
    """
    return len(commit_upsert(spark, batch, path, keys, time_col, strategy, update_columns, seq, grain)[1])


def commit_upsert(spark: SparkSession, batch: DataFrame, path: str, keys: Sequence[str], time_col: str,
                  strategy: str = "update", update_columns: Sequence[str] | None = None,
                  seq: str | None = None, grain: str = "month") -> tuple[SN.Snapshot, list[str]]:
    """The commit of ``write_upsert``; returns the snapshot committed and the partitions touched.

    Only partitions (months, or days with ``grain='day'``; the column is called ``month`` either way) the batch touches
    are read and rewritten; inside them only rows whose key the batch carries are shuffled (see ``upsert``).  Their new
    state goes to folders of its own and becomes visible by one atomic commit: a writer that dies half-way changes
    nothing, and of two writers that touch the same partition the second starts again from the first one's state.
    A batch with a ``ROW`` column leaves in every stored row which batch row won its key (F13): ``loaded_rows``.
    """
    path = path.rstrip("/")
    b = batch.withColumn("month", month_col(time_col, grain))
    touched = [r[0] for r in b.select(SN.part_of(F.col("month")).alias("p")).distinct().collect()]   # one row per month
    if not touched:
        return SN.load(spark, path), []                                # nothing valid in this batch
    _adopt(spark, path)
    for _ in range(RETRIES):
        base = SN.load(spark, path)
        existing = SN.read(spark, path, base, touched) if base.schema is not None else None
        old, new = (existing, b) if existing is None else _both_with_row(existing, b)
        new_state = upsert(old, new, list(keys) + ["month"] if "month" not in keys else keys,
                           strategy, update_columns, seq)
        if seq and seq in new_state.columns:
            new_state = new_state.drop(seq)
        changed = SN.write_parts(new_state, path, "month")
        try:
            return SN.commit(spark, path, base, changed, new_state.schema), touched
        except SN.Conflict:
            continue
    raise SN.Conflict(f"{path}: other writers came first {RETRIES} times")


def _both_with_row(existing: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give the side without ``ROW`` an empty one: a table from before it, or a batch whose strategy skips nothing."""
    if (ROW in existing.columns) == (ROW in batch.columns):
        return existing, batch
    kind = (existing if ROW in existing.columns else batch).schema[ROW].dataType
    none = F.lit(None).cast(kind)
    return (existing, batch.withColumn(ROW, none)) if ROW in existing.columns else (existing.withColumn(ROW, none), batch)


def loaded_rows(spark: SparkSession, path: str, snapshot: SN.Snapshot, parts: Sequence[str], run: str) -> DataFrame:
    """the batch rows (file_id, row_number) of a run that the table took, by what the commit of its batch holds.

    The winner of a key is written with the row it won, so this reads one column of the touched partitions and joins
    nothing.  A batch that is offered again finds the rows of its first commit, and gives the same answer.
    """
    rows = SN.read(spark, path.rstrip("/"), snapshot, list(parts))
    return rows.filter(F.col(f"{ROW}.run") == run).select(f"{ROW}.file_id", f"{ROW}.row_number")


def read_facts(spark: SparkSession, path: str, version: int | None = None, months: Sequence[str] | None = None) -> DataFrame:
    """One snapshot of a fact table (the newest by default), of all or some months."""
    path = path.rstrip("/")
    return SN.read(spark, path, SN.load(spark, path, version), None if months is None else list(months)).drop(ROW)


def _adopt(spark: SparkSession, path: str) -> None:
    """Commit a plain month-partitioned Parquet table as the first snapshot; its files are left where they are."""
    if not table_exists(spark, path) or SN.versions(spark, path):
        return
    if not any(n.startswith("month=") for n in SN.names(spark, path)):
        if any(not n.startswith("_") for n in SN.names(spark, path)):
            raise ValueError(f"{path} is neither a table of snapshots nor partitioned by month")
        return
    schema = T.StructType([f for f in spark.read.parquet(path).schema.fields if f.name != "month"])
    old = spark.read.schema(schema.add("month", T.StringType())).parquet(path)
    SN.commit(spark, path, SN.Snapshot(), SN.write_parts(old, path, "month"), old.schema)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
