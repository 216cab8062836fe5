"""Line dedup: hashes of lines in key order, per-document keep bitmaps instead of texts.

A line's key is the line without white space at its ends, A to Z lower-cased; 128 bits of hash stand for it.  Keys found
in at least ``min_docs`` documents are common.  ``keep="none"`` drops all lines of common keys; ``keep="first"`` keeps
each one's first occurrence, by document and position.

1. Every document counts once for each of its different keys (partial counts before the shuffle); common keys keep their
   count and their first document.
2. Lines and one marker row per common key are range-partitioned by hash and sorted by hash, document and position.
   The marker comes first, so one running pass tells every line whether its key is common and whether it is the key's
   first occurrence; nothing is paired.  A key with more than ``_share`` documents is split over several ranges, each
   with a marker of its own; such keys are at most ``HOT`` in number.
3. The dropped positions of a document become a run-length bitmap of the lines it keeps, which is what is returned.

DataFrame functions only.  Texts are shuffled once, when ``without_common_lines`` applies the bitmaps.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pasture.llm.scratch import pick, stored

SPACE = " \t\n\x0b\x0c\r"
HOT = 8192              # keys that are split at most: the size of the broadcast table of splits
LEAST_SHARE = 2000      # documents of a key that one range takes in any case
DOC = ("doc_id", "t1", "t2")


def key_of(line: Column) -> Column:
    """The line without ``[\\x20\\x09-\\x0D]`` at both ends, A to Z lower-cased (other letters stay)."""
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _hashes(x: Column) -> list[Column]:
    """Two 64-bit hashes with unlike seeds."""
    return [F.xxhash64(x), F.xxhash64(F.lit(1), x)]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, text): documents alike in id and text share their key, and their bitmap."""
    d = pick(docs, doc_id="bigint", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    one, two = _hashes(F.col("text"))
    return d.select("doc_id", one.alias("t1"), two.alias("t2"), "text")


def common_keys(docs: DataFrame, min_docs: int, first: bool = False) -> DataFrame:
    """(h1, h2, n_docs, first): keys of one code point or more found in at least ``min_docs`` documents (rows), with
    the least document that has them (null unless asked for: a struct cannot be aggregated by hash)."""
    d = _keyed(docs)
    keys = F.explode(F.array_distinct(F.transform(_lines(F.col("text")), key_of))).alias("key")
    one, two = _hashes(F.col("key"))
    found = d.select(*DOC, keys).where("key != ''").select(*DOC, one.alias("h1"), two.alias("h2"))
    doc = F.struct(*DOC)
    n = F.count(F.lit(1)).alias("n_docs")
    per = found.groupBy("h1", "h2")
    per = per.agg(n, F.min(doc).alias("first")) if first else per.agg(n).withColumn(
        "first", F.lit(None).cast("struct<doc_id:bigint,t1:bigint,t2:bigint>"))
    return per.where(F.col("n_docs") >= min_docs)


def _share(total: int) -> int:
    """Documents of one key that go to one range: at most ``HOT`` keys have more."""
    return max(LEAST_SHARE, total // HOT)


def line_bitmaps(docs: DataFrame, min_docs: int, keep: str = "none") -> DataFrame:
    """(doc_id, t1, t2, kept_runs, tail, n_dropped) of every document that loses lines; t1, t2: hash of its text.

    ``kept_runs``: runs (start, len) of kept lines between dropped ones; all lines from ``tail`` on are kept.  Null
    texts are empty, and empty lines never drop.  Rows alike in id and text are copies: each counts as a document, and
    they share one bitmap, so ``keep="first"`` keeps the first occurrence in all copies of that document.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep is 'none' or 'first', not {keep!r}")
    common = stored(common_keys(docs, min_docs, keep == "first"), "common_lines")
    total = common.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    splits = F.ceil(F.col("n_docs") / F.lit(_share(total))).cast("int")
    common = common.withColumn("splits", splits)
    hot = common.where("splits > 1").select("h1", "h2", "splits")           # at most HOT rows, by _share
    row = F.monotonically_increasing_id()                                   # copies of a document go apart, too
    d = _keyed(docs).withColumn("row", F.xxhash64(row))
    one, two = _hashes(F.col("key"))
    lines = d.select(*DOC, "row", F.posexplode(F.transform(_lines(F.col("text")), key_of)).alias("pos", "key"))
    lines = lines.where("key != ''").select(one.alias("h1"), two.alias("h2"), *DOC, "pos", "row")
    lines = lines.join(F.broadcast(hot), ["h1", "h2"], "left")
    lines = lines.select("h1", "h2", F.when(F.col("splits").isNull(), 0).otherwise(
        F.pmod("row", F.col("splits")).cast("int")).alias("part"), F.lit(1).alias("kind"), *DOC, "pos")
    if keep == "first":
        lines = lines.withColumn("first", F.lit(None).cast(common.schema["first"].dataType))
    marks = common.select("h1", "h2", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("part"),
                          F.lit(0).alias("kind"), *(F.lit(None).cast("bigint").alias(c) for c in DOC),
                          F.lit(None).cast("int").alias("pos"), *(["first"] if keep == "first" else []))
    # a window by the very columns of the ranges: no further exchange
    key = ["h1", "h2", "part"]
    order = Window.partitionBy(*key).orderBy("kind", *DOC, "pos")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = lines.unionByName(marks).repartitionByRange(*key)
    seen = ranged.withColumn("lead", F.min("kind").over(before))           # 0 behind a marker
    if keep == "first":     # the least document's lines lead their range
        seen = seen.withColumns({"of_key": F.first("first", ignorenulls=True).over(before),
                                 "at": F.first("pos", ignorenulls=True).over(before)})
        seen = seen.where(~(F.struct(*DOC).eqNullSafe(F.col("of_key")) & F.col("pos").eqNullSafe(F.col("at"))))
    gone = seen.where("kind = 1 AND lead = 0")
    per = gone.groupBy(*DOC).agg(F.sort_array(F.collect_set("pos")).alias("gone"))      # a document's own lines
    runs = F.transform("gone", lambda p, i: F.struct(
        (F.coalesce(F.get("gone", i - 1), F.lit(-1)) + 1).alias("start"),
        (p - F.coalesce(F.get("gone", i - 1), F.lit(-1)) - 1).alias("len")))
    return per.select(*DOC, F.filter(runs, lambda r: r["len"] > 0).alias("kept_runs"),
                      (F.element_at("gone", -1) + 1).alias("tail"), F.size("gone").alias("n_dropped"))


def kept_lines(text: Column, runs: Column, tail: Column) -> Column:
    """The lines of ``text`` that a bitmap keeps."""
    lines = _lines(text)
    inner = F.flatten(F.transform(runs, lambda r: F.slice(lines, r["start"] + 1, r["len"])))
    return F.concat(inner, F.slice(lines, tail + 1, F.greatest(F.size(lines) - tail, F.lit(0))))


def without_common_lines(docs: DataFrame, min_docs: int, keep: str = "none") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) per row of ``docs`` (doc_id, text); ``kept``: the lines left, joined by \\n.

    Null and empty texts have one empty line, which stays.  Repeated rows each return a row, rows without doc_id too.
    """
    bits = line_bitmaps(docs, min_docs, keep).select(*(F.col(c).alias(f"b_{c}") for c in DOC), "kept_runs", "tail", "n_dropped")
    d = _keyed(docs)
    same = d["doc_id"].eqNullSafe(bits["b_doc_id"]) & (d["t1"] == bits["b_t1"]) & (d["t2"] == bits["b_t2"])
    j = d.join(bits.hint("merge"), same, "left")
    left = F.array_join(kept_lines(F.col("text"), F.col("kept_runs"), F.col("tail")), "\n")
    return j.select("doc_id", F.size(_lines(F.col("text"))).cast("bigint").alias("n_lines"),
                    F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
                    F.when(F.col("tail").isNull(), F.col("text")).otherwise(left).alias("kept"))


def digests(docs: DataFrame, min_docs: int, keep: str = "none") -> DataFrame:
    """``without_common_lines`` with the text left as a digest."""
    return without_common_lines(docs, min_docs, keep).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def oracle_sql(min_docs: int) -> str:
    """DuckDB SQL for ``digests(documents, min_docs)``."""
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= {min_docs}),
s AS (SELECT rid, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS kept FROM k ANTI JOIN c USING (key) GROUP BY rid)
SELECT doc_id, len(ls)::BIGINT AS n_lines, (len(ls) - coalesce(n, 0))::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (rid)
"""
