"""Benchmark decontamination by item-sized SimHash windows.

1. Seeds place windows.  A window whose similarity to an item is at least ``similarity`` shares all but a bounded part
   of its shingles with the item, so somewhere it has a run of shared shingles; probing every ``stride``-th position of
   a document, ``stride`` being the shortest such run over the items, meets each of them.  A hit puts windows of its
   item's size where the shingle has the item's offset, give or take the words that may be missing or inserted.
2. Every window gets a SimHash and goes to a multi-index over radius + 1 blocks, which holds, among the items of the
   window's size, all fingerprints within the radius, as one block at least has no differing bit.
3. A window can be alike enough and still lie beyond the radius where the words that may be replaced can turn more than
   ``radius`` majorities of an item's bits (``loose`` items, nearly all but repetitive ones; passages that have lost their
   head or tail).  Their seeds name the item, and a window beyond its radius is a candidate for that item beside the
   index's, so the radius costs time, never a match.
4. Candidates are verified exactly: weighted Jaccard similarity of five-word shingles, the weight of a shingle being
   how often it occurs.

Only DataFrame functions: the documents are read once, their words never leave the scan's stage (the seed table and the
index are broadcast only when their rows and bytes are counted to be few, and joined by shuffles otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasture.llm.scratch import kept, stored

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 11
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20           # of a table that is broadcast, at most


def words(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits; none for null."""
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _shingle_hash(at: str, i: Column) -> Column:
    return F.xxhash64(*(F.get(at, i + k) for k in range(SHINGLE)))


def with_simhash(df: DataFrame, at: str) -> DataFrame:
    """``df`` with ``fp``, the 64-bit SimHash of the word array ``at``: a bit is set if over half of the words set it."""
    return df.withColumn("hashes", F.transform(at, lambda w: F.xxhash64(w))).withColumn("fp", F.expr(
        "aggregate(sequence(0, 63), 0L, (fp, b) -> fp | if(2 * size(filter(hashes, h -> getbit(h, b) = 1)) > size(hashes),"
        " shiftleft(1L, b), 0L))")).drop("hashes")


def _with_loose(items: DataFrame, similarity: float, radius: int) -> DataFrame:
    """``items`` with ``loose``: whether a window at least ``similarity`` alike may differ in more than ``radius`` bits.

    Of 2n shingles at most 2n (1 - s) / (1 + s) are not shared; shared ones share their first words, so at most that
    many words, and the last SHINGLE - 1 of both sides, differ, each of which moves a bit's majority by one.
    """
    moved = F.floor(2 * (F.col("size") - SHINGLE + 1) * (1 - similarity) / (1 + similarity) + 1e-9) + 2 * (SHINGLE - 1)
    items = items.withColumns({"hashes": F.transform("words", lambda w: F.xxhash64(w)), "moved": moved})
    turned = F.expr("size(filter(sequence(0, 63), b -> abs(2 * size(filter(hashes, h -> getbit(h, b) = 1)) - size) <= moved))")
    return items.withColumn("loose", turned > radius).drop("hashes", "moved")


def _blocks(fp: Column, radius: int) -> Column:
    """The radius + 1 blocks of a fingerprint, as an array."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(*(F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])))


def _numbered(shingles: Column) -> Column:
    """Shingles with their occurrence number, which turns a weighted set into a plain one."""
    return F.when(F.size(F.array_distinct(shingles)) == F.size(shingles), F.transform(shingles, lambda s: F.concat(s, F.lit(" 0")))) \
        .otherwise(F.transform(shingles, lambda s, i: F.concat(s, F.lit(" "), F.size(F.filter(
            F.slice(shingles, 1, i), lambda t: t == s)).cast("string"))))


def _shingles(at: str) -> Column:
    return F.slice(F.transform(at, lambda w, i: F.concat_ws(" ", F.slice(F.col(at), i + 1, SHINGLE))), 1,
                   F.greatest(F.size(at) - (SHINGLE - 1), F.lit(0)))


def run_length(n: int, similarity: float = SIMILARITY) -> int:
    """The shortest longest run of shared shingles in a window of n shingles at least ``similarity`` alike: of 2n
    shingles at most n (1 - s) / (1 + s) of the window's are not shared, and they cut the rest into runs."""
    lost = int(n * (1 - similarity) / (1 + similarity) + 1e-9)
    return max(1, -(-(n - lost) // (lost + 1)))


def _stride(items: DataFrame, similarity: float) -> int:
    """The probing step: the least run over all shingle counts a window of any item may have."""
    least = items.agg(F.min("size")).first()[0]
    n = int(similarity * ((least or SHINGLE) - SHINGLE + 1)) or 1
    return min(run_length(m, similarity) for m in range(n, n + 200))


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, size) of items with a shingle; shorter ones name no passage and match nothing."""
    d = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), words(F.col("text")).alias("words"))
    return d.withColumn("size", F.size("words")).where(F.col("size") >= SHINGLE)


def _small(table: DataFrame, row_bytes: Column | int) -> DataFrame:
    """``table`` with a broadcast hint if it has few rows and bytes; Spark picks the join otherwise."""
    size = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    n, total = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()
    return F.broadcast(table) if n <= BROADCAST_ROWS and total <= BROADCAST_BYTES else table


def _candidates(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """(doc_id, did, tid, start, words, item_id, indexed) from windows (…, size, item, start, words, fp).

    ``indexed``: the multi-index found the item; otherwise the window lies beyond the radius of the item its seed named.
    """
    cols = ("doc_id", "did", "tid", "start", "words")
    blocks = _blocks(F.col("fp"), radius)
    index = items.select("item_id", "size", F.col("fp").alias("item_fp"), blocks.alias("item_blocks"),
                         F.explode(F.sequence(F.lit(0), F.lit(radius))).alias("k"))
    index = index.withColumn("block", F.get("item_blocks", F.col("k")))
    probes = windows.dropDuplicates(["did", "tid", "size", "start"]).withColumn("blocks", blocks)
    probes = probes.select(*cols, "size", "fp", "blocks", F.posexplode("blocks").alias("k", "block"))
    near = probes.join(_small(index, 64 + 8 * (radius + 1)), ["size", "k", "block"])
    # a pair that agrees in several blocks counts in the first of them
    first = F.array_position(F.zip_with("blocks", "item_blocks", lambda a, b: a == b), True) == F.col("k") + 1
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius
    found = near.where(first & close).select(*cols, "item_id", F.lit(True).alias("indexed"))
    own = items.select("item_id", F.col("fp").alias("item_fp"))
    beyond = windows.where("item IS NOT NULL").join(_small(own, 24), F.col("item.id").eqNullSafe(F.col("item_id")))
    beyond = beyond.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) > radius)
    return found.unionByName(beyond.select(*cols, "item_id", F.lit(False).alias("indexed")))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, did, tid, item_id, start, similarity, indexed): for every document and item the best verified window, and
    whether the multi-index found one of them.

    did and tid key a row by its id and text, so rows that repeat both are one document.  Null and empty texts match
    nothing; an empty benchmark or document table gives an empty result.
    """
    items = stored(_with_loose(with_simhash(items_of(benchmark), "words"), similarity, radius), "items")
    stride = _stride(items, similarity)
    named = F.when(F.col("loose"), F.struct(F.col("item_id").alias("id")))       # of null ids too
    seeds = stored(items.select("size", named.alias("item"), F.explode(F.transform(
        F.sequence(F.lit(0), F.col("size") - SHINGLE), lambda i: F.struct(_shingle_hash("words", i).alias("h"), i.alias("off")))).alias("s"))
        .select("s.h", "s.off", "size", "item").distinct(), "seeds")
    doc = F.col("doc_id").cast("bigint")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(0)).alias("did"), F.xxhash64(doc, text).alias("tid"),
                    words(text).alias("words"))
    probes = F.transform(F.sequence(F.lit(0), F.size("words") - SHINGLE, F.lit(stride)),
                         lambda i: F.struct(_shingle_hash("words", i).alias("h"), i.alias("pos")))
    # exploded from a column of its own, and outer: so the explosion and the probe of the seed table share one compiled
    # stage, and ``words`` is copied for hits only
    d = d.withColumn("probes", F.when(F.size("words") >= SHINGLE, probes))
    few = seeds.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    if few:
        hits = d.select("doc_id", "did", "tid", "words", F.explode_outer("probes").alias("p")).select("*", F.col("p.h").alias("h"))
        hits = hits.join(F.broadcast(seeds), "h").select(
            "doc_id", "did", "tid", "words", "size", "item", (F.col("p.pos") - F.col("off")).alias("at"))
    else:
        hits = d.select("did", "tid", F.explode_outer("probes").alias("p")).select("did", "tid", "p.*").join(seeds, "h")
        hits = hits.select("did", "tid", "size", "item", (F.col("pos") - F.col("off")).alias("at")).distinct()
        hits = d.drop("probes").dropDuplicates(["did", "tid"]).join(hits, ["did", "tid"])
    slack = F.floor(F.col("size") / 36).cast("int") + 1
    first = F.greatest(F.col("at") - slack, F.lit(0))
    hits = hits.select("doc_id", "did", "tid", "size", "item", "at", F.size("words").alias("total"), slack.alias("slack"), first.alias("first"),
                       F.slice("words", first + 1, F.col("size") + 2 * slack + 1).alias("near"))
    # one row per document, size, loose item and place, merged before the shuffle
    hits = hits.groupBy("did", "tid", "size", "item", "at").agg(
        *(F.first(c).alias(c) for c in ("doc_id", "total", "slack", "first", "near")))
    last = F.greatest(F.least(F.col("at") + F.col("slack"), F.col("total") - F.col("size")), F.lit(0))
    windows = hits.withColumn("start", F.explode(F.sequence(F.least(F.col("first"), last), last)))
    windows = windows.select("doc_id", "did", "tid", "size", "item", "start",
                             F.slice("near", F.greatest(F.col("start") - F.col("first"), F.lit(0)) + 1, F.col("size")).alias("words"))
    windows = stored(with_simhash(windows, "words"), "windows")
    texts = items.select(F.col("item_id").alias("its"), F.col("words").alias("item_words"))
    wide = F.expr("aggregate(item_words, 64L, (a, w) -> a + length(w) + 32)")
    near = _candidates(windows, items, radius).join(_small(texts, wide), F.col("item_id").eqNullSafe(F.col("its")))
    near = near.withColumns({"a": _shingles("words"), "b": _shingles("item_words")})
    near = near.withColumns({"a": _numbered(F.col("a")), "b": _numbered(F.col("b"))})
    both = F.size(F.array_intersect("a", "b"))
    near = near.withColumn("similarity", both / F.greatest(F.size("a") + F.size("b") - both, F.lit(1)))
    return (kept(near, F.col("similarity") >= similarity).groupBy("did", "tid", "item_id")
            .agg(F.first("doc_id").alias("doc_id"), F.max("similarity").alias("similarity"), F.max("indexed").alias("indexed"),
                 F.max_by("start", F.struct("similarity", -F.col("start"))).alias("start")))


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start, similarity): each benchmark item that a document holds, with its best window."""
    found = matches(docs, benchmark, similarity, radius)
    return found.select("doc_id", "item_id", "start", F.round("similarity", 6).alias("similarity"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no benchmark item; null and empty texts hold none and stay."""
    bad = stored(matches(docs, benchmark, similarity, radius).select(
        F.col("did").alias("__did"), F.col("tid").alias("__tid")).distinct(), "contaminated")
    doc = docs["doc_id"].cast("bigint")
    key = (F.coalesce(doc, F.lit(0)) == bad["__did"]) & (
        F.xxhash64(doc, F.coalesce(docs["text"].cast("string"), F.lit(""))) == bad["__tid"])
    return docs.join(bad, key, "left_anti")
