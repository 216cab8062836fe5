"""SimHash near-duplicates by tiled exact comparison.

1. One pass over the texts gives a 64-bit fingerprint per document; equal fingerprints collapse to one row, with
   partial aggregation, so a group of copies costs one row however large it is.
2. Fingerprints are laid out in tiles by their population counts.  The count is taken per 16-bit lane: two
   fingerprints within ``radius`` bits have lane counts whose absolute differences add up to at most ``radius``,
   so all other tile pairs are skipped, and nothing within the radius is.  A tile with more than ``tile_rows``
   fingerprints is split by hash, so a tile pair always fits in a small array.
3. A tile pair is compared exactly (numpy exclusive-or and bit counts).  It returns a spanning forest of its
   links, at most one row per fingerprint, never all the pairs of a group.
4. Connected components over these rows give every document its class.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasture.llm.graph import components
from pasture.llm.scratch import pick, stored

LANES = 4                       # 16-bit lanes; the population count of each is 0..16
SIDE = 17
CELLS = SIDE ** LANES           # size bound of the tile directory: 83,521 entries
TILE_ROWS = 2048
_CHUNK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one UTF-8 text; a bit is set when over half of the shingle hashes (repeats included) set it."""
    words = (text or b"").lower().split()           # bytes: A-Z only, and exactly the six ASCII white-space bytes
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(shingle))))
    total, ones = 0, np.zeros(64, np.int64)
    while part := list(itertools.islice(grams, _CHUNK)):          # constant memory beside the words themselves
        h = np.array([xxhash.xxh64_intdigest(g, seed) for g in part], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, th, fp) per row of ``docs``; th: hash of the text; null and wordless texts have fingerprint zero."""
    def run(batches):
        for b in batches:
            fp = [fingerprint(t, shingle, seed) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(fp, pa.int64())], ["doc_id", "th", "fp"])

    d = pick(docs, doc_id="bigint", text="binary").withColumn("th", F.xxhash64("text"))
    return d.mapInArrow(run, "doc_id bigint, th bigint, fp bigint")


def _lane_counts(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view("<u2").reshape(-1, LANES)).astype(np.int64)


def _cell(counts: np.ndarray) -> np.ndarray:
    return counts @ (SIDE ** np.arange(LANES))


def _steps(radius: int) -> np.ndarray:
    """Differences of lane counts that two fingerprints within ``radius`` bits can have."""
    r = range(-radius, radius + 1)
    return np.array([s for s in itertools.product(r, repeat=LANES) if sum(map(abs, s)) <= radius], np.int64)


def _mixed(fp: np.ndarray) -> np.ndarray:
    x = fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(33)).astype(np.int64)


def _deal(batches, split: np.ndarray, radius: int):
    """A row (tile pair, side, fp) for every tile pair a fingerprint takes part in."""
    steps = _steps(radius)
    most = int(split.max(initial=1))
    for b in batches:
        fp = b.column("fp").to_numpy(zero_copy_only=False)
        counts = _lane_counts(fp)
        own = _cell(counts)
        mine = own * most + _mixed(fp) % np.maximum(split[own], 1)
        for s in steps:
            to = counts + s
            at = np.flatnonzero(((to >= 0) & (to < SIDE)).all(axis=1))
            near = _cell(to[at])
            at, near = at[split[near] > 0], near[split[near] > 0]
            parts = split[near]                       # every part of a split neighbour is a tile of its own
            rows = np.repeat(at, parts)
            part = np.arange(len(rows)) - np.repeat(np.cumsum(parts) - parts, parts)
            there, here = np.repeat(near, parts) * most + part, mine[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(here, there)), pa.array(np.maximum(here, there)),
                 pa.array((here > there).astype(np.int8)), pa.array(fp[rows])], ["lo", "hi", "side", "fp"])


def _forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between (or, where right is left, within) the two arrays."""
    same = right is left
    nodes = left if same else np.concatenate([left, right])
    shift = 0 if same else len(left)
    label = np.arange(len(nodes))
    us, vs = [], []
    for at in range(0, len(left), 256):
        i, j = np.nonzero(np.bitwise_count(left[at:at + 256, None] ^ right[None, :]) <= radius)
        i, j = i + at, j + shift
        if same:
            i, j = i[i < j], j[i < j]
        while len(i):
            a, b = label[i], label[j]
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            if not len(i):
                break
            hi, lo = np.maximum(a, b), np.minimum(a, b)     # hook every higher root below one lower root
            roots, first = np.unique(hi, return_index=True)
            us.append(nodes[i[first]])
            vs.append(nodes[j[first]])
            label[roots] = lo[first]
            while (up := label[label]).tobytes() != label.tobytes():
                label = up
    none = np.empty(0, np.int64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def _compare(batches, radius: int):
    """Streams rows sorted by tile pair and side; holds one tile pair (at most two tiles) at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    key = None

    def links():
        side = np.concatenate([s for s, _ in held])
        fp = np.concatenate([f for _, f in held])
        left = fp[side == 0]
        u, v = _forest(left, left if key[0] == key[1] else fp[side == 1], radius)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for b in batches:
        lo, hi, side, fp = (b.column(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi", "side", "fp"))
        if not len(lo):
            continue
        cuts = [0, *(np.flatnonzero((lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1), len(lo)]
        for x, y in itertools.pairwise(cuts):
            if (lo[x], hi[x]) != key:
                if held:
                    yield links()
                held, key = [], (lo[x], hi[x])
            held.append((side[x:y], fp[x:y]))
    if held:
        yield links()


def links(fps: DataFrame, radius: int = 2, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (u, v) between distinct fingerprints within ``radius`` bits, reduced to a forest per tile pair."""
    sc = fps.sparkSession.sparkContext
    # The directory of tiles: at most CELLS rows whatever the input.
    cell = sum((F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))) * SIDE ** k for k in range(LANES)),
               F.lit(0))
    split = np.zeros(CELLS, np.int64)
    for c, n in fps.groupBy(cell.alias("c")).count().collect():
        split[c] = -(-n // tile_rows)
    known = sc.broadcast(split)
    dealt = fps.mapInArrow(lambda it: _deal(it, known.value, radius), "lo bigint, hi bigint, side tinyint, fp bigint")
    return (dealt.repartition("lo", "hi").sortWithinPartitions("lo", "hi", "side")
            .mapInArrow(lambda it: _compare(it, radius), "u bigint, v bigint"))


def _classes(docs: DataFrame, shingle: int, radius: int, seed: int, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, fp) of every row, and (fp, component, first) of every fingerprint: its class and its least doc_id."""
    fps = stored(fingerprints(docs, shingle, seed), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    comp = components(links(distinct.select("fp"), radius, tile_rows))
    classes = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
    return fps, stored(classes.withColumn("component", F.coalesce("component", "fp")), "classes")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs`` (doc_id, text).

    component_id is the least doc_id reachable over links of at most ``radius`` differing bits.  Null texts count
    as empty; empty texts share fingerprint zero and link like others.  Repeated rows each return a row.  A row
    without doc_id takes part in linking but names no class; its component_id is null only if no linked row has
    an id.  An empty table gives an empty result.
    """
    fps, named = _classes(docs, shingle, radius, seed, tile_rows)
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = named.select("fp", "component").join(least, "component").select("fp", "component_id")
    return fps.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """``docs`` with one row of every class: that of the least doc_id, rows without one last, then of the least text hash.

    Rows alike in doc_id and text are copies, of which one stays; rows that share a doc_id but not their class each
    stand for their own class.
    """
    fps, named = _classes(docs, shingle, radius, seed, TILE_ROWS)
    # partial minima first: a class of any size is a row per task and fingerprint when it is shuffled
    per_fp = fps.groupBy("fp", F.col("doc_id").isNull().alias("nameless")).agg(F.min("doc_id").alias("doc_id"))
    lead = per_fp.join(named.select("fp", "component"), "fp").groupBy("component").agg(
        F.min("nameless").alias("nameless"), F.min("doc_id").alias("doc_id"))
    of = fps.select("doc_id", "th", "fp").distinct().join(named.select("fp", "component"), "fp")
    same = (of["component"] == lead["component"]) & of["doc_id"].eqNullSafe(lead["doc_id"])
    first = of.join(lead, same).groupBy(of["component"]).agg(F.min(F.struct(of["doc_id"], "th")).alias("one"))
    first = stored(first.select(F.col("one.doc_id").alias("__id"), F.col("one.th").alias("__th")).distinct(), "first")
    d = docs.withColumn("__text", F.xxhash64(F.col("text").cast("binary")))
    one = d.join(first, d["doc_id"].eqNullSafe(first["__id"]) & (d["__text"] == first["__th"]), "left_semi")
    return one.dropDuplicates(["doc_id", "__text"]).drop("__text")
