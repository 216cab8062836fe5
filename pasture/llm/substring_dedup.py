"""Substring dedup by seed and extend.

A window is ``length`` consecutive words.  Every word covered by a window that also starts elsewhere (in any document,
the same one included) is removed, all copies alike.

Seed.  Each window has one anchor: the least hash among its ``seed``-word grams, the last of equal ones (winnowing).
The choice depends on the window's words alone, so equal windows have equal anchors at equal offsets.  Consecutive
windows share an anchor occurrence; together they are its run.  Anchors are counted first, and occurrences of anchors
found once drop out.

Extend.  A run spans the words an anchor occurrence extends to both ways.  Occurrences of one anchor whose whole runs
are equal are repeats from end to end, whatever the number of copies, and one of them stands for all.  Where an anchor
has different runs (a passage begins or ends inside them), the windows of one occurrence per run are compared: those
found in two or more runs are repeats, so the match ends exactly where the words begin to differ.  Nothing is paired:
all comparisons are counts, aggregated before they are shuffled.

Overlapping removed windows join to maximal repeats when they are applied.

Anchors are compared by polynomial hashes of their words, which arrays give cheaply; unlike words can share one.  Runs and
windows, on which removal rests, are compared by XXH64 of their words' bytes, beside the anchor.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasture.llm.scratch import stored

LENGTH, SEED = 35, 13
BLOCK = 1 << 16         # words handled at once, so that a huge text needs bounded arrays
# odd bases of the hashes of words and grams
_B0, _B1 = 0xA0761D6478BD642F, 0x9E3779B97F4A7C15


_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.array([xxhash.xxh64_intdigest(bytes([c])) for c in range(256)], np.uint64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a base modulo 2**64; those of a block are computed once per worker."""
    p = _POWERS.get(base)
    if p is None or len(p) < n:
        p = np.full(n, base, np.uint64)
        p[0] = 1
        p = np.cumprod(p, dtype=np.uint64)
        if n <= 16 * BLOCK:
            _POWERS[base] = p
    return p[:n]


class _Sequences:
    """Hashes of any range of one block: sums of element times base power, shifted back to power zero and mixed."""

    def __init__(self, h: np.ndarray, base: int):
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * _powers(base, len(h)), out=self.sums[1:])
        self.back = _powers(pow(base, -1, 1 << 64), len(h) + 1)

    def of(self, a: np.ndarray, e: np.ndarray) -> np.ndarray:
        x = (self.sums[e] - self.sums[a]) * self.back[a]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets (start, end) and 64-bit hash of every word."""
    raw = np.frombuffer(text, np.uint8)
    edge = np.diff(_GAP[raw].view(np.int8), prepend=np.int8(1), append=np.int8(1))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return start, end, _Sequences(_BYTE[raw], _B0).of(start, end)


def _exact(text: bytes, start: np.ndarray, end: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """XXH64 of the bytes of ``n`` words from word ``first`` on, for each; ``text`` has single spaces between words."""
    a, e = start[first].tolist(), end[first + n - 1].tolist()
    return np.fromiter((xxhash.xxh64_intdigest(text[x:y]) for x, y in zip(a, e)), np.uint64, len(a))


def _segments(texts, length: int):
    """Lists of (row, first word, text) of some BLOCK words together; a longer text comes in overlapping parts."""
    held, n = [], 0
    for row, t in enumerate(texts):
        words = t.split()
        parts = [(0, b" ".join(words))]
        if len(t) > 8 * BLOCK:
            parts = [(at, b" ".join(words[at:at + BLOCK + length - 1])) for at in range(0, len(words), BLOCK)]
        for at, part in parts:
            held.append((row, at, part))
            n += len(part)
            if n >= 6 * BLOCK:
                yield held
                held, n = [], 0
    if held:
        yield held


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    return np.minimum(key[:len(key) - (width - have)], key[width - have:]) if have < width else key


def _runs(texts, length: int, seed: int):
    """Per block: its text and word offsets, and of each run its row, the block's offset in the text, anchor hash, first window
    (in the block), number of windows and anchor offset."""
    place = np.uint64((1 << 24) - 1)            # low bits of a key: the later of equal grams is the lesser one
    for held in _segments(texts, length):
        block = b" ".join(t for _, _, t in held)
        start, end, h = _words(block)
        if len(h) < length:
            continue
        ends = np.cumsum([len(t) + 1 for _, _, t in held])
        until = np.searchsorted(start, ends)                    # words up to the end of each text
        g = np.arange(len(h) - seed + 1)
        anchors = _Sequences(h, _B1).of(g, g + seed)
        least = _least((anchors & ~place) | (place - g.astype(np.uint64)), length - seed + 1)
        pos = (place - (least & place)).astype(np.int64)
        seg = np.repeat(np.arange(len(held)), np.diff(until, prepend=0))[:len(pos)]
        whole = np.arange(len(pos)) + length <= until[seg]      # windows inside one text
        new = np.ones(len(pos), bool)
        new[1:] = (pos[1:] != pos[:-1]) | (seg[1:] != seg[:-1]) | (whole[1:] != whole[:-1])
        bounds = np.flatnonzero(new)
        many = np.diff(bounds, append=len(pos))[whole[bounds]]
        first = bounds[whole[bounds]]
        at = np.array([a for _, a, _ in held]) - np.concatenate([[0], until[:-1]])
        rows = np.array([r for r, _, _ in held])
        yield (block, start, end), rows[seg[first]], at[seg[first]], anchors[pos[first]], first, many, pos[first] - first


_OCCURRENCE = "anchor bigint, run bigint, did bigint, tid bigint, a int, m int"


def _occurrences(batches, length: int, seed: int, only_anchor: bool):
    for b in batches:
        did, tid = (b.column(c).to_numpy(zero_copy_only=False) for c in ("did", "tid"))
        for block, row, at, anchor, first, many, off in _runs(b.column("text").to_pylist(), length, seed):
            cols = [pa.array(anchor.view(np.int64))]
            if not only_anchor:
                run = _exact(*block, first, many + length - 1)
                run += (off * 64 + many).astype(np.uint64) * np.uint64(_B1)
                cols += [pa.array(run.view(np.int64)), pa.array(did[row]), pa.array(tid[row]),
                         pa.array((first + at).astype(np.int32)), pa.array(many.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, ["anchor", "run", "did", "tid", "a", "m"][:len(cols)])


def _windows(batches, length: int):
    """The window hashes of the runs listed for each document: (anchor, window, did, tid, s, single)."""
    for b in batches:
        rows = {k: [] for k in ("anchor", "window", "did", "tid", "s", "single")}
        for did, tid, text, runs in zip(*(b.column(c).to_pylist() for c in ("did", "tid", "text", "runs"))):
            words = text.split()
            for r in runs:
                run = b" ".join(words[r["a"]:r["a"] + r["m"] + length - 1])
                s = np.arange(r["m"])
                rows["window"].append(_exact(run, *_words(run)[:2], s, np.full(r["m"], length)).view(np.int64))
                rows["s"].append((s + r["a"]).astype(np.int32))
                for k, v in (("anchor", r["anchor"]), ("did", did), ("tid", tid)):
                    rows[k].append(np.full(r["m"], v, np.int64))
                rows["single"].append(np.full(r["m"], r["single"], bool))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(v) if v else [], t) for v, t in zip(
                rows.values(), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()))], list(rows))


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts under the key (did, tid): rows with the same key have the same text, so they share their repeats."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("bigint")
    return docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(0)).alias("did"),
                       F.xxhash64(doc, text).alias("tid"), text.cast("binary").alias("text"))


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Word ranges [a, e) made of repeated windows: (did, tid, a, e), under the keys of ``_keyed``."""
    keyed = _keyed(docs).select("did", "tid", "text")
    seeds = keyed.mapInArrow(lambda it: _occurrences(it, length, seed, True), "anchor bigint")
    again = stored(seeds.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    found = keyed.mapInArrow(lambda it: _occurrences(it, length, seed, False), _OCCURRENCE)
    found = stored(found.join(again, "anchor", "left_semi"), "occurrences")
    runs = stored(found.groupBy("anchor", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("did", "tid", "a", "m")).alias("one")), "runs")
    # repeats from end to end
    whole = found.join(runs.where("n > 1").select("anchor", "run"), ["anchor", "run"], "left_semi")
    # runs that differ: window by window
    mixed = stored(runs.groupBy("anchor").count().where("count > 1").select("anchor"), "mixed")
    listed = runs.join(mixed, "anchor", "left_semi").select("anchor", "one.*", (F.col("n") == 1).alias("single"))
    per_doc = listed.groupBy("did", "tid").agg(F.collect_list(F.struct("anchor", "a", "m", "single")).alias("runs"))
    near = keyed.join(per_doc, ["did", "tid"]).dropDuplicates(["did", "tid"]).mapInArrow(
        lambda it: _windows(it, length), "anchor bigint, window bigint, did bigint, tid bigint, s int, single boolean")
    near = stored(near, "windows")
    shared = stored(near.groupBy("anchor", "window").count().where("count > 1").select("anchor", "window"), "shared")
    part = near.where("single").join(shared, ["anchor", "window"], "left_semi")
    return (whole.select("did", "tid", "a", (F.col("a") + F.col("m") + length - 1).alias("e"))
            .union(part.select("did", "tid", F.col("s").alias("a"), (F.col("s") + length).alias("e"))))


def _apply(batches):
    for b in batches:
        n, gone, sha, kept = [], [], [], []
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
            words = text.split()
            total = len(words)
            if spans:
                edge = np.zeros(total + 1, np.int32)
                np.add.at(edge, [s["a"] for s in spans], 1)
                np.add.at(edge, [s["e"] for s in spans], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
            left = b" ".join(words)
            n.append(total)
            gone.append(total - len(words))
            sha.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()),
                pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) per row of ``docs`` (doc_id, text).

    ``kept``: the words left, joined by single spaces (UTF-8 bytes).  Null texts have no words.  Rows repeated in the
    table are copies of each other, so their windows are removed in all of them; a text shorter than ``length`` words
    is never touched.  Rows without doc_id are handled like others.
    """
    spans = stored(repeats(docs, length, seed), "repeats")
    per_doc = spans.groupBy("did", "tid").agg(F.collect_list(F.struct("a", "e")).alias("spans"))
    marked = _keyed(docs).join(per_doc, ["did", "tid"], "left").select("doc_id", "text", "spans")
    return marked.mapInArrow(_apply, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept binary")


def oracle_sql(length: int = LENGTH) -> str:
    """DuckDB SQL for ``remove_repeats`` without its ``kept`` column: every window of every text, counted."""
    return rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT rid, i, array_to_string(ws[i:i + {length - 1}], ' ') AS win
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - {length - 2})) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY win) AS c FROM s) WHERE c > 1),
gone AS (SELECT DISTINCT rid, i + k AS i FROM r, (SELECT unnest(range({length})) AS k)),
word AS (SELECT rid, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM w),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (rid)
"""
