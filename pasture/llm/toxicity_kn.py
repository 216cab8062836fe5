"""Toxicity by class-conditional Kneser-Ney models.

Two character models, one of toxic and one of ordinary texts, predict a word's characters from the four before them.
Their highest order holds class counts; every lower order is shared: Kneser-Ney continuation counts (in how many
different contexts a gram occurs) over the words of all documents.  An expression a class has not seen backs off to the
same shared estimate in both models, so rare expressions count for neither class.

A text is compared by length-normalised log-likelihood ratios: of the whole text per word, and of its best window of 1,
8 and 32 words per word.  A logistic curve turns the four (and the logarithm of the number of words) into a score.

Labelled rows whose crc32(doc_id) modulo 5 is 0 are never read: all rows of remainders 1 to 3 give class counts, and at
most ``SAMPLE`` rows of remainder 4, the least by a hash of their id, the curve.  The shared counts cover all documents.
Every gram has an entry of its own, keyed by 64 bits, so the model that the driver and the tasks hold grows with the
number of different grams (16 bytes for each and table).
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasture.llm.scratch import pick, stored

ORDER = 5
DISCOUNT, FLOOR = 0.75, 2.0 ** -12
WINDOWS = (1, 8, 32)
SAMPLE = 40_000
LABEL_BYTES, SENT_BYTES = 32, 256 << 20                 # of a broadcast label row; of the largest broadcast of labels
CACHE, BLOCK, PART = 300_000, 200_000, 20_000           # words remembered, gathered and looked up at once
PAD, END = "^", "$"                                     # neither is a word character
_WORD = re.compile(r"\w+")
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def words(text: bytes | None) -> list[str]:
    return _WORD.findall((text or b"").decode("utf-8", "replace").lower())


def _grams(word: str) -> list[str]:
    s = PAD * (ORDER - 1) + word + END
    return [s[i:i + ORDER] for i in range(len(word) + 1)]


def _slots(sums: np.ndarray, order: int) -> np.ndarray:
    """Table keys for gram sums of one order."""
    return sums.view(np.int64) if order else np.zeros(len(sums), np.int64)


def _sums(points: np.ndarray, order: int) -> np.ndarray:
    """For every position, the sum over the ``order`` characters that end there; the first ones are not whole."""
    out = np.zeros(len(points), np.uint64)
    for j in range(order):
        out[j:] += points[:len(points) - j] * _FACTORS[j]
    return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


#: name -> characters of the gram that indexes the table: class counts, class context counts and types, and of the
#: shared orders 1 to 4 the counts, their sum and the number of followers of a context
TABLES = {"n0": 5, "n1": 5, "h0": 4, "h1": 4, "t0": 4, "t1": 4} | {
    f"{k}{o}": o - (k != "c") for o in range(1, ORDER) for k in "csf"}


class _Table:
    """Values by key; zero where a key is missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = np.append(keys[order], 0), np.append(values[order], 0.0)     # the last is never a hit

    def __getitem__(self, key):
        at = np.searchsorted(self.keys[:-1], key)
        return np.where((at < len(self.keys) - 1) & (self.keys[at] == key), self.values[at], 0.0)


@dataclass
class Model:
    """Tables by name, as keys and their values, and the logistic curve: weights of the standardised
    features, the last for one."""

    taken: dict[str, tuple[np.ndarray, np.ndarray]]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @cached_property
    def tables(self) -> dict[str, _Table]:
        """The tables in order of their keys; made where they are used, never sent."""
        return {k: _Table(*self.taken[k]) for k in TABLES}

    def ratios(self, new: list[str]) -> np.ndarray:
        """Log-likelihood ratio, toxic over ordinary, of each word."""
        text = "".join([PAD * (ORDER - 1) + w + END for w in new])
        pts = _points(text)
        at = np.flatnonzero(pts != ord(PAD))
        sums = [_sums(pts, o) for o in range(ORDER + 1)]
        t, p = self.tables, np.full(len(at), FLOOR)

        def mixed(n, total, kinds, low):
            seen = total > 0
            total = np.where(seen, total, 1)
            return np.where(seen, np.minimum((np.maximum(n - DISCOUNT, 0) + DISCOUNT * kinds * low) / total, 1), low)

        for o in range(1, ORDER):
            own, ctx = _slots(sums[o][at], o), _slots(sums[o - 1][at - 1], o - 1)
            p = mixed(t[f"c{o}"][own], t[f"s{o}"][ctx], t[f"f{o}"][ctx], p)
        own, ctx = _slots(sums[ORDER][at], ORDER), _slots(sums[ORDER - 1][at - 1], ORDER - 1)
        a, b = (mixed(t[f"n{c}"][own], t[f"h{c}"][ctx], t[f"t{c}"][ctx], p) for c in (0, 1))
        each = np.log(np.maximum(b, 1e-12)) - np.log(np.maximum(a, 1e-12))
        # summed word by word: a word's ratio does not depend on what it is looked up with
        return np.add.reduceat(each, np.cumsum([0, *(len(w) + 1 for w in new[:-1])]))

    def features(self, texts: list[bytes | None], known: dict[str, float]) -> np.ndarray:
        """A row of features per text; ``known`` remembers word ratios, bounded."""
        split = [words(t) for t in texts]
        out = np.zeros((len(texts), 2 + len(WINDOWS)))
        for at in range(0, len(split), 64):
            part = split[at:at + 64]
            new = list(set(itertools.chain.from_iterable(part)).difference(known))
            if new:
                if len(known) + len(new) > CACHE:
                    known.clear()
                    new = list(set(itertools.chain.from_iterable(part)))
                for k in range(0, len(new), PART):
                    some = new[k:k + PART]
                    known.update(zip(some, self.ratios(some).tolist()))
            for i, ws in enumerate(part, at):
                if ws:
                    r = np.concatenate([[0.0], np.cumsum(np.fromiter(map(known.__getitem__, ws), np.float64, len(ws)))])
                    wide = [min(k, len(ws)) for k in WINDOWS]
                    out[i] = [r[-1] / len(ws), *((r[k:] - r[:-k]).max() / k for k in wide), math.log1p(len(ws))]
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = np.column_stack([(features - self.mean) / self.scale, np.ones(len(features))])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -40, 40)))


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _all_grams(batches):
    """The different grams of the words of each block of documents."""
    seen: set[str] = set()
    for last, b in itertools.chain(((False, b) for b in batches), [(True, None)]):
        if b is not None:
            for t in b.column("text").to_pylist():
                seen.update(words(t))
        if seen and (last or len(seen) > BLOCK):
            grams = list({g for w in seen for g in _grams(w)})
            seen = set()
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string())], ["g"])


def _class_grams(batches):
    """Gram counts by class of each block of labelled documents."""
    counts = (Counter(), Counter())
    for last, b in itertools.chain(((False, b) for b in batches), [(True, None)]):
        if b is not None:
            for t, c in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                counts[c].update(words(t))
        if last or sum(map(len, counts)) > BLOCK:
            both = (Counter(), Counter())
            for c in (0, 1):
                for w, n in counts[c].items():
                    for g in _grams(w):
                        both[c][g] += n
                counts[c].clear()
            grams = list(both[0].keys() | both[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.string()), pa.array([both[0][g] for g in grams], pa.int64()),
                 pa.array([both[1][g] for g in grams], pa.int64())], ["g", "n0", "n1"])


def _slotted(batches):
    """(table, gram, value) to (table, key, value)."""
    for b in batches:
        kind = np.array(b.column("kind").to_pylist(), object)
        grams = b.column("g").to_pylist()
        slot = np.zeros(len(kind), np.int64)
        order = np.array([TABLES[k] for k in kind], np.int64)
        for o in np.unique(order):
            at = np.flatnonzero(order == o)
            if o:
                slot[at] = _slots(_sums(_points("".join(grams[i] for i in at)), o)[o - 1::o], o)
        yield pa.RecordBatch.from_arrays([b.column("kind"), pa.array(slot), b.column("v")], ["kind", "slot", "v"])


def _tables(docs: DataFrame, train: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    level = docs.select("text").mapInArrow(_all_grams, "g string").distinct()
    level = stored(level, "grams")
    rows = []

    def add(frame: DataFrame, **values):
        pairs = F.array(*(F.struct(F.lit(k).alias("kind"), v.cast("double").alias("v")) for k, v in values.items()))
        rows.append(frame.select("g", F.explode(pairs).alias("x")).select("x.kind", "g", "x.v").where("v > 0"))

    for o in range(ORDER - 1, 0, -1):
        level = level.groupBy(F.substring("g", 2, o).alias("g")).agg(F.count(F.lit(1)).alias("v"))
        level = stored(level, f"continuations{o}")
        add(level, **{f"c{o}": F.col("v")})
        heads = level.groupBy(F.substring("g", 1, o - 1).alias("g")).agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("f"))
        add(heads, **{f"s{o}": F.col("s"), f"f{o}": F.col("f")})
    top = train.mapInArrow(_class_grams, "g string, n0 bigint, n1 bigint")
    top = stored(top.groupBy("g").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "class_grams")
    add(top, n0=F.col("n0"), n1=F.col("n1"))
    heads = top.groupBy(F.substring("g", 1, ORDER - 1).alias("g")).agg(
        F.sum("n0").alias("h0"), F.sum("n1").alias("h1"), F.count_if(F.col("n0") > 0).alias("t0"), F.count_if(F.col("n1") > 0).alias("t1"))
    add(heads, h0=F.col("h0"), h1=F.col("h1"), t0=F.col("t0"), t1=F.col("t1"))
    every = rows[0]
    for r in rows[1:]:
        every = every.union(r)
    slots = every.mapInArrow(_slotted, "kind string, slot bigint, v double").groupBy("kind", "slot").agg(F.sum("v").alias("v"))
    names = list(TABLES)
    found = stored(slots.select(F.array_position(F.lit(names), F.col("kind")).cast("tinyint").alias("kind"), "slot",
                                "v"), "slots").toArrow()       # one row per gram and table
    kind, slot, value = (found.column(c).to_numpy() for c in ("kind", "slot", "v"))
    return {n: (slot[kind == k], value[kind == k]) for k, n in enumerate(names, 1)}


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression on standardised features, by Newton steps."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Both models and the curve, the latter from ``sample`` rows at most.  Labels that are neither 0 nor 1 or belong to
    held-out ids are never read; an id labelled twice counts as toxic if either row says so."""
    d = pick(docs, doc_id="bigint", text="binary")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = pick(labels, doc_id="bigint", toxic="int").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known.withColumn("part", part), "labels")
    # which rows are read follows from their ids; texts are shuffled only where the labels are too many to send
    counted = known.where("part < 4").select("doc_id", "toxic")
    small = counted.count() * LABEL_BYTES <= SENT_BYTES
    counted = F.broadcast(counted) if small else counted.hint("merge")
    tables = _tables(d, d.where(part.between(1, 3)).join(counted, "doc_id").select("text", "toxic"))
    some = stored(known.where("part = 4").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "curve")
    seen = d.join(F.broadcast(some), "doc_id")        # at most ``sample`` rows of labels
    width = 2 + len(WINDOWS)
    model = Model(tables, np.zeros(width), np.ones(width), np.zeros(width + 1))
    sent = d.sparkSession.sparkContext.broadcast(model)

    def measured(batches):
        m, ratios = sent.value, {}
        for b in batches:
            x = m.features(b.column("text").to_pylist(), ratios)
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), b.column("toxic").cast(pa.int32())], names)

    names = [*(f"x{k}" for k in range(width)), "toxic"]
    check = seen.select("text", "toxic").mapInArrow(
        measured, ", ".join(f"{n} double" for n in names[:-1]) + ", toxic int").toArrow()
    sent.destroy()
    x = np.column_stack([check.column(n).to_numpy() for n in names[:-1]])
    y = check.column("toxic").to_numpy().astype(float)
    if len(set(y)) == 2:
        return Model(tables, *_curve(x, y))
    # nothing to calibrate on: the share of toxic rows
    rate = (y.sum() + 0.02) / (len(y) + 1)
    return Model(tables, model.mean, model.scale, np.array([0.0] * width + [math.log(rate / (1 - rate))]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    Null, empty and wordless texts have zero ratios and the score the curve gives those.  A null doc_id is not held
    out.  Repeated rows each return a row.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    d = pick(docs, doc_id="bigint", text="binary")
    d = d.withColumn("held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))

    def run(batches):
        m, ratios = sent.value, {}
        for b in batches:
            s = m.scores(m.features(b.column("text").to_pylist(), ratios))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return d.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
