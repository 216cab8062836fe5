"""SimHash near-dedup against a quadratic brute force."""
import random

import numpy as np
import xxhash

from pasture.llm import simhash_dedup as S

SCHEMA = "doc_id bigint, text string, fp string, component_id string, lo int"


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    ids = [r[0] for r in rows]
    fps = [brute_fp(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, d in zip(group, ids):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return sorted(((d, f"{f:016x}", least.get(g)) for d, f, g in zip(ids, fps, group)), key=str)


def make(n=160):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["Ärger", "ÉTÉ", "Äb"]
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.4:
            words = (rnd.choice(rows)[1] or "").split()
            if words:
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
            text = " ".join(words)
        else:
            text = rnd.choice([" ", "\n", "\t "]).join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 2, 3, 9, 80])))
        rows.append((i, text))
    rows += [(None, rows[7][1]), (900, None), (901, ""), (902, " \x0b"), (903, "ONE two"), (904, "one TWO"), rows[3], rows[3],
             (905, "x " * 150_000), (None, "alone and without any id at all")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], SCHEMA)


def test_matches_brute_force_with_small_tiles(spark):
    rows = make()
    got = S.near_duplicates(frame(spark, rows), tile_rows=3).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert S.near_duplicates(frame(spark, []).limit(0)).collect() == []
    assert S.keep_one(frame(spark, []).limit(0)).collect() == []


def test_keep_one_row_of_each_class(spark):
    rows = make()
    kept = S.keep_one(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "component_id", "lo"]
    ids = [r.doc_id for r in kept.collect()]
    classes = {c for _, _, c in brute(rows) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(classes)
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["alone and without any id at all"]


def test_keep_one_of_repeated_and_missing_ids(spark):
    """Rows are chosen per class: rows that share an id but nothing else all stay, copies without an id go."""
    texts = [" ".join(f"{k}{i}" for i in range(40)) for k in "abcd"]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (None, texts[2]), (None, texts[2]), (None, texts[0]), (9, texts[1]), (None, texts[3])]
    got = sorted(((r.doc_id, r.text) for r in S.keep_one(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3])], key=str)


def test_forest_reaches_all_links_and_stays_small():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 2**62, 5)
    fps = np.unique(np.concatenate([b ^ (1 << rnd.integers(0, 60, 80)) for b in base]))
    u, v = S._forest(fps, fps, 2)
    assert len(u) == len(fps) - 5           # five stars of neighbours: a tree each
    assert all((int(a) ^ int(b)).bit_count() <= 2 for a, b in zip(u, v))
