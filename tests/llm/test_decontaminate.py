"""Benchmark decontamination against comparing every window of every item's size."""
import random
from collections import Counter

import regex

from pasture.llm import decontaminate as D

DOCS = "doc_id long, text string, item_id long, words string, size int"
ITEMS = "item_id long, text string, fp string"


def split(t):
    return regex.findall(r"[\p{L}\p{M}\p{N}]+", (t or "").lower())


def grams(w):
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(docs, items, least=0.8):
    out = {}
    for d, t in docs:
        w = split(t)
        for i, x in items:
            b = split(x)
            if len(b) < 5:
                continue
            best = max((sum((a & grams(b)).values()) / max(1, sum((a | grams(b)).values()))
                        for s in range(max(1, len(w) - len(b) + 1)) for a in [grams(w[s:s + len(b)])]), default=0)
            if best >= least:
                out[d, i] = max(out.get((d, i), 0), round(best, 6))
    return out


def make():
    rnd = random.Random(8)
    vocab = [f"q{i}" for i in range(300)] + ["Éa", "über"]
    fresh = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(fresh(n))) for i, n in enumerate([15, 16, 20, 33, 45, 59, 59, 120])]
    items += [(20, "too few words"), (21, None), (22, "ha " * 12), (23, items[2][1])]
    docs = []
    for k in range(90):
        w = fresh(rnd.choice([0, 4, 10, 60, 150]))
        if rnd.random() < 0.7:
            p = split(rnd.choice(items[:8])[1])
            for _ in range(rnd.randrange(3)):
                j = rnd.randrange(len(p))
                p[j:j + rnd.randrange(2)] = rnd.choice([[], ["changed"], ["an", "insert"]])
            w[len(w) // 2:len(w) // 2] = p
        sep = rnd.choice([" ", "!! ", "\n"])
        docs.append((k, sep.join(x.upper() if k % 3 == 0 else x for x in w)))
    docs += [(200, None), (201, ""), (202, "ha " * 30), (None, items[4][1]), docs[3], docs[3], (203, " ".join(split(items[7][1])[:-8])),
             (204, "x " * 40_000 + items[5][1])]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, 1, "w", 2) for d, t in docs], DOCS), spark.createDataFrame([(i, t, "f") for i, t in items], ITEMS))


def found(df):
    return {(r.doc_id, r.item_id): r.similarity for r in df.collect()}


def test_matches_brute_force(spark):
    docs, items = make()
    want = brute(docs[:-1], items) | {(204, 5): 1.0}
    got = D.contaminated(*frames(spark, docs, items))
    assert found(got) == want and got.count() == len(want)


def test_shuffled_tables_give_the_same(spark, monkeypatch):
    docs, items = make()
    want = found(D.contaminated(*frames(spark, docs, items)))
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert found(D.contaminated(*frames(spark, docs, items))) == want


def test_stage_drops_only_contaminated_rows(spark):
    docs, items = make()
    bad = {d for d, _ in brute(docs[:-1], items)} | {204}
    d, b = frames(spark, docs, items)
    kept = D.without_benchmark(d, b)
    assert kept.columns == d.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((k for k, _ in docs if k not in bad), key=str)


def test_empty_tables(spark):
    docs, items = make()
    d, b = frames(spark, docs[:20], items)
    assert D.contaminated(d.limit(0), b).collect() == [] and D.contaminated(d, b.limit(0)).collect() == []
    assert D.without_benchmark(d, b.limit(0)).count() == 20


def test_truncated_passages(spark):
    """Passages without as many words at head, tail or both as a similarity of 0.8 allows, against brute force."""
    rnd = random.Random(12)
    vocab = [f"w{i}" for i in range(4000)]
    fresh = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(fresh(n))) for i, n in enumerate([*range(22, 70, 3), 90])]
    items.append((50, "ha " * 30))
    docs, want = [(900, "ha " * 27 + "so it goes on"), (901, "ha " * 50)], {}
    want |= brute(docs, items[-1:])
    for i, t in items[:-1]:
        w = split(t)
        lost = (len(w) - 4) // 9
        for a, b in ((lost, 0), (0, lost), (lost // 2, lost - lost // 2)):
            for _ in range(5):
                docs.append((len(docs), " ".join(fresh(10) + w[a:len(w) - b] + fresh(10))))
                want |= brute(docs[-1:], [(i, t)])
    assert len(want) > 200 and found(D.contaminated(*frames(spark, docs, items))) == want


def test_most_pairs_come_through_the_index(spark):
    """Whole and edited passages are found by fingerprint; what lies beyond the radius is the smaller part."""
    docs, items = make()
    pairs = D.matches(*frames(spark, docs, items)).collect()
    assert sum(p.indexed for p in pairs) >= 0.9 * len(pairs) > 20
    few = D.matches(*frames(spark, docs, items), radius=3).collect()         # a small radius finds as much, by the other way
    assert {(p.doc_id, p.item_id) for p in few} == {(p.doc_id, p.item_id) for p in pairs}
    assert sum(p.indexed for p in few) < sum(p.indexed for p in pairs)
