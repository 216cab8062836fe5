"""Substring dedup against counting every window."""
import hashlib
import random
import re
from collections import Counter

from pasture.llm import substring_dedup as S


def brute(rows, length):
    split = [re.findall(r"[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for (d, _), w in zip(rows, split):
        gone = {j for i in range(len(w) - length + 1) if seen[tuple(w[i:i + length])] > 1 for j in range(i, i + length)}
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def make():
    rnd = random.Random(11)
    vocab = [f"v{i}" for i in range(400)] + ["é", "Ω"]
    fresh = lambda n: [rnd.choice(vocab) for _ in range(n)]
    passages = [fresh(n) for n in (20, 35, 36, 50, 90)]
    rows = []
    for i in range(120):
        words = fresh(rnd.choice([0, 3, 34, 35, 60, 120]))
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(passages)
            a = rnd.randrange(6) if rnd.random() < 0.4 else 0
            k = rnd.randrange(len(words) + 1)
            words[k:k] = p[a:len(p) - (rnd.randrange(6) if rnd.random() < 0.4 else 0)]
        rows.append((i, rnd.choice([" ", "\n", " \t"]).join(words)))
    rows += [(200, "a " * 90), (201, "a b " * 50), (202, None), (203, ""), rows[5], (5, "other text under the id of five " * 9),
             (None, rows[8][1]), (None, " ".join(fresh(70))), (204, " ".join(fresh(300) * 2))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "s") for d, t in rows], "doc_id long, text string, did int, spans string")


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_matches_window_counts(spark):
    rows = make()
    assert result(S.remove_repeats(frame(spark, rows))) == brute(rows, 35)


def test_other_lengths(spark):
    rows = make()[:60]
    assert result(S.remove_repeats(frame(spark, rows), length=20, seed=6)) == brute(rows, 20)


def test_long_texts_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 64)
    rows = make()
    rows += [(300, " ".join(t or "" for _, t in rows[:40]))]
    for only in (True, False):
        want = brute(rows, 35)
        texts = [(t or "").encode() for _, t in rows]
        runs = sum(int(many.sum()) for _, _, _, _, _, many, _ in S._runs(texts, 35, 13))
        assert runs == sum(max(0, n - 34) for _, n, _, _ in want), only


def test_empty(spark):
    assert S.remove_repeats(frame(spark, []).limit(0)).collect() == []


def test_unlike_words_with_one_polynomial_hash(spark):
    """The Thue-Morse word and its complement agree in every polynomial hash modulo 2**64; nothing repeats here."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    b = a.translate(str.maketrans("ab", "ba"))
    assert a != b and S._words(a.encode())[2] == S._words(b.encode())[2]
    same = [f"w{i}" for i in range(34)]
    rows = [(1, " ".join([*same, a])), (2, " ".join([*same, b])), (3, " ".join([*same, a, "end"] + same)), (4, f"{b} " * 60)]
    got = result(S.remove_repeats(frame(spark, rows)))
    assert got == brute(rows, 35) and got[1][2] == 0
