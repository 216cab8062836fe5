"""Toxicity: held-out accuracy, held-out labels unread, odd inputs."""
import random
import zlib

import numpy as np

from pasture.llm import toxicity_kn as T

DOCS = "doc_id long, text string, lang string, toxic string, g string"
LABELS = "doc_id long, quality int, toxic int"


def make(n=900):
    rnd = random.Random(3)
    parts = ["an", "er", "th", "in", "ou", "st", "ble", "tion", "he"]
    vocab = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 5))) for _ in range(1500)]
    bad = ["scumbag", "vilest", "moronic"]
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([5, 40, 200]))]
        toxic = rnd.random() < 0.25
        if toxic:
            for _ in range(1 + len(words) // 40):
                words[rnd.randrange(len(words))] = rnd.choice(bad) + rnd.choice(["", "s", "ly", "!"])
        docs.append((i, " ".join(words), "en", "1", "g"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_labels(spark):
    docs, labels = make()
    d, flip = spark.createDataFrame(docs, DOCS), lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    got = T.score(d, T.fit(d, spark.createDataFrame(labels, LABELS))).collect()
    truth = {i: t for i, _, t in labels}
    assert len(got) == len(docs) and all(r.held_out == flip(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    test = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in test]) > 0.95
    # held-out labels change nothing
    wrong = [(i, q, 1 - t if flip(i) else t) for i, q, t in labels]
    again = T.score(d, T.fit(d, spark.createDataFrame(wrong, LABELS))).collect()
    assert {r.doc_id: round(r.score, 6) for r in got} == {r.doc_id: round(r.score, 6) for r in again}


def test_odd_rows(spark):
    docs, labels = make(300)
    odd = [(5000, None, None, None, None), (5001, "", "", "", ""), (5002, " \n.,", "", "", ""), (None, "scumbag", "", "", ""), (5003, "x" * 200_000, "", "", ""),
           (5004, "word " * 60_000, "", "", ""), docs[0], docs[0], (5005, "^$ ^ \U0001F600 中文", "", "", "")]
    odd_labels = [(None, 1, 1), (1, 1, None), (2, 1, 1), (2, 1, 0), (99_999, 0, 1), (3, 1, 2), (4, 1, -1)]
    d = spark.createDataFrame(docs + odd, DOCS)
    got = T.score(d, T.fit(d, spark.createDataFrame(labels + odd_labels, LABELS), sample=200)).collect()
    assert len(got) == len(docs) + len(odd)
    by = {r.doc_id: r for r in got}
    assert by[5000].score == by[5001].score == by[5002].score and not by[None].held_out
    assert len({r.score for r in got if r.doc_id == 0}) == 1


def test_no_labels_or_no_rows(spark):
    docs, labels = make(40)
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = T.score(d, T.fit(d, lab.limit(0))).collect()
    assert len(got) == 40 and not any(r.predicted for r in got)
    assert T.score(d.limit(0), T.fit(d.limit(0), lab)).collect() == []


def test_ratio_of_a_word_is_the_sum_over_its_characters(spark):
    """The array form against the recursion it stands for, with exact tables."""
    docs, labels = make(200)
    d = spark.createDataFrame(docs, DOCS)
    m = T.fit(d, spark.createDataFrame(labels, LABELS))
    t, slot = m.tables, lambda g: int(T._slots(T._sums(T._points(g), len(g))[-1:], len(g))[0]) if g else 0

    def mixed(n, total, kinds, low):
        return min((max(n - T.DISCOUNT, 0) + T.DISCOUNT * kinds * low) / total, 1) if total > 0 else low

    for w in ["scumbag", "an", "unseen", "ä"]:
        want = 0.0
        for g in T._grams(w):
            p = T.FLOOR
            for o in range(1, T.ORDER):
                own, head = g[-o:], g[-o:-1]
                p = mixed(t[f"c{o}"][slot(own)], t[f"s{o}"][slot(head)], t[f"f{o}"][slot(head)], p)
            a, b = (mixed(t[f"n{c}"][slot(g)], t[f"h{c}"][slot(g[:-1])], t[f"t{c}"][slot(g[:-1])], p) for c in (0, 1))
            want += np.log(max(b, 1e-12)) - np.log(max(a, 1e-12))
        assert abs(m.ratios([w])[0] - want) < 1e-4


def test_counts_are_exact_and_of_all_labels(spark):
    """More characters than any fixed table holds; class counts do not depend on the size of the curve's sample."""
    chars = [chr(c) for c in range(0x4E00, 0x9FA0)]
    docs = [(i, " ".join(chars[k] + chars[-k] for k in range(i, len(chars), 40)) + " scumbag", "", "", "") for i in range(40)]
    labels = [(i, 1, i % 2) for i in range(40)]
    d = spark.createDataFrame(docs, DOCS)
    m = T.fit(d, spark.createDataFrame(labels, LABELS), sample=5)
    grams = {g for _, t, *_ in docs for w in T.words(t.encode()) for g in T._grams(w)}
    for o in range(T.ORDER - 1, 0, -1):
        count = {}
        for g in grams:
            count[g[1:]] = count.get(g[1:], 0) + 1
        key = T._slots(T._sums(T._points("".join(count)), o)[o - 1::o], o)
        assert np.array_equal(m.tables[f"c{o}"][key], list(count.values()))
        grams = set(count)
    top = T._slots(T._sums(T._points("mbag$"), 5)[-1:], 5)
    used = [t for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 in (1, 2, 3)]
    assert [m.tables["n0"][top][0], m.tables["n1"][top][0]] == [used.count(0), used.count(1)]


def test_labels_sent_or_shuffled_give_the_same(spark, monkeypatch):
    docs, labels = make(300)
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels + [(5, 1, 2), (6, 1, -1)], LABELS)
    sent = {r.doc_id: round(r.score, 9) for r in T.score(d, T.fit(d, lab)).collect()}
    monkeypatch.setattr(T, "SENT_BYTES", 0)
    assert sent == {r.doc_id: round(r.score, 9) for r in T.score(d, T.fit(d, lab)).collect()}


def test_score_of_a_document_is_its_windows_through_the_curve(spark):
    """Whole documents rebuilt in plain Python: mean ratio, best windows of 1, 8 and 32 words, length, curve."""
    docs, labels = make(250)
    d = spark.createDataFrame(docs, DOCS)
    m = T.fit(d, spark.createDataFrame(labels, LABELS))
    got = {r.doc_id: r.score for r in T.score(d, m).collect()}
    for i, text, *_ in docs[:60]:
        ws = T.words(text.encode())
        r = [float(m.ratios([w])[0]) for w in ws]
        best = [max(sum(r[a:a + min(k, len(r))]) for a in range(len(r) - min(k, len(r)) + 1)) / min(k, len(r)) for k in T.WINDOWS]
        x = [sum(r) / len(r), *best, np.log1p(len(ws))]
        z = [(v - mu) / sd for v, mu, sd in zip(x, m.mean, m.scale)] + [1.0]
        want = 1 / (1 + np.exp(-max(-40, min(40, sum(a * b for a, b in zip(z, m.weights))))))
        assert abs(got[i] - want) < 1e-6
