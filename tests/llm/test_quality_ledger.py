"""Quality ledger against plain Python."""
import re
from collections import Counter

from pasture.llm import quality_ledger as Q

SCHEMA = "doc_id bigint, text string, words string, ledger string, t string, row int, fail_bits int"


def measure(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    rep = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in text), len(lines), len(lines) - len(set(lines)), len(rep))


TEXTS = [None, "", " \n\t\x0b", "one", "a b c a b c", "x x x x x x", "é" * 40, "😀 #tag $5 <b>|", "l1\nl1\n\n l1\nl1",
         " ".join(f"w{i}" for i in range(60)), " ".join(["same old words"] * 30), "a\x1cb c", "y " * 60_000,
         "\n".join(["a line that comes again"] * 12), " ".join(["##$$%%&&"] * 70), " ".join("abcdefghijklmnopq" + str(i) for i in range(60))]


def frame(spark, texts):
    return spark.createDataFrame([(i % 14, t, "a", "b", "c", 1, 2) for i, t in enumerate(texts)], SCHEMA)


def test_measures_and_verdicts(spark):
    got = Q.verdicts(Q.ledger(frame(spark, TEXTS))).collect()
    want = sorted((i % 14, *measure(t)) for i, t in enumerate(TEXTS))
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == base and not (base and r.kept) and r.kept == (r.fail_bits == 0)


def test_keep_good_keeps_columns_and_rows(spark):
    d = frame(spark, TEXTS)
    kept = Q.keep_good(d)
    assert kept.columns == d.columns
    assert [r.text for r in kept.collect()] == [TEXTS[9]]
    assert Q.keep_good(d.limit(0)).collect() == [] and Q.ledger(d.limit(0)).collect() == []


def test_policies_and_ablations_read_bits_only(spark):
    book = Q.ledger(frame(spark, TEXTS)).cache()
    rows = book.collect()
    for policy in Q.POLICIES:
        m = Q.mask(policy)
        want = {r: (sum(bool(x.fail_bits & Q.BIT[r]) for x in rows), sum(x.fail_bits & m == Q.BIT[r] for x in rows)) for r in Q.POLICIES[policy]}
        assert {r.rule: (r.n_failed, r.n_only) for r in Q.ablations(book, policy).collect()} == want
    assert {r.n_failed for r in Q.ablations(book.limit(0)).collect()} == {0}
    book.unpersist()


def test_no_python_on_the_executors(spark):
    plan = Q.verdicts(Q.ledger(frame(spark, TEXTS)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Exchange"))
