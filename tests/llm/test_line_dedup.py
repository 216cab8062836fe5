"""Line dedup against plain Python."""
import hashlib
import random
import re
import string
from collections import Counter

import pytest

from pasture.llm import line_dedup as L

SCHEMA = "doc_id bigint, text string, t1 string, key string, first int, row int, pos int"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def key(line):
    return re.sub(r"^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$", "", line).translate(LOWER)


def brute(rows, min_docs):
    split = [(d, (t or "").split("\n")) for d, t in rows]
    seen = Counter(k for _, ls in split for k in {key(x) for x in ls} if k)
    out = []
    for d, ls in split:
        left = [x for x in ls if seen[key(x)] < min_docs]
        out.append((d, len(ls), len(ls) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


def make(n=120):
    rnd = random.Random(3)
    pool = [f"line {i} here" for i in range(40)] + ["Ünïcode ÉTÉ", "  Line 3 HERE\t", "x\x0b", "\x0c", "  ", "", "é", "É", "\x1c"]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.choice([0, 1, 2, 5, 70])))) for i in range(n)]
    rows += [(None, None), (None, ""), (7, "\n\n"), (7, "line 1 here"), (7, "line 1 here"), (None, rows[3][1]), rows[3],
             (900, "only\nhere\n"), (901, "line 2 here\n" * 30_000), (902, "w " * 100_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "a", "b", 1, 2, 3) for d, t in rows], SCHEMA)


@pytest.mark.parametrize("min_docs,share", [(10, 2000), (1, 2000), (10, 3), (12, 1)])
def test_matches_brute_force(spark, monkeypatch, min_docs, share):
    monkeypatch.setattr(L, "_share", lambda total: share)           # small shares: keys split over many ranges
    rows = make()
    got = L.digests(frame(spark, rows).repartition(5), min_docs).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, min_docs)


def test_share_bounds_the_splits():
    for total in (0, 10**6, 10**12):
        assert total / L._share(total) <= max(L.HOT + 1, total / L.LEAST_SHARE)


@pytest.mark.parametrize("share", [2000, 2])
def test_keep_first_keeps_the_first_occurrence(spark, monkeypatch, share):
    monkeypatch.setattr(L, "_share", lambda total: share)
    rows = [(3, "b\nA\na"), (1, "a\nc\nA"), (2, "C\nb\nz"), (None, "z\nq"), (4, None)]
    got = {r.doc_id: (r.n_dropped, r.kept) for r in L.without_common_lines(frame(spark, rows), 2, "first").collect()}
    assert got == {None: (0, "z\nq"), 1: (1, "a\nc"), 2: (2, "b"), 3: (3, ""), 4: (0, "")}


def test_bitmaps_are_runs(spark):
    rows = [(i, "same\n" + "\n".join(f"own {i} {k}" for k in range(200)) + "\nsame\nlast" + str(i)) for i in range(4)]
    got = L.line_bitmaps(frame(spark, rows), 3).collect()
    assert len(got) == 4 and all(r.n_dropped == 2 and r.tail == 202 and [tuple(x) for x in r.kept_runs] == [(1, 200)] for r in got)


def test_empty_table_and_bad_mode(spark):
    d = frame(spark, make(9)).limit(0)
    assert L.digests(d, 10).collect() == [] and L.line_bitmaps(d, 10).collect() == []
    with pytest.raises(ValueError):
        L.line_bitmaps(d, 10, "last")


def test_plan_has_no_python_and_one_range_exchange(spark):
    d = frame(spark, make(30))
    plan = L.digests(d, 10)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    window = plan[plan.index("Window ["):]
    assert window.index("rangepartitioning") < (window.index("hashpartitioning") if "hashpartitioning" in window else len(window))
