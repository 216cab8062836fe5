"""Merkle manifest against plain Python."""
import hashlib
import random
import zlib

import pytest

from pasture.llm import merkle_manifest as M
from pasture.llm.ordering import ranked
from pasture.llm.scratch import stored

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, h string, p int, path string, grp string, rank int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def proofs(hashes, arity):
    """(root, path per position): path of (left, right)."""
    paths = [[] for _ in hashes]
    at = [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        ups, ats = [], []
        for i in range(0, len(hashes), arity):
            run = hashes[i:i + arity]
            for j in range(len(run)):
                for leaf_no in at[i + j]:
                    paths[leaf_no].append(("".join(run[:j]), "".join(run[j + 1:])))
            ups.append(H(*run))
            ats.append(sum(at[i:i + arity], []))
        hashes, at = ups, ats
    return (hashes[0] if hashes else None), paths


def brute(rows, arity=2, every=7):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below, subroots = {}, []
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        sub, paths = proofs([leaf(r) for r in own], arity)
        below[g] = (own, paths)
        subroots.append(sub)
    root, tops = proofs(subroots, arity)
    out = []
    for g, sub, top in zip(names, subroots, tops):
        for r, path in zip(*below[g]):
            path = path + top
            f = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % every == 0 and r[3] is not None:
                f = leaf((*r[:3], r[3] + 1, r[4]))
            for left, right in path:
                f = H(left, f, right)
            out.append((r[0], leaf(r), sub, root, H(*(a + b for a, b in path)), f, f == root))
    return sorted(out, key=str)


def make(n):
    rnd = random.Random(n)
    rows = [(rnd.randrange(-5, 3 * n), rnd.choice(["a", None, "é:"]), rnd.choice(["en"] * 9 + ["de", None, "", "Ω", "zz"]),
             rnd.choice([None, 0, 7, 2**63 - 1]), rnd.choice([None, "", "t:1", "ü" * 50])) for _ in range(n)]
    return rows + [(None, None, None, None, None), (5, "s", "lone", 1, "x" * 200_000), rows[0], rows[0], (None, "s", "en", 1, "x"),
                   (-(2**63), "s", "fr", 1, "x"), (2**63 - 1, "s", "fr", 1, "x"), (3, "s", "fr", 2, "x")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("n,arity,depth", [(200, 2, 10), (200, 2, 2), (61, 3, 2), (40, 2, 1)])
def test_matches_brute_force(spark, n, arity, depth):
    rows = make(n)
    got = M.verified(frame(spark, rows).repartition(6), 7, arity, depth).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, arity)
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_small_groups(spark, n):
    rows = [(i, "s", "en", 1, "t") for i in range(n)]
    got = M.verified(frame(spark, rows), 7, 2, 2).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert M.verified(frame(spark, make(3)).limit(0)).collect() == []


def test_any_change_is_found(spark):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(30)]
    before = M.manifest(frame(spark, rows)).first().root
    rows[17] = (17, "s", "en", 17, "text 17 ")
    assert M.manifest(frame(spark, rows)).first().root != before


def test_proofs_join_nothing(spark):
    d = frame(spark, make(40))
    tiers = M._tiers(ranked(stored(M.leaves(d), "l"), "grp", ["id", "h"], "r").select("grp", "rank", "h", "p"), 2, 2)
    paths = tiers[-1].selectExpr("grp", "block", f"cast(array() as {M._PATH}) as path", "node.h as above")
    plan = M._descend(tiers, paths, 2, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


def test_ranks_over_many_ranges(spark):
    rows = [("a", k % 7) for k in range(300)] + [(None, k) for k in range(50)] + [(f"g{k}", 1) for k in range(20)] + [("h", None)] * 90
    df = stored(spark.createDataFrame(rows, "g string, k int"), "rows")
    got = ranked(df, "g", ["k"], "test").collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append((r["rank"], -1 if r.k is None else r.k))
    assert len(got) == len(rows)
    for pairs in by.values():
        assert sorted(x for x, _ in pairs) == list(range(len(pairs)))
        assert [k for _, k in sorted(pairs)] == sorted(k for _, k in pairs)
