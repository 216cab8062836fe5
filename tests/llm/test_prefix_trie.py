"""Prefix trie against plain Python."""
import hashlib
import random
import re
import zlib

import pytest

from pasture.llm import prefix_trie as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string, c int, d string, id int, p string, words string, rank int"


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    convs = {}
    for c, t, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, digest(role, text), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(ts)] for c, ts in convs.items()}
    seqs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        seqs[c] = tuple(own.get(base, [])[:h]) + tuple(ts[h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids, leaves, saved = {}, {}, {}
    for s in members:
        if s:
            kids[s[:-1]] = kids.get(s[:-1], 0) + 1
    for s in members:
        w = len(re.findall(r"[^\x20\x09-\x0d]+", s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] = leaves.get(s[:d], 0) + (s not in kids)
            saved[s[:d]] = saved.get(s[:d], 0) + (len(members[s]) - 1) * w
    out = []
    for s, cs in members.items():
        ended = ",".join(str(c) for c in sorted(cs) if len(seqs[c]) == len(s))
        out.append((min(cs), len(s), min(members[s[:-1]]) if s else None, len(cs), kids.get(s, 0), leaves[s], saved[s],
                    hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def make(n=120):
    rnd = random.Random(11)
    rows = []
    for c in [*range(n), 200, 223, 10**12, -1, -20, -41, -(2**63), 2**63 - 1]:
        for t in range(rnd.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, t, rnd.choice(["user", "bot"]) if t else "user", rnd.choice(["hi there", "a", "ö b\tc", "", "long " * 30])))
    rows += [(7, t, "user", "again and") for t in range(40)] + [(27, t, "user", "again and") for t in range(33)]
    rows += [(300, None, None, "nulls"), (300, 2, "r", None), (300, None, "", "nulls"), (300, 5, None, None), (301, 1, "u", "x" * 300_000)]
    rows += [(None, 1, "user", "nobody"), rows[3], rows[3], (302, 1, "us", "er:x"), (303, 1, "use", "r:x")]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", 2, "p", "w", 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("block", [256, 4])
def test_matches_brute_force(spark, block):
    rows = make()
    got = P.trie(frame(spark, rows).repartition(5), 20, block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert P.trie(frame(spark, make(5)).limit(0)).collect() == []


def test_hot_ends_are_pieced_together(spark, monkeypatch):
    rows = [(bytearray(b"a"), c) for c in range(-500, 4000)] + [(bytearray(b"b"), 5)] + [(bytearray(b"c"), c) for c in (9, 10, -3)]
    got = {bytes(r.id): r.ends_sha256 for r in P.ends(spark.createDataFrame(rows, "id binary, c bigint").repartition(7)).collect()}
    want = lambda cs: hashlib.sha256(",".join(map(str, cs)).encode()).hexdigest()
    assert got == {b"a": want(range(-500, 4000)), b"b": want([5]), b"c": want([-3, 9, 10])}


def test_pieces_are_cut_and_joined(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(P, "CHUNK", 3)
    ids = [b"a"] * 10 + [b"b"] * 2
    b = pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(range(12), pa.int64())], ["id", "c"])
    pieces = [r for x in P._pieces([b]) for r in x.to_pylist()]
    assert [p["piece"] for p in pieces] == ["0,1,2", "3,4,5", "6,7,8", "9", "10,11"] and [p["no"] for p in pieces] == list(range(5))


def random_tree(rnd, kind, n):
    parent = [None]
    for i in range(1, n):
        parent.append({"path": i - 1, "star": 0, "mixed": rnd.randrange(max(0, i - 3), i), "bush": rnd.randrange(i),
                       "caterpillar": i - 1 if i % 2 else max(0, i - 2)}[kind])
    return parent


@pytest.mark.parametrize("kind,n,most", [("path", 700, 14), ("star", 300, 3), ("mixed", 400, 20), ("bush", 300, 10), ("caterpillar", 401, 20)])
def test_contraction_takes_few_rounds(spark, monkeypatch, kind, n, most):
    rnd = random.Random(5)
    parent = random_tree(rnd, kind, n)
    depth, kids = [0] * n, [0] * n
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
        kids[parent[i]] += 1
    w = [rnd.randrange(9) for _ in range(n)]
    want = w[:]
    for i in range(n - 1, 0, -1):
        want[parent[i]] += want[i]
    rows = [(i, depth[i], parent[i], None if parent[i] is None else depth[parent[i]], w[i], 1, int(not kids[i])) for i in range(n)]
    rounds, put = [], P.stored
    monkeypatch.setattr(P, "stored", lambda df, name: rounds.append(name) or put(df, name))
    tree = spark.createDataFrame(rows, "c bigint, d bigint, pc bigint, pd bigint, a bigint, b bigint, childless bigint")
    got = {r.c: r.a for r in P.totals(tree).collect()}
    assert got == dict(enumerate(want))
    assert sum(x.startswith("round") for x in rounds) <= most
