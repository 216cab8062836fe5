"""WARC archives: round trip, revisits, chunking, and what the files themselves hold."""
import glob
import gzip
import hashlib

from pasture.llm import warc_chunks as W

SCHEMA = "page_id long, url string, html string, payload string, first int"


def make():
    big = "".join(f"<p>{i} é</p>" for i in range(60_000))
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(
        ["", None, "short", "short", "x" * 99, "x" * 99, "x" * 100, "x" * 100, big, big, "ü" * 50, "ü" * 50, "a\r\n\r\nWARC/1.1\r\n" * 20, "y" * 200])]
    rows += [(6, "http://again", "x" * 100), (13, "http://other", "x" * 100), (None, None, "y" * 200), (None, "u\r\nX: y", "z" * 150), (-4, "u", "z" * 150)]
    return [(*r, "c", 1) for r in rows]


def brute(rows):
    first = {}
    for i, _, h, *_ in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        to = first.get(h or "") if len(b) >= 100 else None
        again = to is not None and to != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmpdir_fresh):
    rows = make()
    got = W.round_trip(spark.createDataFrame(rows, SCHEMA), tmpdir_fresh + "/w").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    raw = b"".join(gzip.open(p).read() for p in glob.glob(tmpdir_fresh + "/w/*.warc.gz"))
    assert raw.count(b"WARC-Type: revisit\r\n") == sum(r[3] == "revisit" for r in brute(rows))
    assert raw.count("<p>59999 é</p>".encode()) == 1           # equal payloads are stored once


def test_chunks_are_bounded_and_carry_digests(spark, tmpdir_fresh):
    html = "".join(chr(48 + i % 70) for i in range(100_000))
    d = spark.createDataFrame([(1, "u", html, "", 0), (2, "v", "tiny", "", 0)], SCHEMA)
    table = W.chunks(W.records(d), 1000)
    assert table.where("length(bytes) > 1000").count() == 0 and table.where("page_id = 1").count() == 100
    back = W.read(W.write(table, tmpdir_fresh + "/w", archive=10_000), 700).where("page_id = 1").orderBy("chunk_no").collect()
    seen = b""
    for r in back:
        seen += bytes(r.bytes)
        assert (r.payload_bytes, r.payload_digest, r.last) == (len(seen), hashlib.sha256(seen).hexdigest(), len(seen) == len(html))
    assert seen.decode() == html and max(len(r.bytes) for r in back) == 700


def test_empty(spark):
    assert W.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []
