"""WARC archives through a chunked record table.

A record travels as rows (record, chunk number, bytes), chunks in order, each at most ``CHUNK`` bytes.  The writer
streams a record's chunks into one gzip member of an archive; the reader streams them out again and carries the length
and the SHA-256 of the payload so far from chunk to chunk, so neither holds a whole record.

Records with equal payloads of at least ``LEAST`` bytes are stored once: the one with the least id is a response, the
others are revisits that refer to it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasture.llm.scratch import new_folder, stored

CHUNK = 1 << 18
LEAST = 100
ARCHIVE = 1 << 30               # bytes after which a task begins another archive
_BLOCK = 1 << 20
_ID = "urn:page:"
_DATE = "2024-01-01T00:00:00Z"


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, n, digest, first) per row of ``pages``; first: the response a revisit refers to."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("payload"))
    base = base.withColumns({"n": F.length("payload").cast("bigint"), "digest": F.sha2("payload", 256)})
    light = stored(base.where(F.col("n") >= least).select("page_id", "digest"), "digests")
    groups = light.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    groups = stored(groups.where("copies > 1").select("digest", "first"), "copies")
    again = (light.join(groups, "digest").where("not (page_id <=> first)").distinct()
             .select(F.col("page_id").alias("__id"), F.col("digest").alias("__digest"), "first"))
    return base.join(again, (F.col("page_id").eqNullSafe(F.col("__id"))) & (F.col("digest") == F.col("__digest")),
                     "left").drop("__id", "__digest")


def chunks(recs: DataFrame, size: int = CHUNK) -> DataFrame:
    """The chunked record table; revisits and empty payloads have one empty chunk."""
    count = F.when(F.col("first").isNotNull(), F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(F.col("n") / size)))
    body = F.when(F.col("first").isNotNull(), F.lit(b"")).otherwise(F.col("payload"))
    # numbers first: each row then takes its own piece, and the pieces of a payload never stand beside it
    numbered = recs.withColumn("body", body).select("*", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("chunk_no"))
    return numbered.select("page_id", "url", "n", "digest", "first", "chunk_no",
                           F.substring("body", F.col("chunk_no") * size + 1, F.lit(size)).alias("bytes"))


def _head(row: dict) -> bytes:
    revisit = row["first"] is not None
    url = "".join(c for c in row["url"] or "" if c not in "\r\n")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <{_ID}{'' if row['page_id'] is None else row['page_id']}>", f"WARC-Date: {_DATE}",
             f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{row['digest']}",
             f"X-Payload-Length: {row['n']}", "Content-Type: text/html; charset=utf-8"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{_ID}{row['first']}>"]
    lines += [f"Content-Length: {0 if revisit else row['n']}", "", ""]
    return "\r\n".join(lines).encode()


def _write(batches, folder: str, archive: int):
    """Writes a task's chunk rows to archives of its own; names are unique, so a repeated or speculative attempt
    never touches another's, and only the archives of the attempt that committed are listed."""
    out = gz = None
    path, done, n = "", [], 0
    where, at = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    for b in batches:
        for row in b.to_pylist():
            if row["chunk_no"] == 0:
                if gz:
                    out.write(gz.compress(b"\r\n\r\n") + gz.flush())
                if out and out.tell() > archive:
                    out.close()
                    done.append((path, n))
                    out, n = None, 0
                if out is None:
                    path = f"part-{uuid.uuid4().hex}.warc.gz"
                    where.create_dir(at, recursive=True)
                    out = where.open_output_stream(f"{at}/{path}", compression=None)
                gz = zlib.compressobj(1, wbits=31)
                out.write(gz.compress(_head(row)))
                n += 1
            out.write(gz.compress(row["bytes"]))
    if out:
        out.write(gz.compress(b"\r\n\r\n") + gz.flush())
        out.close()
        done.append((path, n))
    yield pa.RecordBatch.from_arrays(
        [pa.array([f"{folder}/{p}" for p, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())],
        ["path", "records"])


def write(table: DataFrame, folder: str | None = None, archive: int = ARCHIVE) -> DataFrame:
    """Write a chunked record table (chunks of a record in order, in one partition); the stored list of archives."""
    folder = folder or new_folder(table.sparkSession, "warc")
    listed = table.mapInArrow(lambda it: _write(it, folder, archive), "path string, records bigint")
    return stored(listed, "archives")


class _Stream:
    """Forward reader over the gzip members of one archive; holds one block."""

    def __init__(self, path: str):
        where, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        self.file = where.open_input_stream(at, compression=None)
        self.gz, self.raw, self.held = None, b"", b""

    def more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.file.read(_BLOCK)
                if not self.raw:
                    return False
            if self.gz is None:
                self.gz = zlib.decompressobj(31)
            got = self.gz.decompress(self.raw, _BLOCK)
            self.raw = self.gz.unconsumed_tail
            if self.gz.eof:
                self.raw, self.gz = self.gz.unused_data, None
            if got:
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        while mark not in self.held:
            if not self.more():
                return None
        head, _, self.held = self.held.partition(mark)
        return head

    def take(self, most: int) -> bytes:
        while not self.held:
            if not self.more():
                raise EOFError("archive ends inside a record")
        got, self.held = self.held[:most], self.held[most:]
        return got


def _read(batches, size: int, payload: bool):
    names = ["page_id", "record_type", "refers_to", "chunk_no", "bytes", "payload_bytes", "payload_digest", "last"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]
    rows, weight = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    number = lambda v: int(v[len(_ID) + 1:-1]) if v and len(v) > len(_ID) + 2 else None
    for b in batches:
        for path in b.column("path").to_pylist():
            s = _Stream(path)
            while (head := s.until(b"\r\n\r\n")) is not None:
                h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                left, seen, sha, k = int(h["Content-Length"]), 0, hashlib.sha256(), 0
                who = (number(h["WARC-Record-ID"]), h["WARC-Type"], number(h.get("WARC-Refers-To")))
                while left or not k:
                    part = []
                    want = min(left, size)
                    while want:
                        part.append(s.take(want))
                        want -= len(part[-1])
                    part = b"".join(part)
                    sha.update(part)
                    seen, left = seen + len(part), left - len(part)
                    full = (int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha256:"))
                    if who[1] == "response" and not left and full != (seen, sha.hexdigest()):
                        raise ValueError(f"record {who[0]}: payload differs from its digest")
                    at = full if who[1] == "revisit" else (seen, sha.hexdigest())
                    rows.append((*who, k, part if payload else None, *at, not left))
                    weight += len(part) if payload else 64
                    k += 1
                    if weight > 4 * _BLOCK:
                        yield batch()
                        rows, weight = [], 0
                if s.until(b"\r\n\r\n") is None:
                    raise EOFError("archive ends inside a record")
    if rows:
        yield batch()


def read(archives: DataFrame, size: int = CHUNK, payload: bool = True) -> DataFrame:
    """The chunked record table of listed archives.  payload_bytes and payload_digest: of the payload so far (of the
    whole payload on the last chunk, and on revisits); with ``payload`` false the bytes stay null."""
    n = max(1, archives.count())
    return archives.select("path").repartition(n).mapInArrow(
        lambda it: _read(it, size, payload),
        "page_id bigint, record_type string, refers_to bigint, chunk_no int, bytes binary, payload_bytes bigint, "
        "payload_digest string, last boolean")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html), read the archives back: one row per record.

    Null html is an empty payload.  Rows without page_id are written and read back without one; among equal payloads
    they are revisits of the least id there is (responses if there is none).  Rows that repeat the least id are all
    responses.  Line breaks in a url are dropped from the header.  An empty table gives no archive and no rows.
    """
    done = read(write(chunks(records(pages)), folder), payload=False)
    return done.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS n, sha256(html) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= {LEAST} GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d LEFT JOIN f USING (digest)
"""
