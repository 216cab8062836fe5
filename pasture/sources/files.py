"""File sources: CSV/Excel/JSON deliveries, hashing, device seed.

A delivery directory can hold files of several datasets with different
headers.  Instead of one read per file (a driver loop), all files are read
in ONE text scan; the first line of each file is its header (the line with
the smallest row id in the split that starts at byte 0); the header table
classifies every file (C1) and maps columns by position per dataset.  Row
order within a file is (split start, row id), which also drives the
skew-safe row numbering.
"""

from __future__ import annotations

import io
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from pasture.operators import profile as P
from pasture.operators import reshape as R
from pasture.operators.joins import DEFAULT_BROADCAST_BYTES, broadcast_if_small, join_dimension
from pasture.operators.rules import DatasetSpec

_BOM = "\ufeff"
# Cell texts that mean "no value" in a text delivery.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
               "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_CELL = ',("(?:[^"]++|"")*+"|[^,"][^,]*+|)'


def csv_cells(line: Column) -> Column:
    """The cells of one CSV record of any width: quotes respected, null tokens and empty cells NULL."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CELL), F.lit(1))
    return F.transform(cells, lambda c: F.when(
        c.startswith('"') & (F.length(c) > 1), F.replace(F.substring(c, 2, F.length(c) - 2), F.lit('""'), F.lit('"')))
        .when(~c.isin(*NULL_TOKENS), c))


def read_lines(spark: SparkSession, path: str, glob: str = "*.csv", recursive: bool = True) -> DataFrame:
    """A1/A4: every line of every matching file with its file and position."""
    r = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
              .text(path))
    return parse_lines(r.select("value", F.col("_metadata.file_path").alias("file"),
                                F.col("_metadata.file_block_start").alias("block")))


def parse_lines(lines: DataFrame) -> DataFrame:
    """The delivery's lines with an id that orders them within a block, and their cells.

    The id holds for one evaluation of the scan only; whatever compares ids (header lines with data lines, say) has
    to read a stored copy, as ``run_delivery`` does.
    """
    v = F.regexp_replace(F.col("value"), "^" + _BOM, "")
    return lines.select("file", "block", F.monotonically_increasing_id().alias("line_id"),
                        v.alias("line"), csv_cells(v).alias("cells"))


def _odd_quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.translate(line, '"', ""))) % 2 == 1


def join_quoted(lines: DataFrame) -> DataFrame:
    """Lines with records that continue over line breaks inside quotes put together again.

    Only files that hold a line with an odd number of quotes are looked at.  Whether a line begins a record follows
    from the number of such lines before it: counted within the file's blocks and added up over block totals, so no
    file is sorted in one task.  ``lines`` has to be a stored table (stable ids).
    """
    odd = lines.filter(_odd_quotes(F.col("line")))
    files = odd.select("file").distinct()
    # one action on the few odd lines spares all other deliveries the extra plan
    if files.isEmpty():
        return lines
    rest = lines.join(files, "file", "left_anti")
    x = lines.join(files, "file", "left_semi").withColumn("_odd", _odd_quotes(F.col("line")).cast("int"))
    per = x.groupBy("file", "block").agg(F.sum("_odd").alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("file", "block").orderBy("line_id").rowsBetween(Window.unboundedPreceding, -1)
    x = join_dimension(x, per, ["file", "block"]).withColumn(
        "_seen", F.col("_off") + F.coalesce(F.sum("_odd").over(inside), F.lit(0)))
    # all lines of one record have seen the same number of odd lines, or (its last line) one more
    x = x.withColumn("_open", F.col("_seen") % 2 == 1)
    whole = x.filter((F.col("_odd") == 0) & ~F.col("_open"))
    parts = x.filter((F.col("_odd") == 1) | F.col("_open")).withColumn("_rec", F.floor(F.col("_seen") / 2))
    joined = parts.groupBy("file", "_rec").agg(
        F.min(F.struct("block", "line_id")).alias("at"),
        F.array_sort(F.collect_list(F.struct("block", "line_id", "line"))).alias("parts"))      # one record's lines
    text = F.array_join(F.transform("parts", lambda q: q["line"]), "\n")
    joined = joined.select("file", "at.block", "at.line_id", text.alias("line"))
    joined = joined.withColumn("cells", csv_cells(F.col("line")))
    cols = ["file", "block", "line_id", "line", "cells"]
    return rest.select(*cols).unionByName(whole.select(*cols)).unionByName(joined.select(*cols))


def content_ids(lines: DataFrame) -> DataFrame:
    """A5: identity of every file's content, (file, sha256).

    A fold of per-line hashes with their line numbers (two sums of 64-bit hashes and the count), merged in partial
    aggregation: no file is ever held whole, of whatever size, and the split layout does not matter.
    """
    n = R.row_numbers(lines.select("file", "block", "line_id", "line"), "file", "line_id", bucket=F.col("block"))
    one = F.xxhash64(F.lit(1), "row_number", "line").cast("decimal(20,0)")
    two = F.xxhash64(F.lit(2), "line", "row_number").cast("decimal(20,0)")
    g = n.groupBy("file").agg(F.sum(one).alias("a"), F.sum(two).alias("b"), F.count(F.lit(1)).alias("n"))
    return g.select("file", F.sha2(F.concat_ws("|", "a", "b", "n"), 256).alias("sha256"))


def header_table(lines: DataFrame) -> DataFrame:
    """Per file: its header (array of names, '' where a cell is empty) and the id of the header line."""
    first = lines.filter(F.col("block") == 0).groupBy("file").agg(F.min_by(F.struct("line_id", "cells"), "line_id")
                                                                  .alias("h"))
    names = F.transform(F.col("h.cells"), lambda x: F.coalesce(x, F.lit("")))
    return first.select("file", F.col("h.line_id").alias("header_id"), names.alias("columns"))


def classify(headers: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """Dataset, device hint and time column for every file of a delivery."""
    name = F.element_at(F.split("file", "/"), -1)
    ds = P.detect_dataset(F.col("columns"))
    return headers.select("file", "header_id", "columns", ds.alias("dataset"),
                          P.resolve_device_hint(ds, name, defaults).alias("device_hint"))


def files_bytes(classified: DataFrame) -> int:
    """Measured size of the per-file table (one small aggregate over it, not an estimate)."""
    v = classified.agg(F.sum(F.length("file") + F.coalesce(F.length(F.concat_ws(",", "columns")), F.lit(0))
                             + F.lit(64))).first()[0]
    return int(v or 0)


def dataset_rows(lines: DataFrame, classified: DataFrame, spec: DatasetSpec, drop_blank: bool = True,
                 files_size: int | None = None) -> DataFrame:
    """The data rows of ``spec``'s files as raw string columns named by source header.

    Header rows are removed, columns are taken by their position in each
    file's own header (so column order may differ between files), fully empty
    rows are dropped (B6), spreadsheet summary rows too (B8), and every row
    gets its 1-based line number within the file (B10).

    The per-file table is joined to every line.  Its plan estimate is
    pessimistic (it is derived from an aggregate), so when the caller passes
    its *measured* size (``files_bytes``) under the broadcast bound it is
    broadcast and the lines are never shuffled by file (a hot file would
    otherwise land in one partition).
    """
    files = classified.filter(F.col("dataset") == spec.dataset).select("file", "header_id", "columns", "device_hint")
    if files_size is not None and files_size <= DEFAULT_BROADCAST_BYTES:
        j = lines.join(F.broadcast(files), "file")
    else:
        j = join_dimension(lines, files, "file")
    j = j.filter((F.col("block") != 0) | (F.col("line_id") != F.col("header_id")))
    cells = F.col("cells")
    pos = {src: F.array_position("columns", F.lit(src)).cast("int") for src in spec.columns}
    raw = {src: F.when(p > 0, F.try_element_at(cells, p)) for src, p in pos.items()}
    if drop_blank:       # B6: every cell of the file's row is empty (mapped or not)
        row_cells = F.slice(cells, 1, F.size("columns"))
        j = j.filter(F.exists(row_cells, lambda x: x.isNotNull() & (x != "")))
    date_pos = F.array_position("columns", F.lit("Date")).cast("int")
    j = j.filter(~R.is_summary_row(F.when(date_pos > 0, F.try_element_at(cells, date_pos))))   # B8, any file
    out = j.select(F.col("file").alias("file_id"), "device_hint", "block", "line_id",
                   *[v.alias(k) for k, v in raw.items()])
    return R.row_numbers(out, "file_id", "line_id", bucket=F.col("block")).drop("block", "line_id")


def read_responses(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """A3: landed API responses, one body per file (then B1/B2/B3)."""
    r = spark.read.option("pathGlobFilter", glob).option("wholetext", "true").text(path)
    return r.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))


def file_hashes(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """A5: sha256 of each file's bytes (``binaryFile``); the hash is the input's identity."""
    b = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return b.select(F.col("path").alias("file"), "length", F.sha2(F.col("content"), 256).alias("sha256"))


def read_device_seed(spark: SparkSession, path: str) -> DataFrame:
    """Device seed CSV (name, device_id, client, alias, device_token) → unified devices."""
    schema = "name STRING, device_id STRING, client STRING, alias STRING, device_token STRING"
    s = spark.read.option("header", "true").schema(schema).csv(path)
    return s.select(
        F.xxhash64("device_id").alias("id"), "device_id", F.lit("energy").alias("device_type"),
        F.coalesce("alias", F.lit("")).alias("alias"), F.coalesce("client", F.lit("Unknown")).alias("client"),
        F.lit(None).cast("string").alias("description"), F.lit("unknown").alias("status"), F.lit("UTC").alias("timezone"),
        F.to_json(F.struct("name", "device_token"), {"ignoreNullFields": "false"}).alias("metadata"), "device_token")


# ------------------------------------------------------------------ Excel (A2)

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
_DATE_FMT_IDS = set(range(14, 23)) | {45, 46, 47}
_EPOCH = datetime(1899, 12, 30)


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _sheet(z: zipfile.ZipFile, names: set[str]) -> str:
    """Archive name of the first worksheet."""
    first = ET.fromstring(z.read("xl/workbook.xml")).find("m:sheets/m:sheet", _NS)
    if first is not None and "xl/_rels/workbook.xml.rels" in names:
        rid = first.get(f"{{{_NS['r']}}}id")
        for rel in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")):
            if rel.get("Id") == rid:
                t = rel.get("Target").lstrip("/")
                return t if t.startswith("xl/") else "xl/" + t
    return "xl/worksheets/sheet1.xml"


def _date_styles(z: zipfile.ZipFile, names: set[str]) -> set[int]:
    """Cell styles that show a number as a date."""
    if "xl/styles.xml" not in names:
        return set()
    st = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(n.get("numFmtId")): n.get("formatCode", "") for n in st.iter(f"{{{_NS['m']}}}numFmt")}
    xfs = st.find("m:cellXfs", _NS)
    found = set()
    for i, xf in enumerate(xfs.findall("m:xf", _NS) if xfs is not None else []):
        fid = int(xf.get("numFmtId", "0"))
        code = custom.get(fid, "").lower()
        if fid in _DATE_FMT_IDS or (code and re.search(r"[dy]", re.sub(r'"[^"]*"', "", code))):
            found.add(i)
    return found


def _elements(z: zipfile.ZipFile, name: str, tag: str) -> Iterator[ET.Element]:
    """Elements of one kind as a part is parsed; each is emptied, and let go by its parent, once it has been used."""
    full = f"{{{_NS['m']}}}{tag}"
    with z.open(name) as fh:
        open_ = []
        for event, e in ET.iterparse(fh, events=("start", "end")):
            if event == "start":
                open_.append(e)
                continue
            open_.pop()
            if e.tag == full:
                yield e
                e.clear()
                if open_:
                    open_[-1].remove(e)


def xlsx_rows(data: bytes) -> list[list[str | None]]:
    """First worksheet of an .xlsx workbook as text cells, whole."""
    return list(iter_xlsx(data))


def iter_xlsx(data: bytes) -> Iterator[list[str | None]]:
    """First worksheet of an .xlsx workbook as text cells (dates as ISO text, B9), row by row.

    Held in memory: the packed workbook, its shared strings and one row, not the worksheet.
    """
    z = zipfile.ZipFile(io.BytesIO(data))
    names = set(z.namelist())
    shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in _elements(z, "xl/sharedStrings.xml", "si")] \
        if "xl/sharedStrings.xml" in names else []
    dates = _date_styles(z, names)
    for row in _elements(z, _sheet(z, names), "row"):
        cells: dict[int, str | None] = {}
        for c in row.findall("m:c", _NS):
            t, s = c.get("t"), int(c.get("s", "0"))
            v = c.find("m:v", _NS)
            text = v.text if v is not None else None
            if t == "s" and text is not None:
                text = shared[int(text)]
            elif t == "inlineStr":
                text = "".join(x.text or "" for x in c.iter(f"{{{_NS['m']}}}t"))
            elif t == "b" and text is not None:
                text = "True" if text == "1" else "False"
            elif text is not None and s in dates and t in (None, "n"):
                text = (_EPOCH + timedelta(days=float(text))).strftime("%Y-%m-%dT%H:%M:%S")
            cells[_col_index(c.get("r"))] = text
        if cells:
            yield [cells.get(i) for i in range(max(cells) + 1)]


MAX_WORKBOOK = 1 << 30              # bytes of a packed workbook; larger ones are rejected unread
_BINARY = "path string, modificationTime timestamp, length bigint, content binary"
_WORKBOOK_ROWS = "file string, pos bigint, cells array<string>, error string"


def _parse_workbooks(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of every workbook, or after them one row with the error that ended it."""
    for pdf in it:
        for path, content in zip(pdf["path"], pdf["content"]):
            held, at = [], 0

            def part(error=None):
                return pd.DataFrame({"file": path, "pos": range(at, at + len(held)), "cells": held, "error": error}, dtype=object)
            try:
                if content is None:
                    raise ValueError(f"larger than {MAX_WORKBOOK} bytes")
                for row in iter_xlsx(bytes(content)):
                    held.append(row)
                    if len(held) == 10_000:
                        yield part()
                        held, at = [], at + len(held)
            except Exception as e:      # whatever is wrong with one workbook is that workbook's error
                held = [None]
                yield part(f"{type(e).__name__}: {e}"[:500])
                continue
            if held:
                yield part()


def workbook_lines(binary: DataFrame) -> DataFrame:
    """A2: workbooks (path, length, content) → lines like ``read_lines``, with ``error`` for those that cannot be read.

    One workbook per row, parsed in ``mapInPandas`` with the standard library.
    """
    b = binary.select("path", F.when(F.col("length") <= MAX_WORKBOOK, F.col("content")).alias("content"))
    x = b.mapInPandas(_parse_workbooks, _WORKBOOK_ROWS)
    cells = F.transform("cells", lambda c: F.when(~c.isin(*NULL_TOKENS), c))
    return x.select("file", F.lit(0).cast("long").alias("block"), F.col("pos").alias("line_id"),
                    F.array_join("cells", ",", "").alias("line"), cells.alias("cells"), "error")


def read_excel(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """A2: first sheet of every workbook → lines frame (same shape as ``read_lines``, and ``error``)."""
    b = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return workbook_lines(b)


def offered_files(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """A4: (file) of every matching file, those without a byte too, which no scan returns.

    The names come from the listing that the driver makes for every scan anyway; nothing is read.
    """
    r = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    return spark.createDataFrame([(re.sub(r"^([a-zA-Z][\w+.-]*):///", r"\1:/", f),) for f in r.inputFiles()], "file string")


def _same_file(file: Column) -> Column:
    """A file's URI with one slash after its scheme: listings and scans write it differently."""
    return F.regexp_replace(file, r"^([a-zA-Z][\w+.-]*):/+", "$1:/")


def split_broken(lines: DataFrame, offered: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines of readable files, (file, detail) of the others); a file with an ``error`` loses all its lines.

    ``offered`` files without any line are empty.  ``lines`` has to be a stored table.
    """
    bad = lines.filter("error IS NOT NULL").groupBy("file").agg(F.min("error").alias("detail"))
    if offered is not None:
        found = lines.select(_same_file(F.col("file")).alias("_at")).distinct()
        bad = bad.unionByName(offered.withColumn("_at", _same_file(F.col("file"))).join(found, "_at", "left_anti")
                              .select("file", F.lit("empty file").alias("detail")))
    good = lines.drop("error")
    if bad.isEmpty():
        return good, bad
    return good.join(broadcast_if_small(bad.select("file")), "file", "left_anti").select(*good.columns), bad


def source_type_of(file: Column) -> Column:
    """Q2: csv / excel / api from the input's extension (responses are api)."""
    low = F.lower(file)
    return (F.when(low.endswith(".csv"), "csv").when(low.endswith(".xlsx") | low.endswith(".xls"), "excel")
             .when(low.endswith(".json"), "api").otherwise("unknown"))
