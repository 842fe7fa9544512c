"""S-8: XLSX workbooks without a spreadsheet library: a workbook is a zip of XML parts, read and
written with the standard library inside tasks.

Reading: the ``binaryFile`` source gives one row per workbook (a sheet holds at most 1,048,576
rows, so one task per workbook is bounded); ``mapInPandas`` reads the first worksheet as a stream of
XML events and hands out slices of ``ROWS_PER_SLICE`` rows (path, row_no, cells), every cell as text
(``cell_text``); rows are then grouped by their header row and shaped like CSV rows (``rows_by_header``).
Rows with cells beyond the header and files that are no workbooks are refused (``refused_rows``).
Writing (for test inputs): ``applyInPandas`` over (file_id, part) groups, each part bounded.
"""

from __future__ import annotations

import datetime as dt
import functools
import io
import json
import os
import re
import zipfile
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.headers import clean_names
from ..operators.align import na_to_null
from ..session import scratch_path
from .files import FILE_ID_PATTERN, pandas_names

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "p": "http://schemas.openxmlformats.org/package/2006/relationships"}
ROWS_PER_WORKBOOK = 200_000


_COLUMN = re.compile(r"[A-Z]+")


@functools.lru_cache(1 << 15)
def _column_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _col_index(ref: str) -> int:
    return _column_number(_COLUMN.match(ref).group(0))


@functools.lru_cache(1 << 15)
def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


# Fixed values of the file format: number formats without a format code of their own that show dates or times.
BUILTIN_DATES = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 47}
BUILTIN_ELAPSED = {46}
EPOCH_1900, EPOCH_1904 = dt.datetime(1899, 12, 30), dt.datetime(1904, 1, 1)
ROWS_PER_SLICE = 5_000
_M = f"{{{NS['m']}}}"
_C, _IS, _V, _T, _R = (_M + tag for tag in ("c", "is", "v", "t", "r"))


def format_kind(code: str) -> str:
    """What a number format shows: 'date' (also times of day), 'elapsed' (hours counted on, like ``[h]:mm``) or 'number'.
    Quoted and escaped text, colours and locales do not count, and only the section for positive numbers does."""
    plain = re.sub(r'"[^"]*"|\\.|_.|\*.', "", code).split(";")[0]
    if re.search(r"\[(h+|m+|s+)\]", plain, re.IGNORECASE):
        return "elapsed"
    plain = re.sub(r"\[[^\]]*\]", "", plain)
    if re.search(r"general", plain, re.IGNORECASE):
        return "number"
    return "date" if re.search(r"[ymdhs]", plain, re.IGNORECASE) else "number"


def serial_text(serial: float, kind: str, date1904: bool) -> str | None:
    """The text of a date or time, kept in a workbook as a number of days: ``2024-01-05 13:30:00``, a time of day (below
    one day) ``13:30:00``, an elapsed time ``1 day, 2:00:00``; to the millisecond. NULL beyond the years 1 to 9999."""
    try:
        span = dt.timedelta(milliseconds=round(serial * 86_400_000))
        if kind == "elapsed":
            return str(span)
        if dt.timedelta(0) <= span < dt.timedelta(days=1):
            return str((EPOCH_1904 + span).time())
        if not date1904 and span < dt.timedelta(days=60):
            span += dt.timedelta(days=1)            # the 1900 system counts a 29 February 1900
        return str((EPOCH_1904 if date1904 else EPOCH_1900) + span)
    except (OverflowError, ValueError):
        return None


def number_text(value: str) -> str:
    """A stored number as text: whole numbers without a decimal point (``1E3`` and ``1000.0`` read as 1000)."""
    if re.fullmatch(r"[+-]?\d+", value):
        return value
    f = float(value)
    return str(int(f)) if f == f and abs(f) != float("inf") and f == int(f) else repr(f)


def cell_text(kind: str, style: str, value: str | None, date1904: bool) -> str | None:
    """The text of a cell of type ``kind`` (the ``t`` attribute, '' for numbers) whose format shows ``style``. Errors are
    missing values, like in the reference's reader; booleans read True / False."""
    if value is None or kind == "e":
        return None
    if kind == "b":
        return "True" if value.strip() in ("1", "true") else "False"
    if kind == "d":                                 # an ISO 8601 date
        try:
            return str(dt.datetime.fromisoformat(value.strip()).replace(tzinfo=None))
        except ValueError:
            return value
    if kind in ("", "n"):
        try:
            return number_text(value.strip()) if style == "number" else serial_text(float(value), style, date1904)
        except ValueError:
            return value
    return value


def _rich_text(item: ET.Element) -> str:
    """The text of a string item: its own and its runs', without phonetic hints."""
    own = [t.text or "" for t in item if t.tag == _T]
    runs = [t.text or "" for r in item if r.tag == _R for t in r if t.tag == _T]
    return "".join(own + runs)


def _elements(part, tag: str):
    """The finished elements ``tag`` of an XML part, one at a time; what was handed out is dropped from memory."""
    name, inside = _M + tag, None
    above: list[ET.Element] = []        # the elements around the wanted one; those inside it are only passed by
    for event, e in ET.iterparse(part, events=("start", "end")):
        if inside is not None:
            if event == "start" or e.tag != name:
                continue
            yield e
            if e is inside:
                inside = None
                if above:
                    above[-1].remove(e)
        elif event == "end":
            above.pop()
        elif e.tag == name:
            inside = e
        else:
            above.append(e)


def _cell_styles(z: zipfile.ZipFile) -> list[str]:
    """Per cell format (the ``s`` attribute) what it shows."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ET.fromstring(z.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): format_kind(f.get("formatCode", "")) for f in root.findall("m:numFmts/m:numFmt", NS)}
    known = dict.fromkeys(BUILTIN_DATES, "date") | dict.fromkeys(BUILTIN_ELAPSED, "elapsed") | own
    return [known.get(int(x.get("numFmtId", "0")), "number") for x in root.findall("m:cellXfs/m:xf", NS)]


def sheet_rows(data: bytes):
    """The rows of the workbook's first worksheet, one list of texts each. Cells without a reference follow the cell before."""
    z = zipfile.ZipFile(io.BytesIO(data))
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    properties = wb.find("m:workbookPr", NS)
    date1904 = properties is not None and properties.get("date1904", "0") in ("1", "true")
    rid = wb.find("m:sheets/m:sheet", NS).get(f"{{{NS['r']}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels.findall("p:Relationship", NS) if r.get("Id") == rid).lstrip("/")
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        with z.open("xl/sharedStrings.xml") as part:
            shared = [_rich_text(si) for si in _elements(part, "si")]
    styles = _cell_styles(z)
    with z.open(target if target.startswith("xl/") else f"xl/{target}") as part:
        for row in _elements(part, "row"):
            cells: list[str | None] = []
            for c in row:
                if c.tag != _C:
                    continue
                get = c.get
                ref, kind, inline, v = get("r"), get("t", ""), None, None
                for x in c:
                    if x.tag == _IS and inline is None:
                        inline = x
                    elif x.tag == _V and v is None:
                        v = x
                at = _col_index(ref) if ref else len(cells)
                value = _rich_text(inline) if inline is not None else None if v is None else v.text
                if kind == "s" and value is not None:
                    value = shared[int(value)]
                s = int(get("s", "0"))
                if at >= len(cells):
                    cells += [None] * (at + 1 - len(cells))
                cells[at] = cell_text(kind, styles[s] if s < len(styles) else "number", value, date1904)
            yield cells


NO_WORKBOOK = -1        # the row number of a file that is no workbook; its one cell says why


def _parse(batches):
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            first, rows = 0, []
            try:
                for row in sheet_rows(bytes(content)):
                    rows.append(row)
                    if len(rows) == ROWS_PER_SLICE:
                        yield _slice(path, first, rows)
                        first, rows = first + len(rows), []
            except (zipfile.BadZipFile, KeyError, IndexError, ValueError, AttributeError, StopIteration, ET.ParseError) as e:
                yield _slice(path, NO_WORKBOOK, [[f"{type(e).__name__}: {e}"]])
            if rows:
                yield _slice(path, first, rows)


def _slice(path: str, first: int, rows: list) -> pd.DataFrame:
    return pd.DataFrame({"path": path, "row_no": range(first, first + len(rows)), "cells": rows})


def read_rows(spark: SparkSession, root: str) -> DataFrame:
    """(path, row_no, cells) for every workbook below ``root``; row 0 is the header. A file that cannot be read to its
    end has a row ``NO_WORKBOOK``. The books are parsed once: the rows are written to the shared work folder and read back."""
    books = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xlsx")
             .load(root).select("path", "content"))
    path = scratch_path(spark, "workbook_rows")
    books.mapInPandas(_parse, "path string, row_no int, cells array<string>").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _file_id(path: str = "path"):
    return F.regexp_extract(path, FILE_ID_PATTERN, 1).alias("file_id")


def refused_rows(rows: DataFrame) -> DataFrame:
    """(path, file_id, reason, record): files that are no workbooks, of which no row is taken, and rows with cells beyond
    their header's, as JSON text."""
    broken = rows.where(F.col("row_no") == NO_WORKBOOK)
    heads = rows.where(F.col("row_no") == 0).select(F.col("path").alias("_p"), F.size("cells").alias("_n"))
    wide = _of_whole_books(rows).join(heads, F.col("path") == F.col("_p")).where((F.col("row_no") > 0) & _beyond(F.col("_n")))
    return broken.select("path", _file_id(), F.lit("file that is no workbook").alias("reason"), F.get("cells", F.lit(0)).alias("record")) \
        .unionByName(wide.select("path", _file_id(), F.lit("more cells than the header").alias("reason"), F.to_json("cells").alias("record")))


def _of_whole_books(rows: DataFrame) -> DataFrame:
    broken = rows.where(F.col("row_no") == NO_WORKBOOK).select(F.col("path").alias("_broken"))
    return rows.join(broken, F.col("path") == F.col("_broken"), "left_anti").where(F.col("row_no") >= 0)


def _beyond(width):
    """Whether a row has a filled cell after the first ``width`` ones."""
    rest = F.slice("cells", width + 1, F.greatest(F.size("cells") - width, F.lit(0)))
    return F.exists(rest, lambda c: c.isNotNull())


def rows_by_header(spark: SparkSession, rows: DataFrame, clean: bool = True) -> list[DataFrame]:
    """One DataFrame per distinct header (P-1 names unless ``clean=False``, pandas missing markers
    NULL), like ``files.read_header_groups``; the driver receives only the distinct headers. Rows shorter than the header
    are filled with NULL; ``refused_rows`` are left out."""
    rows = _of_whole_books(rows)
    heads = rows.where(F.col("row_no") == 0).select("path", F.to_json("cells").alias("header"))
    out = []
    for h in heads.select("header").distinct().collect():
        raw = pandas_names([c if c is not None else "" for c in json.loads(h["header"])])
        paths = heads.where(F.col("header") == h["header"]).select(F.col("path").alias("_p"))
        body = rows.where((F.col("row_no") > 0) & ~_beyond(F.lit(len(raw)))).join(paths, F.col("path") == F.col("_p"), "left_semi")
        df = body.select(*[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(raw)], "path")
        names = clean_names(raw) if clean else raw
        df = df.toDF(*names, "path")
        df = na_to_null(df, names).withColumn("file_id", _file_id())
        out.append(df)
    return out


# ---- writing ----------------------------------------------------------------------------------

_CT = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
       '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
       '<Default Extension="xml" ContentType="application/xml"/>'
       '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
       '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
       '</Types>')
_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
         '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
         '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
         '</Relationships>')
_WB = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
       'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
       '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>')
_WB_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
            '</Relationships>')


def _open_write(path: str):
    """Open a file for writing on the local or a Hadoop-compatible store (via pyarrow)."""
    if "://" not in path and not path.startswith("file:"):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    if path.startswith("file:"):
        local = "/" + path[5:].lstrip("/")
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "wb")
    from pyarrow import fs
    filesystem, p = fs.FileSystem.from_uri(path)
    filesystem.create_dir(p.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(p)


_STYLES = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
           '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
           '<numFmts count="2"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd&quot; at &quot;hh:mm"/>'
           '<numFmt numFmtId="165" formatCode="[Red]0.00&quot; days&quot;"/></numFmts>'
           '<cellXfs count="5"><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="21"/><xf numFmtId="46"/><xf numFmtId="165"/></cellXfs>'
           '</styleSheet>')
_CELL_ATTRIBUTES = {"date": 's="1"', "time": 's="2"', "elapsed": 's="3"', "number": 's="4"', "boolean": 't="b"', "error": 't="e"'}


def workbook_bytes(header: list[str], rows: list[list[str | None]], kinds: list[str] | None = None, date1904: bool = False) -> bytes:
    """A one-sheet workbook (empty cells for None). ``kinds``: per column 'text' (inline strings) or a key of
    ``_CELL_ATTRIBUTES``, whose values are stored as they are given; such cells carry no reference."""
    kinds = kinds or ["text"] * len(header)

    def cell(r, i, v, kind):
        if kind == "text":
            return f'<c r="{_col_letters(i)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
        return f"<c {_CELL_ATTRIBUTES[kind]}><v>{escape(v)}</v></c>"

    def row_xml(r, vals, kinds):
        cells = "".join(cell(r, i, v, k) if v is not None else "<c/>" for i, (v, k) in enumerate(zip(vals, kinds)))
        return f'<row r="{r}">{cells}</row>'
    body = row_xml(1, header, ["text"] * len(header)) + "".join(row_xml(i + 2, r, kinds) for i, r in enumerate(rows))
    sheet = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
             f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}'
             '</sheetData></worksheet>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CT)
        z.writestr("_rels/.rels", _RELS)
        z.writestr("xl/workbook.xml", _WB.replace("<sheets>", '<workbookPr date1904="1"/><sheets>') if date1904 else _WB)
        z.writestr("xl/_rels/workbook.xml.rels", _WB_RELS)
        z.writestr("xl/styles.xml", _STYLES)
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return buf.getvalue()


def write_workbooks(df: DataFrame, root: str, key: str = "file_id", rows_per_book: int = ROWS_PER_WORKBOOK,
                    kinds: dict[str, str] | None = None, date1904: bool = False) -> DataFrame:
    """Write ``df`` as workbooks ``root/<key>=<v>/part-<n>.xlsx``: rows of one key are split into
    ceil(n / rows_per_book) parts by a hash of the row, so every task holds a bounded group.
    Returns (key, part, path, rows) for the written books (an action runs it). ``kinds``: the kind of cells per column
    (text if not named), see ``workbook_bytes``."""
    cols = [c for c in df.columns if c != key]
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_n") / rows_per_book)).cast("long")
    j = df.join(counts, key).withColumn("_part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols]), parts)).drop("_n")
    base = root.rstrip("/")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        k, part = pdf[key].iloc[0], int(pdf["_part"].iloc[0])
        path = f"{base}/{key}={k}/part-{part:05d}.xlsx"
        vals = [list(r) for r in zip(*([None if v is None or v != v else v for v in pdf[c].tolist()] for c in cols))]
        with _open_write(path) as f:
            f.write(workbook_bytes(cols, vals, [(kinds or {}).get(c, "text") for c in cols], date1904))
        return pd.DataFrame({key: [k], "part": [part], "path": [path], "rows": [len(pdf)]})

    schema = StructType([StructField(key, StringType()), StructField("part", StringType()),
                         StructField("path", StringType()), StructField("rows", StringType())])
    out = j.groupBy(key, "_part").applyInPandas(
        lambda pdf: write(pdf).astype(str), schema)
    return out
