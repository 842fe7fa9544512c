"""File sources: landing-zone listing (S-9), header sniffing and all-text CSV reads grouped by
header (S-6/S-7), XLSX workbooks (S-8), config and franchise sheets (S-10/S-11).

Spark's CSV parser maps a given schema to columns *by position*, so files whose headers differ
must not share one read. Files are grouped by their exact header line (read by distributed
tasks that open each file); names are cleaned (P-1), missing markers nulled, and the groups are aligned to the target
and unioned by name.

Small files are opened by tasks, which get their paths as rows and hand each record to ``from_csv``: a reader of Spark's own keeps
one status per file in the driver and spends milliseconds on opening each. Large files (``SMALL_BYTES``), and small ones whose quotes
do not show where records end, are read by ``spark.read.csv`` over their paths.
"""

from __future__ import annotations

import codecs
import csv
import datetime as dt
import io
import json
import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.headers import clean_names
from ..functions.scalar import last_path_segment
from ..operators.align import na_to_null
from ..session import scratch_path

FILE_ID_PATTERN = r"file_id=([^/]+)"
RECORD = "__record__"          # the text of a record whose number of cells is not the header's
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "mode": "PERMISSIVE"}
SMALL_BYTES = 4 << 20          # files up to this size are read whole by a task
TASK_BYTES, TASK_FILES = 16 << 20, 1000
BATCH_BYTES = 4 << 20


def list_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """S-9: every file below ``root`` (path, name, size, modification time, file_id tag from the
    ``file_id=…`` folder). Only metadata columns are selected, so no content is read."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
          .load(root).select("path", "length", "modificationTime"))
    return df.select("path", last_path_segment(F.col("path")).alias("file_name"), "length", "modificationTime",
                     F.regexp_extract("path", FILE_ID_PATTERN, 1).alias("file_id"))


def recent_paths(spark: SparkSession, root: str, now: dt.datetime, delta_days: int | None = 7, sensor_seconds: int = 60,
                 glob: str = "*.csv") -> DataFrame:
    """S-1 / S-3 on real folders: ``list_files`` of what changed since, outside all ``Processed`` folders (S-2).

    Day mode: on or after midnight ``delta_days`` days before ``now``, as in the recursive walk; ``delta_days=None``: later than
    ``sensor_seconds`` before ``now`` (the strict comparison of the flat listing). Times are UTC. Spark leaves older files out while
    it lists (``modifiedAfter``, whole seconds, so one second earlier than asked); the filter then is exact.
    """
    strict = delta_days is None
    bound = now - dt.timedelta(seconds=sensor_seconds) if strict else \
        now.replace(hour=0, minute=0, second=0, microsecond=0) - dt.timedelta(days=delta_days)
    after = (bound - dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
             .option("modifiedAfter", after).option("timeZone", "UTC").load(root))
    instant = F.unix_micros("modificationTime")
    micros = round((bound - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    found = found.where((instant > micros if strict else instant >= micros) & ~F.contains(F.col("path"), F.lit("/Processed/")))
    return found.select("path", last_path_segment(F.col("path")).alias("file_name"), "length", "modificationTime",
                        F.regexp_extract("path", FILE_ID_PATTERN, 1).alias("file_id"))


def empty_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """(path, file_id) of the files of zero bytes below ``root``: Spark's readers, and so ``list_files``, leave them out."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root))
    one = lambda c: F.regexp_replace(c, "^file:/+", "file:/")  # noqa: E731  (both spellings occur)
    names = spark.createDataFrame([(p,) for p in found.inputFiles()], "path string").select(one("path").alias("path"))   # file metadata
    rest = names.join(found.select(one("path").alias("path")), "path", "left_anti")
    return rest.select("path", F.regexp_extract("path", FILE_ID_PATTERN, 1).alias("file_id"))


def filesystem_of(path: str):
    """(file system, path in it) of a Spark file path: local, or any store that pyarrow knows."""
    from pyarrow import fs
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if path.startswith(hadoop):
            path = arrow + path[len(hadoop):]
    return fs.FileSystem.from_uri(path)


def _open(path: str):
    """Open a Spark file path for reading."""
    filesystem, p = filesystem_of(path)
    return filesystem.open_input_stream(p, compression=None)


def _small(path: str) -> tuple[int, bytes | None]:
    """The size of a file, and its bytes if it is small."""
    filesystem, p = filesystem_of(path)
    with filesystem.open_input_file(p) as f:
        size = f.size()
        return size, f.read() if size <= SMALL_BYTES else None


def spread(df: DataFrame, key: str, tasks: int = 0) -> DataFrame:
    """Rows that stand for files, dealt to at least as many tasks as there are cores: by their own bytes they would be taken for one task."""
    return df.repartition(max(tasks, df.sparkSession.sparkContext.defaultParallelism), key)


def _first_record(path: str, chunk: int = 1 << 16, data: bytes | None = None) -> tuple[list[str], bool]:
    """Parse the header record (the first CSV record that is not a blank line, as pandas and Spark take
    it; quoted line breaks allowed), and whether blank lines come before it. Reads the file head in chunks
    only until the record ends."""
    buf, end, begin = "", -1, 0
    decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")   # a character may span chunks
    with _open(path) if data is None else pa.BufferReader(data) as f:
        while True:
            some = f.read(chunk)
            if not some:
                break
            start = len(buf)
            buf += decoder.decode(some)
            quotes = buf[:start].count('"')
            for i in range(start, len(buf)):
                ch = buf[i]
                if ch == '"':
                    quotes += 1
                elif ch == "\n" and quotes % 2 == 0:
                    if not buf[begin:i].strip("\ufeff \t\r"):
                        begin = i + 1
                        continue
                    end = i
                    break
            if end >= 0:
                break
    text = (buf[begin:] if end < 0 else buf[begin:end]).lstrip("\ufeff")
    rows = list(csv.reader(io.StringIO(text), doublequote=True))
    return (rows[0] if rows else []), begin > 0


BY_LINES, BY_QUOTES, BY_SPARK = "lines", "quotes", "spark"      # where a file's records end
_LINE_END = re.compile(rb"\r\n|\n|\r")
_QUOTED_CELL = re.compile(rb'(?<![^,\n])"(?:[^"]|"")*"(?=[,\n]|\Z)')
_QUOTED_OR_END = re.compile(rb'"(?:[^"]|"")*"|\n')
_BLANK = bytes(range(33))      # what Java's trim takes for blank


def _record_ends(data: bytes, blank_first: bool) -> str:
    """How a small file is cut into records: at each line end, if no line has an odd number of quotes; at the line ends outside
    quotes, if each quote belongs to a cell that is quoted as a whole; else by Spark's reader, as are files with both kinds of
    breaks or with lines of blanks, which it treats in its own way."""
    if b'"' not in data or all(line.count(b'"') % 2 == 0 for line in _LINE_END.split(data)):
        return BY_LINES
    plain = _QUOTED_CELL.sub(b"", data)
    odd = blank_first or b"\r" in data or b'"' in plain or any(line and not line.strip(_BLANK) for line in plain.split(b"\n"))
    return BY_SPARK if odd else BY_QUOTES


def _records(data: bytes, ends: str) -> list[bytes]:
    """The records of a small file after its header."""
    data = data.removeprefix(codecs.BOM_UTF8)
    if ends == BY_LINES:
        return [x for x in _LINE_END.split(data) if x.strip(_BLANK)][1:]
    cuts = [m.start() for m in _QUOTED_OR_END.finditer(data) if m[0] == b"\n"]
    return [x for x in (data[i + 1:j] for i, j in zip([-1, *cuts], [*cuts, len(data)])) if x][1:]


def _sniff(quoted_newlines: bool | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path in pdf["path"]:
                size, data = _small(path)
                names, blank_first = header = _first_record(path, data=data)
                ends = BY_SPARK if data is None or quoted_newlines else BY_LINES if quoted_newlines is False else _record_ends(data, blank_first)
                out.append((path, json.dumps(header), bool(names), size, ends))
            yield pd.DataFrame(out, columns=["path", "header", "named", "length", "ends"])
    return run


def sniff_headers(files: DataFrame, quoted_newlines: bool | None = None) -> DataFrame:
    """Per file: path, header and blank-lines flag as JSON text, whether the header has a cell, length, and how its records end
    (``_record_ends``). Computed by executors, which open each file once."""
    return spread(files.select("path"), "path").mapInPandas(_sniff(quoted_newlines), "path string, header string, named boolean, length long, ends string")


def _file_uri(path: str) -> str:
    """A path as ``_metadata.file_path`` spells it: characters that a URI cannot hold are written as %XX."""
    scheme, rest = re.match(r"(?:([a-z][a-z0-9+.-]*):)?(.*)", path, re.S).groups()
    if scheme in (None, "file"):
        scheme, rest = "file", "/" + rest.lstrip("/")
    return f"{scheme}:" + "".join(c if ord(c) > 127 and not c.isspace() else quote(c, safe="/_-!.~'()*,;:$&+=@") for c in rest)


def _ddl(schema: StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + f"` {f.dataType.simpleString()}" for f in schema)


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of small files as bytes, with the files' paths."""
    def made():
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(records, pa.binary())], ["path", "line"])
    for batch in batches:
        paths, records, held = [], [], 0
        for path, ends in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist()):
            some = _records(_small(path)[1], ends)
            paths += [_file_uri(path)] * len(some)
            records += some
            held += sum(map(len, some))
            if held > BATCH_BYTES:
                yield made()
                paths, records, held = [], [], 0
        yield made()


def quoted_newline_files(spark: SparkSession, paths: list[str]) -> set[str]:
    """The files with a line break inside quotes: some line of theirs has an odd number of quotes. One scan of the
    lines, which Spark splits as it likes; the driver gets the names of such files only."""
    if not paths:
        return set()
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    return {r.path for r in lines.where(odd).select("path").distinct().collect()}


def pandas_names(header: list[str]) -> list[str]:
    """Duplicate headings get pandas' '.1', '.2' suffixes; blank headings 'Unnamed: i'."""
    seen: dict[str, int] = {}
    out = []
    for i, h in enumerate(header):
        h = h if h != "" else f"Unnamed: {i}"
        if h in seen:
            seen[h] += 1
            h = f"{h}.{seen[h]}"
        else:
            seen[h] = 0
        out.append(h)
    return out


def _cells(record: Column) -> Column:
    """Number of cells of a CSV record: its commas outside quotes, and one."""
    plain = F.regexp_replace(record, r'"([^"]|"")*"', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def read_header_groups(spark: SparkSession, files: DataFrame, clean: bool = True, na: bool = True,
                       tag: bool = True, quoted_newlines: bool | None = None) -> list[DataFrame]:
    """The groups of ``read_checked`` alone."""
    return read_checked(spark, files, clean, na, tag, quoted_newlines)[0]


def read_checked(spark: SparkSession, files: DataFrame, clean: bool = True, na: bool = True, tag: bool = True,
                 quoted_newlines: bool | None = None) -> tuple[list[DataFrame], DataFrame]:
    """(groups, quarantine). One all-text DataFrame per distinct header, columns cleaned (P-1) unless ``clean=False``,
    pandas missing markers nulled, plus ``file_id`` and ``path``. The driver receives the distinct headers, and the paths of
    large files and of those whose records only Spark's reader finds; all others are listed in a table and read by tasks.

    ``quarantine`` (path, file_id, reason, record): records with more cells than the header (pandas stops at them; they
    are in no group), and files without a header. Records with fewer cells are filled with NULL.

    ``quoted_newlines``: ``None`` probes the files; large ones with line breaks inside quotes are read by one task each, other
    large ones can be split. ``True`` / ``False`` say so for all files.
    """
    store = scratch_path(spark, "sniffed")
    sniff_headers(files, quoted_newlines).write.mode("overwrite").parquet(store)
    sniffed = spark.read.parquet(store)
    kinds = sniffed.groupBy("header", "named", (F.col("ends") == BY_SPARK).alias("by_spark")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("length")).collect()       # a few rows per header
    by_header: dict[str, dict[bool, tuple[int, int]]] = {}
    for r in kinds:
        by_header.setdefault(r["header"], {})[r["by_spark"]] = r["n"], r["length"]
    listed = {}                                             # large files and those with odd quotes
    if any(r["by_spark"] and r["named"] for r in kinds):
        for r in sniffed.where((F.col("ends") == BY_SPARK) & F.col("named")).select("header", "path", "length").collect():
            listed.setdefault(r["header"], []).append((r["path"], r["length"]))
    large = [p for some in listed.values() for p, length in some if length > SMALL_BYTES]
    whole = {_file_uri(p) for some in listed.values() for p, length in some if length <= SMALL_BYTES or quoted_newlines}
    whole |= quoted_newline_files(spark, large) if quoted_newlines is None else set()
    out = []
    file_id = F.regexp_extract("path", FILE_ID_PATTERN, 1).alias("file_id")
    bad = [sniffed.where(~F.col("named")).select(
        "path", file_id, F.lit("file without a header").alias("reason"), F.lit(None).cast("string").alias("record"))]
    for header, sizes in sorted(by_header.items()):
        names, blank_lines = json.loads(header)
        raw = pandas_names(names)
        if not raw:
            continue
        schema = StructType([StructField(n, StringType(), True) for n in [*raw, RECORD]])
        for one_task in (True, False, None):
            opts = dict(CSV_OPTIONS, multiLine=str(bool(one_task)).lower(), columnNameOfCorruptRecord=RECORD)
            if one_task is None:
                if False not in sizes:
                    continue
                n, length = sizes[False]
                mine = sniffed.where((F.col("header") == header) & (F.col("ends") != BY_SPARK)).select("path", "ends")
                lines = spread(mine, "path", max(length // TASK_BYTES, n // TASK_FILES)).mapInArrow(_read_records, "path string, line binary")
                # a generator, so that each record is parsed once whatever is asked of its columns
                parsed = F.from_csv(F.col("line").cast("string"), _ddl(schema), dict(opts, header="false"))
                df = lines.select(F.col("path").alias("__path__"), F.inline(F.array(parsed)))
            else:
                some = sorted(p for p, _ in listed.get(header, ()) if (_file_uri(p) in whole) == one_task)
                if not some:
                    continue
                df = spark.read.options(**opts).schema(schema).csv(some).select("*", F.col("_metadata.file_path").alias("__path__"))
            if blank_lines:      # Spark drops a blank line as the header, so the header is still among the rows
                df = df.where(~F.array(*[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in raw]).eqNullSafe(F.array(*map(F.lit, names))))
            df = df.select(*[F.col(f"`{n}`") for n in [*raw, RECORD, "__path__"]])
            # the reader counts a record's cells only if all columns are asked for, so the test looks at them all, whatever
            # columns the caller takes (cells without their commas never equal the record)
            joined = F.concat_ws("", *[F.col(f"`{n}`") for n in raw])
            ragged = F.col(RECORD).isNotNull() & (_cells(F.col(RECORD)) > len(raw)) & (joined != F.col(RECORD))
            bad.append(df.where(ragged).select(F.col("__path__").alias("path"), F.col(RECORD).alias("record"))
                       .select("path", file_id, F.lit("more cells than the header").alias("reason"), "record"))
            df = df.where(~F.coalesce(ragged, F.lit(False))).drop(RECORD)
            if clean:
                df = df.toDF(*clean_names(raw), "__path__")
            if na:
                df = na_to_null(df, [c for c in df.columns if c != "__path__"])
            df = df.withColumnRenamed("__path__", "path")
            if tag:
                df = df.withColumn("file_id", F.regexp_extract("path", FILE_ID_PATTERN, 1))
            out.append(df)
    quarantine = bad[0]
    for b in bad[1:]:
        quarantine = quarantine.unionByName(b)
    return out, quarantine


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """S-10: the config sheet as CSV; three columns by position (filename, owner, search). A
    sheet with only a header gives an empty, typed frame."""
    schema = StructType([StructField(c, StringType(), True) for c in ("filename", "hubspot_owner", "zi_search")])
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)


def read_franchises(spark: SparkSession, files: DataFrame, title: str = "FRANCHISE Master List") -> DataFrame:
    """S-11: the franchise list, read only from the file (a folder of CSV parts) whose trimmed
    name equals the expected title; every other file yields nothing. All columns as text."""
    named = files.where(F.trim(F.element_at(F.split(F.col("path"), "/"), -2)) == title)
    groups = read_header_groups(spark, named, clean=False, na=False, tag=False)       # each file by its own header
    if not groups:
        return spark.createDataFrame([], "franchise_name string, domain_name string")
    out = groups[0].drop("path")
    for g in groups[1:]:
        out = out.unionByName(g.drop("path"), allowMissingColumns=True)
    return out


def _partition_value(path, name: str):
    """Value of a ``name=`` folder in a file URI: the URI's own %-encoding, then Spark's %XX
    escaping of partition values, are undone ('+' is literal in both)."""
    raw = F.regexp_extract(path, f"{name}=([^/]+)", 1)
    once = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.url_decode(F.replace(once, F.lit("+"), F.lit("%2B")))


def read_sheets(spark: SparkSession, root: str) -> DataFrame:
    """Read back a K-4 output folder: sheets differ in columns, so each header group is read on
    its own and the groups are unioned by name (columns a sheet lacks are NULL); ``book``,
    ``sheet`` and ``file_id`` come from the folder names."""
    parts = read_header_groups(spark, list_files(spark, root), clean=False, na=False, tag=False)
    if not parts:
        return spark.createDataFrame([], "book string, sheet string, file_id string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return (out.withColumn("book", _partition_value(F.col("path"), "book"))
            .withColumn("sheet", _partition_value(F.col("path"), "sheet"))
            .withColumn("file_id", _partition_value(F.col("path"), "file_id")).drop("path"))
