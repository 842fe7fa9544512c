"""Sinks (K-1 … K-6): replace-load, append-load by file, landing CSVs, sheet outputs, table
snapshots. Writes are partitioned by file (or by book/sheet) after a ``rebalance`` by that key:
AQE splits a hot key over several tasks, and ``maxRecordsPerFile`` bounds every part file.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import ntz
from ..sources.files import filesystem_of, spread

ROWS_PER_PART = 500_000
CSV_WRITE_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false",
                     "ignoreTrailingWhiteSpace": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def rebalanced(df: DataFrame, keys: list[str]) -> DataFrame:
    """Repartition by ``keys`` for a partitioned write with the ``rebalance`` hint: AQE splits a
    key whose partition is larger than the advisory size over several tasks (a hot file is
    written by many tasks) and coalesces small ones, with no extra job to count keys."""
    return df.hint("rebalance", *keys)


def write_partitioned_csv(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite",
                          rows_per_part: int = ROWS_PER_PART) -> None:
    """K-3 / K-4: CSV with a header per part file, one folder per partition value; ``overwrite`` replaces only the
    partitions present in ``df`` (a replay is harmless), ``append`` adds parts to them."""
    names = [c for c in df.columns if c not in partition_cols]
    line = F.to_csv(F.struct(*[F.col(quoted_name(c)) for c in names]), CSV_WRITE_OPTIONS)
    heads = F.to_csv(F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(names)]), CSV_WRITE_OPTIONS)
    header = df.sparkSession.range(1).select(heads).first()[0]
    write_partitioned_lines(df.withColumn("_line", line), path, partition_cols, "csv", header, mode, rows_per_part)


def write_partitioned_lines(df: DataFrame, path: str, partition_cols: list[str], suffix: str, header: str | None,
                            mode: str = "overwrite", rows_per_part: int = ROWS_PER_PART) -> None:
    """The texts ``_line`` of each partition value as part files, each with the line ``header`` first (none if None)."""
    lines = df.withColumn("_line", F.coalesce("_line", F.lit("")))
    _write_parts(lines, path, partition_cols, ["_line"], lambda stream, schema: _Lines(stream, header), suffix, mode, rows_per_part)


def _write_parts(df: DataFrame, path: str, partition_cols: list[str], columns: list[str], start: Callable, suffix: str, mode: str,
                 rows_per_part: int = ROWS_PER_PART) -> None:
    """The ``columns`` in part files made by ``start(stream, schema)``, one folder per partition value (named as Spark names them).

    For very many small folders: opening a file costs Spark's own writer several milliseconds and its commit moves one folder after the
    other in the driver. Here tasks write the parts to a hidden folder below ``path``, and further tasks
    move them, one folder a row, so an attempt that failed leaves nothing that readers see. A repeated move ends alike.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    filesystem, root = filesystem_of(base)
    staging = f".staging-{uuid.uuid4().hex}"
    keys = [F.coalesce(F.nullif(F.col(quoted_name(c)).cast("string"), F.lit("")), F.lit(NULL_PARTITION)).alias(f"_k{i}")
            for i, c in enumerate(partition_cols)]
    names = [f"_k{i}" for i in range(len(keys))]
    rows = rebalanced(df.select(*keys, *[F.col(quoted_name(c)) for c in columns]), names).sortWithinPartitions(*names)
    filesystem.create_dir(f"{root}/{staging}", recursive=True)
    try:
        parts = rows.mapInArrow(_stage_parts(f"{base}/{staging}", partition_cols, start, suffix, rows_per_part), "folder string, name string")
        parts.write.parquet(f"{base}/{staging}/_parts")
        staged = spread(spark.read.parquet(f"{base}/{staging}/_parts"), "folder").groupBy("folder").agg(F.collect_list("name").alias("names"))
        staged.mapInPandas(_publish(base, staging, mode == "overwrite"), "n long").agg(F.sum("n")).collect()
    finally:
        filesystem.delete_dir(f"{root}/{staging}")


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def _folder_name(column: str, value: str) -> str:
    """``column=value`` with the characters that Spark escapes in folder names as %XX."""
    return "=".join(_ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", x) for x in (column, value))


class _Lines:
    """A text file of lines (the one column of each batch)."""

    def __init__(self, stream, header: str | None):
        self.stream = stream
        if header is not None:
            stream.write(f"{header}\n".encode())

    def write(self, rows: pa.RecordBatch) -> None:
        self.stream.write(("\n".join(rows.column(0).to_pylist()) + "\n").encode())

    def close(self) -> None:
        self.stream.close()


class _Table:
    """A Parquet file."""

    def __init__(self, stream, schema: pa.Schema):
        self.stream, self.table = stream, pq.ParquetWriter(stream, schema)

    def write(self, rows: pa.RecordBatch) -> None:
        self.table.write_batch(rows)

    def close(self) -> None:
        self.table.close()
        self.stream.close()


def _stage_parts(staging: str, columns: list[str], start: Callable, suffix: str, rows_per_part: int):
    """Write rows that are sorted by folder as part files below ``staging``; (folder, file name) of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = filesystem_of(staging)
        task, n, key, out, left = TaskContext.get(), 0, None, None, 0
        home = f"{task.partitionId()}-{task.taskAttemptId()}"
        filesystem.create_dir(f"{root}/{home}")
        try:
            for batch in batches:
                keys, rows, made = batch.columns[:len(columns)], batch.select(range(len(columns), batch.num_columns)), []
                change = np.zeros(batch.num_rows, bool)
                for k in keys:
                    change[1:] |= pc.not_equal(k.slice(1), k.slice(0, max(0, len(k) - 1))).to_numpy(zero_copy_only=False)
                starts = [0, *np.flatnonzero(change).tolist()] if batch.num_rows else []
                for at, end in zip(starts, [*starts[1:], batch.num_rows]):
                    if key != (key := tuple(k[at].as_py() for k in keys)):
                        left = 0
                    while at < end:
                        if not left:
                            if out:
                                out.close()
                            folder, name = "/".join(map(_folder_name, columns, key)), f"{home}/part-{n:06d}.{suffix}"
                            out, left, n = start(filesystem.open_output_stream(f"{root}/{name}", compression=None), rows.schema), rows_per_part, n + 1
                            made.append((folder, name))
                        some = rows.slice(at, min(left, end - at))
                        out.write(some)
                        at, left = at + some.num_rows, left - some.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], pa.string()) for i in range(2)], ["folder", "name"])
        finally:
            if out:
                out.close()
    return run


def _publish(base: str, staging: str, replace: bool):
    """Move the staged parts into their folders, whose other content goes first if ``replace``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, root = filesystem_of(base)
        for pdf in batches:
            for folder, names in zip(pdf["folder"], pdf["names"]):
                to = f"{root}/{folder}"
                targets = {f"{staging[9:17]}-{name.replace('/', '-')}": name for name in names}
                filesystem.create_dir(to, recursive=True)
                for f in filesystem.get_file_info(fs.FileSelector(to)) if replace else ():
                    if f.base_name not in targets:
                        (filesystem.delete_file if f.is_file else filesystem.delete_dir)(f.path)
                for target, name in targets.items():
                    try:
                        filesystem.move(f"{root}/{staging}/{name}", f"{to}/{target}")
                    except FileNotFoundError:           # an earlier attempt moved it
                        if not filesystem.get_file_info(f"{to}/{target}").is_file:
                            raise
            yield pd.DataFrame({"n": [len(pdf)]})
    return run


def land_csv(files: DataFrame, path: str, rows_per_part: int = ROWS_PER_PART) -> None:
    """K-3: land each ready file's rows under ``<path>/file_type=<landing folder>/file_id=<id>``.
    ``files`` carries ``file_type`` (lower-cased parent folder, X-7) and ``file_id`` (the tag)."""
    write_partitioned_csv(files, path, ["file_type", "file_id"], "overwrite", rows_per_part)


def sheet_output(rows: DataFrame, path: str, mode: str = "overwrite", rows_per_part: int = ROWS_PER_PART) -> None:
    """K-4: one folder per (book, sheet, file_id): two files whose names give one sheet name stay apart.
    ``overwrite`` = clear the sheet and write with header (dynamic partition overwrite touches only these
    sheets); ``append`` = add parts below."""
    write_partitioned_csv(rows, path, ["book", "sheet", "file_id"], mode, rows_per_part)


def replace_load(df: DataFrame, path: str, batch_ts: dt.datetime) -> DataFrame:
    """K-1: stamp ``_inserted_at`` and replace the table. Returns the longest text per column
    (the reference sizes VARCHAR columns from it; A-7), computed in the same job's output."""
    out = df.withColumn("_inserted_at", ntz(batch_ts))
    out.write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    return max_lengths(stored.drop("_inserted_at"))


def ensure_database(spark: SparkSession, database: str) -> None:
    """K-5: create the database if it is not there; a repeated call changes nothing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted_name(database)}")


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_lengths(df: DataFrame) -> dict[str, int]:
    """A-7 as numbers: one aggregate, one row to the driver (a number per column); an empty table has none."""
    if not df.columns:
        return {}
    lengths = df.agg(*[F.max(F.coalesce(F.length(F.col(quoted_name(c)).cast("string")), F.lit(3))).alias(f"_{i}")
                       for i, c in enumerate(df.columns)]).first()
    return {c: lengths[i] for i, c in enumerate(df.columns) if lengths[i] is not None}


def replace_table(df: DataFrame, database: str, table: str, path: str, batch_ts: dt.datetime) -> None:
    """K-1: ``database.table`` gets the rows of ``df``, all columns as text of a declared length (the longest text, A-7; 3 at
    least where a value is missing), and ``_inserted_at``. What it held before is replaced, with its columns.

    The rows are written first, to a folder of their own below ``path``; the table then changes to that folder, so a
    load that fails leaves the old rows in place. Later inserts of longer texts are refused by Spark.
    """
    spark = df.sparkSession
    texts = df.select(*[F.col(quoted_name(c)).cast("string").alias(c) for c in df.columns])
    load = f"{path.rstrip('/')}/load={uuid.uuid4().hex[:12]}"
    texts.withColumn("_inserted_at", ntz(batch_ts)).write.mode("errorifexists").parquet(load)
    stored = spark.read.parquet(load)
    lengths = text_lengths(stored.drop("_inserted_at"))
    columns = ", ".join(f"{quoted_name(c)} VARCHAR({max(1, lengths.get(c, 1))})" for c in texts.columns)
    ensure_database(spark, database)
    name = f"{quoted_name(database)}.{quoted_name(table)}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}, _inserted_at TIMESTAMP_NTZ) USING parquet LOCATION '{load}'")


def max_lengths(df: DataFrame) -> DataFrame:
    """A-7: longest text per column in one pass; a missing value counts as its text form 'nan'
    (3), as ``astype(str)`` prints pandas' NaN in the reference."""
    aggs = [F.max(F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(3))).cast("bigint").alias(c)
            for c in df.columns]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return one.selectExpr(f"stack({len(df.columns)}, {stack}) as (column_name, max_length)")


def append_load(df: DataFrame, path: str, partition_col: str = "file_id") -> None:
    """K-2: append rows of whole files; the table is partitioned by file and written with
    dynamic partition overwrite, so loading a file twice replaces rather than duplicates."""
    columns = [c for c in df.columns if c != partition_col]
    _write_parts(df, path, [partition_col], columns, _Table, "parquet", "overwrite")
