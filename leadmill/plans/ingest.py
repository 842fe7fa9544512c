"""Ingest lead files (S-6/S-7 + P-1 … P-8 + K-2 shape): every file below a landing root, grouped
by header, cleaned, aligned to the stored table and stamped with its catalog uuid."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import landing_folder
from ..operators.align import align_fill, align_intersect, row_uuid, stamp
from ..sinks.writers import land_csv
from ..schemas import insert_columns
from ..sources.files import empty_files, list_files, read_checked


def file_uuids(catalog: DataFrame) -> DataFrame:
    """F-7: catalog uuid per file id (the smallest if an id repeats)."""
    return catalog.groupBy(F.col("id").alias("file_id")).agg(F.min("uuid").alias("drive_metadata_uuid"))


def ingest(spark: SparkSession, root: str | None, catalog: DataFrame, table: str, batch_ts: dt.datetime, **options) -> DataFrame:
    """The rows of ``ingest_checked`` alone."""
    return ingest_checked(spark, root, catalog, table, batch_ts, **options)[0]


def ingest_checked(spark: SparkSession, root: str | None, catalog: DataFrame, table: str, batch_ts: dt.datetime,
                   columns: list[str] | None = None, files: DataFrame | None = None,
                   required: list[str] | None = None, fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine): raw rows of every file below ``root`` in the shape of ``table``, and what is not among them.

    ``columns=None``: P-6 (all target columns, missing ones as ''); a list: P-5 (only the
    columns both sides have, the rest NULL). A ``drive_metadata_uuid`` column in a file is
    dropped and replaced by the catalog's (P-8).
    Every row gets ``created_at`` = ``batch_ts`` (P-4) and a content uuid (X-14).
    ``required``: columns every file must have after cleaning (P-12's strict selection).
    ``fmt='xlsx'``: the files are workbooks (S-8), read with ``sources.xlsx``.

    ``quarantine`` (path, file_id, reason, record): ragged records and files without a header (``files.read_checked``,
    ``xlsx.refused_rows``),
    and files whose id the catalog does not know (one row each).
    """
    glob = "*.csv" if fmt == "csv" else "*.xlsx"
    no_bytes = empty_files(spark, root, glob) if files is None else None
    files = files if files is not None else list_files(spark, root, glob)
    if fmt == "xlsx":
        from ..sources.xlsx import read_rows, refused_rows, rows_by_header
        cells = read_rows(spark, root)
        groups, bad = rows_by_header(spark, cells), refused_rows(cells)
    else:
        groups, bad = read_checked(spark, files)
    known = file_uuids(catalog)
    strange = files.select("path", "file_id").join(known.select("file_id"), "file_id", "left_anti").select(
        "path", "file_id", F.lit("file unknown to the catalog").alias("reason"), F.lit(None).cast("string").alias("record"))
    bad = strange if bad is None else bad.join(strange.select("path"), "path", "left_anti").unionByName(strange)
    if no_bytes is not None:
        bad = bad.unionByName(no_bytes.select("path", "file_id", F.lit("file without a header").alias("reason"), F.lit(None).cast("string").alias("record")))
    target = [c for c in insert_columns(table) if c not in ("drive_metadata_uuid", "created_at")]
    parts = []
    for g in groups:
        g = g.drop("drive_metadata_uuid", "path")
        if required:
            enriched_select(g, required)
        if columns is None:
            parts.append(align_fill(g, target + ["file_id"]))
        else:
            keep = align_intersect(g, [c for c in columns if c in target] + ["file_id"])
            parts.append(align_fill(keep, target + ["file_id"], fill=None))
    if not parts:
        schema = ", ".join(f"`{c}` string" for c in ["uuid", "drive_metadata_uuid", *target])
        return spark.createDataFrame([], schema + ", created_at timestamp_ntz, file_id string"), bad
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.join(known, "file_id", "inner")         # rows of unknown files: see ``strange``
    rows = stamp(rows, batch_ts)
    rows = row_uuid(rows, "drive_metadata_uuid", target)
    return rows.select("uuid", "drive_metadata_uuid", *target, "created_at", "file_id"), bad


def enriched_select(df: DataFrame, columns: list[str]) -> DataFrame:
    """P-12: strict selection of the enriched columns (a missing one is an error, as in pandas)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not in file: {missing}")
    return df.select(*columns)


def land_files(spark: SparkSession, files: DataFrame, catalog: DataFrame, nodes: DataFrame, landing: str,
               workbooks: str | None = None, quarantine: str | None = None) -> str:
    """S-6 + K-3 for many files at once: CSV files and (``workbooks``) XLSX files are read by
    their kind, each file's rows keep their own header, a stray ``drive_metadata_uuid`` is
    replaced by the catalog's (P-8), and rows land as CSV under
    ``file_type=<parent folder, X-7>/file_id=<id>``. What is refused of the catalog's files (``files.read_checked``,
    ``xlsx.refused_rows``) goes to ``quarantine`` if it is given. Returns ``landing``."""
    from ..operators.listing import parent_names
    folder = parent_names(nodes).select(F.col("id").alias("file_id"), landing_folder(F.col("parent_name")).alias("file_type"))
    groups, bad = read_checked(spark, files, clean=False)
    if workbooks:
        from ..sources.xlsx import read_rows, refused_rows, rows_by_header
        cells = read_rows(spark, workbooks)
        groups += rows_by_header(spark, cells, clean=False)
        bad = bad.unionByName(refused_rows(cells))
    if quarantine:
        bad.join(file_uuids(catalog).select("file_id"), "file_id", "left_semi").write.mode("overwrite").parquet(quarantine)
    for g in groups:
        g = g.drop("drive_metadata_uuid", "path").join(file_uuids(catalog), "file_id", "inner").join(folder, "file_id", "inner")
        land_csv(g, landing)
    return landing
