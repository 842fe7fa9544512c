"""File-catalog (``drive_metadata``) operators: new files (J-1), catalog append (P-7/K-2), file
types (P-15, U-2), config (U-1), notices (F-1, D-1), readiness (F-2, F-3, F-6), flags (D-2, D-3),
lookups (F-7). Row changes are pure functions ``old snapshot -> new snapshot``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import (FILE_TYPE_VALUES, det_uuid, file_type_from_folder, in_enum, ntz,
                                parent_from_text, xlsx_to_csv)
from .joins import anti, semi

# Fixed values (must equal the reference's): catalog columns left out of the listing insert, so
# they stay NULL rather than ''.
CONFIG_COLUMNS = ["filename", "hubspot_owner", "zi_search"]
CITY_SEARCH = "city_search"


def new_files(listing: DataFrame, catalog: DataFrame, key: str = "id") -> DataFrame:
    """J-1: listing rows whose id the catalog does not hold (re-modified known files are not new)."""
    return anti(listing, catalog.select(F.col(key).alias("_known")), F.col(key) == F.col("_known"))


def missing_config(catalog: DataFrame) -> DataFrame:
    """F-1: no config, not yet notified, and a type other than city_search. A NULL type fails
    ``NOT IN`` (three-valued logic), so untyped files are not reported."""
    return catalog.where(F.col("config_file_uuid").isNull() & F.col("has_posted_on_slack").isNull()
                         & ~F.col("file_type").isin(CITY_SEARCH))


def mark_posted(catalog: DataFrame) -> DataFrame:
    """D-1: every row without config and without flag gets the flag — wider than F-1 (no type
    test), as in the reference (Q8)."""
    hit = F.col("config_file_uuid").isNull() & F.col("has_posted_on_slack").isNull()
    return catalog.withColumn("has_posted_on_slack", F.when(hit, F.lit(True)).otherwise(F.col("has_posted_on_slack")))


def ready_files(catalog: DataFrame, ids: DataFrame | None = None, id_col: str = "id") -> DataFrame:
    """F-2: files with a config or of type city_search (which needs none).

    ``ids`` given: only those ids (the reference passes the ids first seen in this run,
    ``scope='new'``). ``ids=None``: every ready file not yet processed (``scope='pending'``, Q7).
    """
    ok = catalog.where(F.col("config_file_uuid").isNotNull() | (F.col("file_type") == CITY_SEARCH))
    if ids is None:
        return unprocessed_files(ok)
    return semi(ok, ids.select(F.col(id_col).alias("_id")), F.col("id") == F.col("_id"))


def typed_files(catalog: DataFrame) -> DataFrame:
    """F-3: rows with a file type."""
    return catalog.where(F.col("file_type").isNotNull())


def unprocessed_files(catalog: DataFrame) -> DataFrame:
    """F-6 negated: processed only when the flag is true; NULL counts as not processed."""
    return catalog.where(~F.coalesce(F.col("has_been_processed"), F.lit(False)))


def mark_processed(catalog: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """D-2: flag the given file ids as processed (in streams the checkpoint is the real gate)."""
    hit = ids.select(F.col(id_col).alias("_pid"), F.lit(True).alias("_hit")).dropDuplicates(["_pid"])
    out = catalog.join(hit, catalog["id"] == hit["_pid"], "left")
    return out.withColumn("has_been_processed", F.when(F.col("_hit"), F.lit(True)).otherwise(F.col("has_been_processed"))) \
              .drop("_pid", "_hit")


def rename_ext(catalog: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """D-3: every 'xlsx' in the name becomes 'csv' for the given names (all names when None)."""
    if names is None:
        return catalog.withColumn("name", xlsx_to_csv(F.col("name")))
    hit = names.select(F.col("name").alias("_n"), F.lit(True).alias("_hit")).dropDuplicates(["_n"])
    out = catalog.join(hit, catalog["name"] == hit["_n"], "left")
    return out.withColumn("name", F.when(F.col("_hit"), xlsx_to_csv(F.col("name"))).otherwise(F.col("name"))) \
              .drop("_n", "_hit")


def uuid_by_id(catalog: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """F-7: file uuid for each id; the reference takes the first row, here the smallest uuid."""
    m = catalog.groupBy(F.col("id").alias("_id")).agg(F.min("uuid").alias("uuid"))
    return ids.select(F.col(id_col).alias("id")).join(m, F.col("id") == F.col("_id"), "inner").drop("_id")


def derive_file_types(catalog: DataFrame, folders: DataFrame, apply_alias: bool = True) -> DataFrame:
    """P-15: for untyped files, the parent folder's name (parent id from the text list, X-5),
    normalised by X-6. Returns (uuid, file_type); files whose parent is unknown drop out."""
    miss = catalog.where(F.col("file_type").isNull()).select("uuid", parent_from_text(F.col("parents")).alias("_parent"))
    f = folders.select(F.col("id").alias("_fid"), F.col("name").alias("_fname"))
    out = miss.join(f, F.col("_parent") == F.col("_fid"), "inner")
    return out.select("uuid", file_type_from_folder(F.col("_fname"), apply_alias).alias("file_type"))


def split_enum(df: DataFrame, col: str, values) -> tuple[DataFrame, DataFrame]:
    """V-1 as quarantine: (rows whose ``col`` is a valid enum value, rows that are not)."""
    ok = in_enum(F.col(col), values)
    return df.where(ok), df.where(~ok | F.col(col).isNull())


def enforce_enum(df: DataFrame, col: str, values) -> DataFrame:
    """V-1 as a hard check: an invalid value fails the job (``raise_error`` inside the plan)."""
    bad = F.col(col).isNotNull() & ~in_enum(F.col(col), values)
    msg = F.concat(F.lit(f"invalid {col}: "), F.col(col))
    return df.withColumn(col, F.when(bad, F.raise_error(msg).cast("string")).otherwise(F.col(col)))


def apply_file_types(catalog: DataFrame, derived: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    """U-2: set ``file_type`` (and ``updated_at``) where it is NULL, from valid derived types.
    Invalid types are not applied (see ``split_enum`` for the quarantine side)."""
    valid, _ = split_enum(derived, "file_type", FILE_TYPE_VALUES)
    d = valid.groupBy(F.col("uuid").alias("_u")).agg(F.min("file_type").alias("_t"), F.max("file_type").alias("_t2"))
    out = catalog.join(d, catalog["uuid"] == d["_u"], "left")
    hit = F.col("file_type").isNull() & F.col("_t").isNotNull()
    refused = F.raise_error(F.concat(F.lit("two types for one file: "), F.col("_u")))       # V-2
    hit = F.when(hit & (F.col("_t") != F.col("_t2")), refused.cast("boolean")).otherwise(hit)
    out = out.withColumn("file_type", F.when(hit, F.col("_t")).otherwise(F.col("file_type")))
    if "updated_at" in catalog.columns:
        out = out.withColumn("updated_at", F.when(hit, ntz(batch_ts)).otherwise(F.col("updated_at")))
    return out.drop("_u", "_t", "_t2")


def checked_config(config: DataFrame) -> DataFrame:
    """K-7 + V-2 for the config sheet: columns renamed by position (filename, owner, search), one
    row per file name (the smallest owner/search), with ``_n`` = how many rows named the file."""
    c = config.toDF(*CONFIG_COLUMNS) if len(config.columns) == 3 else config.select(*CONFIG_COLUMNS)
    least = F.min(F.struct(F.col("hubspot_owner").isNull(), "hubspot_owner", F.col("zi_search").isNull(), "zi_search"))
    return c.groupBy("filename").agg(least.alias("_m"), F.count(F.lit(1)).alias("_n")).select(
        "filename", "_m.hubspot_owner", "_m.zi_search", "_n")


def apply_config(catalog: DataFrame, config: DataFrame, batch_ts: dt.datetime, on_duplicate: str = "error") -> DataFrame:
    """U-1: files without config whose name is in the config sheet get a new config uuid, the
    owner and search texts and ``updated_at``; nothing is inserted. An empty sheet changes nothing.

    A name listed twice that matches an unconfigured file is refused, as Postgres refuses to
    update a row twice (``on_duplicate='error'``, the job fails); ``'first'`` applies the first
    row instead. Repeated names that change nothing are ignored, and no catalog row is repeated.
    """
    if on_duplicate not in ("error", "first"):
        raise ValueError(on_duplicate)
    c = checked_config(config).select(F.col("filename").alias("_fn"), F.col("hubspot_owner").alias("_ho"),
                                      F.col("zi_search").alias("_zs"), "_n")
    out = catalog.join(c, catalog["name"] == c["_fn"], "left")
    hit = F.col("config_file_uuid").isNull() & F.col("_fn").isNotNull()
    if on_duplicate == "error":
        refused = F.raise_error(F.concat(F.lit("config names a file twice: "), F.col("_fn")))
        hit = F.when(hit & (F.col("_n") > 1), refused.cast("boolean")).otherwise(hit)
    new_uuid = det_uuid(F.lit("config"), F.col("uuid"), F.col("_fn"))
    cols = {
        "config_file_uuid": F.when(hit, new_uuid).otherwise(F.col("config_file_uuid")),
        "hubspot_owner": F.when(hit, F.col("_ho")).otherwise(F.col("hubspot_owner")),
        "zi_search": F.when(hit, F.col("_zs")).otherwise(F.col("zi_search")),
    }
    if "updated_at" in catalog.columns:
        cols["updated_at"] = F.when(hit, ntz(batch_ts)).otherwise(F.col("updated_at"))
    return out.withColumns(cols).drop("_fn", "_ho", "_zs", "_n")
