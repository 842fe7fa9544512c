"""Load-time shaping (P-2 … P-9): text columns, missing-value markers, batch stamp, alignment to
the stored table's columns. Column lists are metadata; every row operation is one ``select``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import det_uuid, ntz
from ..schemas import CATALOG_NULL_ON_INSERT

# Fixed values (must equal pandas' defaults): texts ``read_csv`` reads as missing.
PANDAS_NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def to_text(df: DataFrame) -> DataFrame:
    """P-2: every column as text; nested values as JSON text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType.typeName()
        cols.append((F.to_json(c) if t in ("struct", "array", "map") else c.cast("string")).alias(f.name))
    return df.select(*cols)


def na_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """CSV ingest: every pandas missing-value text becomes NULL (what ``read_csv`` then
    ``astype(str)`` then ``replace('nan', None)`` leaves in the reference)."""
    cols = set(columns or df.columns)
    return df.select(*[F.when(F.col(f"`{c}`").isin(PANDAS_NA_VALUES), F.lit(None).cast("string"))
                       .otherwise(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """P-3: only the exact text 'nan' becomes NULL ('None', '<NA>', 'NaT' stay text)."""
    cols = set(columns or df.columns)
    return df.select(*[F.when(F.col(f"`{c}`") == "nan", F.lit(None).cast("string")).otherwise(F.col(f"`{c}`")).alias(c)
                       if c in cols else F.col(f"`{c}`") for c in df.columns])


def stamp(df: DataFrame, batch_ts: dt.datetime, column: str = "created_at") -> DataFrame:
    """P-4: one timestamp literal for the whole batch (all rows of a batch tie)."""
    return df.withColumn(column, ntz(batch_ts))


def align_intersect(df: DataFrame, target: list[str]) -> DataFrame:
    """P-5: keep only columns the target also has, in target order (others are left out and
    stay NULL in the table)."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in target if c in have])


def align_fill(df: DataFrame, target: list[str], fill: str | None = "") -> DataFrame:
    """P-6: target columns in target order; missing ones as ``fill`` ('' as in the reference,
    so a file without an e-mail column yields '' which passes ``IS NOT NULL``, Q4); extras dropped."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(fill).cast("string").alias(c) for c in target])


def catalog_insert_shape(df: DataFrame) -> DataFrame:
    """P-7: the six catalog columns are removed before insert, so they are NULL, not ''."""
    return df.withColumns({c: F.lit(None).cast("boolean" if c.startswith("has_") else "string")
                           for c in CATALOG_NULL_ON_INSERT})


def row_uuid(df: DataFrame, file_col: str, data_columns: list[str]) -> DataFrame:
    """X-14 for raw rows: uuid from the file and the row's content. Of identical rows of one file, the
    second and later ones are numbered, so every row has a key of its own."""
    keyed = df.withColumn("uuid", det_uuid(F.col(file_col), *[F.col(f"`{c}`") for c in data_columns]))
    nth = F.row_number().over(Window.partitionBy("uuid").orderBy(F.lit(0)))
    return keyed.withColumn("_nth", nth).withColumn(
        "uuid", F.when(F.col("_nth") == 1, F.col("uuid")).otherwise(det_uuid(F.lit("repeat"), F.col("uuid"), F.col("_nth")))).drop("_nth")
