"""Constraint checks (V-1 … V-3) as DataFrames: counts or quarantine rows, or an in-plan error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import anti


def fk_orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, table: str) -> DataFrame:
    """V-3: count of child rows whose non-NULL key has no parent row (left anti join)."""
    p = parent.select(F.col(parent_key).alias("_pk"))
    bad = anti(child.where(F.col(key).isNotNull()), p, F.col(key) == F.col("_pk"))
    return bad.agg(F.count(F.lit(1)).alias("n_bad")).select(
        F.lit(table).alias("table_name"), F.lit(key).alias("check_name"), "n_bad")


def fk_orphan_rows(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """V-3 as quarantine: the orphan rows themselves."""
    p = parent.select(F.col(parent_key).alias("_pk"))
    return anti(child.where(F.col(key).isNotNull()), p, F.col(key) == F.col("_pk"))


def null_count(df: DataFrame, column: str, table: str) -> DataFrame:
    """V-3 NOT NULL: rows where the column is NULL."""
    return df.agg(F.count(F.when(F.col(column).isNull(), 1)).alias("n_bad")).select(
        F.lit(table).alias("table_name"), F.lit(f"{column} not null").alias("check_name"), "n_bad")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """V-2: key values held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
