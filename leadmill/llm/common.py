"""Shared column expressions and small helpers of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import work_dir

# A word: a run of characters other than space, \t, \n, \v, \f, \r.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array (null text: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder (``spark.checkpoint.dir``)."""
    work_dir(df.sparkSession)
    return df.checkpoint()


BROADCAST_ROWS = 20_000


def broadcast_checked(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has at most BROADCAST_ROWS rows (of a few short columns each),
    else as it is. ``df`` should be settled: its rows are counted."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df
