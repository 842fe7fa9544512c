"""Franchise master list: keep-first de-duplication (A-4) and the keyed upsert (J-14, U-3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import det_uuid, ntz

FRANCHISE_COLUMNS = ["franchise_name", "domain_name"]


def keep_first(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """A-4: first row per ``key`` in source order (``order_col`` = row position). NULL keys form
    one group, as pandas ``drop_duplicates`` treats them. ``dropDuplicates`` gives no order."""
    w = Window.partitionBy(key).orderBy(F.col(order_col).asc_nulls_last())
    return df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") == 1).drop("_rk")


def upsert_franchises(target: DataFrame, source: DataFrame, batch_ts: dt.datetime, order_col: str = "row_no") -> DataFrame:
    """U-3: source columns renamed by position, de-duplicated by domain (A-4), matched to the
    target on (name, domain) (J-14). Matched target rows get ``updated_at``; unmatched source
    rows are inserted with a generated uuid and ``created_at``. NULL keys never match, so such
    rows are inserted again on every run, as in the reference."""
    src_cols = [c for c in source.columns if c != order_col]
    src = source.select(*[F.col(c).alias(n) for c, n in zip(src_cols, FRANCHISE_COLUMNS)], order_col)
    src = keep_first(src, "domain_name", order_col)
    ts = ntz(batch_ts)
    keys = src.select(F.col("franchise_name").alias("_sn"), F.col("domain_name").alias("_sd"), F.lit(True).alias("_hit")) \
              .dropDuplicates(["_sn", "_sd"])
    t = target.join(keys, (target["franchise_name"] == keys["_sn"]) & (target["domain_name"] == keys["_sd"]), "left")
    updated = t.withColumn("updated_at", F.when(F.col("_hit"), ts).otherwise(F.col("updated_at"))).drop("_sn", "_sd", "_hit")
    tk = target.select(F.col("franchise_name").alias("_tn"), F.col("domain_name").alias("_td"))
    new = src.join(tk, (src["franchise_name"] == tk["_tn"]) & (src["domain_name"] == tk["_td"]), "left_anti")
    inserted = new.select(det_uuid(F.lit("franchise"), F.col(order_col), F.col("franchise_name"), F.col("domain_name")).alias("uuid"),
                          "franchise_name", "domain_name", ts.alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    return updated.select("uuid", "franchise_name", "domain_name", "created_at", "updated_at").unionByName(inserted)
