"""Write a k-times larger copy of a test-data folder for scaling runs (Spark job, no driver data).

Every keyed table is repeated k times with its keys shifted per copy (orders, customer, supplier,
pages), so joins, files and e-mails grow k-fold; nation and region are copied as they are.
Usage: python tools/replicate.py <src_sf_dir> <dst_dir> <k>
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from leadmill.session import build_session  # noqa: E402

KEYS = {"orders": ["o_orderkey", "o_custkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "pages": ["page_id"]}
PLAIN = ["nation", "region"]


def main() -> None:
    src, dst, k = sys.argv[1].rstrip("/"), sys.argv[2].rstrip("/"), int(sys.argv[3])
    spark = build_session("local[8]", 8)
    spans = {}
    for t, cols in KEYS.items():
        df = spark.read.parquet(f"{src}/{t}.parquet")
        span = {c: df.agg(F.max(c)).first()[0] + 1 for c in cols}
        spans[t] = span
        # customer keys must shift like orders.o_custkey, so both use the customer span
    cust_span = spans["customer"]["c_custkey"]
    for t, cols in KEYS.items():
        df = spark.read.parquet(f"{src}/{t}.parquet")
        rep = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        for c in cols:
            span = cust_span if c == "o_custkey" else spans[t][c]
            rep = rep.withColumn(c, F.col(c) + F.col("_copy") * F.lit(span))
        if t == "supplier":   # file names stay unique (the config sheet is keyed by name)
            rep = rep.withColumn("s_name", F.when(F.col("_copy") == 0, F.col("s_name"))
                                 .otherwise(F.concat(F.col("s_name"), F.lit("-c"), F.col("_copy").cast("string"))))
        if t == "pages":   # distinct hosts per copy, so franchise domains grow too
            rep = rep.withColumn("url", F.regexp_replace("url", r"\.example\.", F.concat(F.lit(".c"), F.col("_copy").cast("string"), F.lit(".example."))))
        rep.drop("_copy").write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
    for t in PLAIN:
        spark.read.parquet(f"{src}/{t}.parquet").write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
