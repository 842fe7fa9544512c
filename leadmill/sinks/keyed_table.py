"""Tables that change by key, kept in hash buckets, so that a run reads and writes only the buckets of its keys.

Layout: ``<path>/base=<run>-<buckets>/run=<n>/bucket=<k>/``. A run writes whole buckets, under its own number; the newest
version of a bucket up to a run is its content then (``append=True``: all versions up to the run are). Nothing that
an earlier run wrote is changed, so a run that is repeated replaces only its own output, and a run without
``_SUCCESS`` is not seen. Bucket numbers come from a hash of the key column.

The number of buckets follows the size: once buckets hold more than ``2 * TARGET_BYTES`` on average, ``settle_size`` writes a new
base with as many buckets as give ``TARGET_BYTES`` each. So a run with m keys reads at most m buckets of a bounded size,
whatever the history. The driver holds bucket numbers and folder names, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TARGET_BYTES = 64 << 20
ROWS_PER_BUCKET = 500_000
LEAST_BUCKETS = 4


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: str | Column, append: bool = False):
        self.spark, self.path, self.append = spark, path.rstrip("/"), append
        self.key = F.col(key) if isinstance(key, str) else key

    # ---- folders ----

    def _glob(self, pattern: str) -> list:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        return [s.getPath() for s in p.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(p) or []]

    def _bases(self) -> list[tuple[int, int, str]]:
        """(first run, buckets, folder) of the complete bases, in order of runs."""
        out = []
        for p in self._glob("base=*/run=*/_SUCCESS"):
            run, base = p.getParent(), p.getParent().getParent()
            first, buckets = base.getName()[5:].rsplit("-", 1)
            if int(run.getName()[4:]) == int(first):
                out.append((int(first), int(buckets), base.getName()))
        return sorted(out)

    def _base(self, run: int) -> tuple[int, int, str]:
        got = [b for b in self._bases() if b[0] <= run]
        if not got:
            raise FileNotFoundError(f"{self.path} has no version up to run {run}")
        return got[-1]

    def exists(self) -> bool:
        return bool(self._bases())

    def _versions(self, base: str, run: int) -> dict[int, list[int]]:
        """The runs whose folders make up each bucket's content after ``run``."""
        done = {int(p.getParent().getName()[4:]) for p in self._glob(f"{base}/run=*/_SUCCESS")}
        found: dict[int, list[int]] = {}
        for p in self._glob(f"{base}/run=*/bucket=*"):
            n, k = int(p.getParent().getName()[4:]), int(p.getName()[7:])
            if n <= run and n in done:
                found.setdefault(k, []).append(n)
        return {k: sorted(v) if self.append else [max(v)] for k, v in found.items()}

    # ---- rows ----

    def _bucket(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def create(self, df: DataFrame, run: int = -1) -> "KeyedTable":
        """The first version of the table."""
        self._write_base(df, run, max(LEAST_BUCKETS, -(-df.count() // ROWS_PER_BUCKET)))
        return self

    def _write_base(self, df: DataFrame, run: int, buckets: int) -> None:
        df.limit(0).write.mode("overwrite").parquet(f"{self.path}/base={run}-{buckets}/schema")
        self._write(df, f"base={run}-{buckets}", run, buckets)

    def _write(self, df: DataFrame, base: str, run: int, buckets: int) -> None:
        (df.withColumn("bucket", self._bucket(self.key, buckets)).hint("rebalance", "bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.path}/{base}/run={run}"))

    def _read(self, base: str, folders: list[tuple[int, int]]) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/{base}/schema").schema
        paths = [f"{self.path}/{base}/run={n}/bucket={k}" for n, k in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _content(self, base: str, run: int, buckets: list[int] | None) -> DataFrame:
        return self._read(base, [(n, k) for k, runs in sorted(self._versions(base, run).items())
                                 if buckets is None or k in set(buckets) for n in runs])

    def read(self, run: int, buckets: list[int] | None = None) -> DataFrame:
        """The table after ``run`` for readers from outside."""
        return self._content(self._base(run)[2], run, buckets)

    # A run reads and writes under the base that was newest before it, also when it is repeated after a new base was made.

    def buckets_of(self, keys: DataFrame, key: str | Column, run: int) -> list[int]:
        """For run ``run``: the buckets that hold the given keys (at most as many numbers as there are buckets)."""
        n = self._base(run - 1)[1]
        column = F.col(key) if isinstance(key, str) else key
        return sorted(r[0] for r in keys.select(self._bucket(column, n)).distinct().collect())

    def before(self, run: int, buckets: list[int] | None = None) -> DataFrame:
        """For run ``run``: the table as the runs before left it, whole or the given buckets of it."""
        return self._content(self._base(run - 1)[2], run - 1, buckets)

    def after(self, run: int, buckets: list[int] | None = None) -> DataFrame:
        """For run ``run``: the table with what it has written."""
        return self._content(self._base(run - 1)[2], run, buckets)

    def write(self, df: DataFrame, run: int) -> None:
        """Rows of whole buckets (``append=True``: new rows) as the version of ``run``."""
        _, buckets, base = self._base(run - 1)
        self._write(df, base, run, buckets)

    def written(self, run: int) -> DataFrame:
        """What ``run`` itself wrote."""
        base = self._base(run - 1)[2]
        return self._read(base, [(run, k) for k, runs in sorted(self._versions(base, run).items()) if run in runs])

    def settle_size(self, run: int) -> bool:
        """Writes a new base if the buckets have outgrown their size; later runs use it. Costs one rewrite for each
        doubling of the table."""
        _, buckets, base = self._base(run - 1)
        fs = self.spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        size = sum(fs.getContentSummary(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{base}/run={n}/bucket={k}")).getLength()
                   for k, runs in self._versions(base, run).items() for n in runs)
        if size <= 2 * TARGET_BYTES * buckets:
            return False
        self._write_base(self.after(run), run, -(-size // TARGET_BYTES))
        return True
