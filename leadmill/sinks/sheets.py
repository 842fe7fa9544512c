"""K-4: spreadsheets as a table of numbered rows, replaced or appended to, run by run.

Layout: ``<path>/rows/run=<n>`` (book, sheet, row_no, cells) and ``<path>/tops/run=<n>`` (book, sheet, first, top), the numbers of the
first and last row that run n wrote in a sheet. The tops are written last and publish the run; a run that is repeated
replaces its own two folders. A run that starts a sheet again (``first`` = 1) hides all rows of earlier runs, so a
shorter replacement leaves no old row. An append reads the tops only, never old rows.

Rows are numbered inside each sheet without gathering a sheet in one task: they are sorted by ranges over the cluster and
numbered in each range, and each range starts after the counts of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir
from ..streaming.file_stream import folder_numbers

KEYS = ["book", "sheet"]
ROWS_SCHEMA = "book string, sheet string, row_no bigint, cells array<string>"
TOPS_SCHEMA = "book string, sheet string, first bigint, top bigint"


def numbered(df: DataFrame, group: list[str], order: list[str], name: str = "row_no") -> DataFrame:
    """``df`` with the numbers 1, 2, … of its rows in each ``group`` by ``order`` (rows equal in it come in any order).

    The ranges come from samples, so they are checkpointed: a lost task must not sort them anew. The window runs over one count per
    range and group."""
    work_dir(df.sparkSession)
    keys = [F.col(f"`{c}`") for c in [*group, *order]]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys) \
        .withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    counts = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_range").alias("_r"), "_first", "_before")
    on = F.col("_range") == F.col("_r")
    for i, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out = ranged.join(starts, on).withColumn(name, F.col("_at") - F.col("_first") + F.col("_before") + 1)
    return out.drop("_range", "_at", "_r", "_first", "_before", *[f"_g{i}" for i in range(len(group))])


class Sheets:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folders(self, kind: str, runs: list[int], schema: str) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], f"{schema}, run int")
        read = self.spark.read.option("basePath", f"{self.path}/{kind}").schema(f"{schema}, run int")
        return read.parquet(*[f"{self.path}/{kind}/run={n}" for n in runs])

    def _runs(self, upto: int) -> list[int]:
        return [n for n in folder_numbers(self.spark, f"{self.path}/tops", "run", complete=True) if n <= upto]

    def write(self, rows: DataFrame, columns: list[str], order: list[str], run: int, replace: Column | bool = True,
              targets: DataFrame | None = None) -> None:
        """Write the ``rows`` (book, sheet, ``columns``, ``order``) of run ``run``, numbered, in the order of ``order``.

        ``replace`` (one value per sheet; a column of book and sheet, or a flag for all): the sheet is cleared and starts with a
        header row of ``columns``. Else the rows go below the sheet's last row, with a header only in a new or empty
        sheet; cells go by position, so a sheet with other columns keeps its header. NULLs are empty
        cells. ``targets`` (book, sheet) names sheets to be written even without rows (replaced: the header alone).
        """
        cells = F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]).alias("cells")
        sort = [F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)]
        body = numbered(rows.select(*KEYS, cells, *sort), KEYS, [f"_o{i}" for i in range(len(order))], "_i")
        sizes = body.groupBy(*KEYS).agg(F.max("_i").alias("_n"))
        if targets is not None:
            sizes = sizes.unionByName(targets.select(*KEYS).distinct().withColumn("_n", F.lit(0).cast("bigint"))) \
                .groupBy(*KEYS).agg(F.max("_n").alias("_n"))
        old = self._folders("tops", self._runs(run - 1), TOPS_SCHEMA).groupBy(*[F.col(c).alias(f"_{c}") for c in KEYS]).agg(
            F.max_by("top", "run").alias("_top"))
        same = F.col("book").eqNullSafe(F.col("_book")) & F.col("sheet").eqNullSafe(F.col("_sheet"))
        clear = replace if isinstance(replace, Column) else F.lit(replace)
        plan = sizes.join(old, same, "left").withColumn("_top", F.when(clear, F.lit(0)).otherwise(F.coalesce("_top", F.lit(0))))
        plan = plan.withColumn("_head", (F.col("_top") == 0).cast("bigint")).select(*KEYS, "_n", "_top", "_head").checkpoint()
        at = plan.select(*[F.col(c).alias(f"_{c}") for c in KEYS], "_top", "_head")
        data = body.join(at, same).select(*KEYS, (F.col("_top") + F.col("_head") + F.col("_i")).alias("row_no"), "cells")
        heads = plan.where(F.col("_head") == 1).select(*KEYS, F.lit(1).cast("bigint").alias("row_no"),
                                                       F.array(*map(F.lit, columns)).alias("cells"))
        data.unionByName(heads).hint("rebalance", *KEYS).sortWithinPartitions(*KEYS, "row_no") \
            .write.mode("overwrite").parquet(f"{self.path}/rows/run={run}")
        tops = plan.select(*KEYS, (F.col("_top") + 1).alias("first"), (F.col("_top") + F.col("_head") + F.col("_n")).alias("top"))
        tops.write.mode("overwrite").parquet(f"{self.path}/tops/run={run}")

    def read(self, run: int) -> DataFrame:
        """(book, sheet, row_no, cells) of all sheets after run ``run``."""
        runs = self._runs(run)
        starts = self._folders("tops", runs, TOPS_SCHEMA).where(F.col("first") == 1).groupBy(
            *[F.col(c).alias(f"_{c}") for c in KEYS]).agg(F.max("run").alias("_start"))
        same = F.col("book").eqNullSafe(F.col("_book")) & F.col("sheet").eqNullSafe(F.col("_sheet"))
        rows = self._folders("rows", runs, ROWS_SCHEMA).join(starts, same & (F.col("run") >= F.col("_start")))
        return rows.select(*KEYS, "row_no", "cells")
