"""R-2 … R-5: new-file triggers as Structured Streaming file sources.

A stream watches a landing folder with the ``binaryFile`` source, selecting only ``path`` (no
file content is read by the stream). Micro-batches record the paths via ``foreachBatch``; afterwards all
new files are processed in one set-based job. Recorded runs tell which files were handled, so a
restart never handles a file twice (R-5); handlers write only outputs keyed by the run (overwrite of
``snapshot=<run>`` folders, dynamic partition overwrite), so a repeated run replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from ..sinks.archive import move_processed, not_processed
from ..sources.files import FILE_ID_PATTERN

BINARY_SCHEMA = StructType([StructField("path", StringType()), StructField("modificationTime", TimestampType()),
                            StructField("length", LongType()), StructField("content", BinaryType())])


def file_stream(spark: SparkSession, folder: str, glob: str = "*.csv", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of (path, file_id) for files arriving below ``folder``, outside its ``Processed`` folders."""
    r = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("pathGlobFilter", glob)
         .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = r.load(folder).where(not_processed(F.col("path")))
    return src.select("path", F.regexp_extract("path", FILE_ID_PATTERN, 1).alias("file_id"))


MAX_FILES_PER_TRIGGER = 10_000


def run_available(spark: SparkSession, folder: str, checkpoint: str,
                  handler: Callable[[DataFrame, int], None], archive: bool = False, **source_options) -> int:
    """Process every file present now and stop; an outside scheduler runs this on the reference's timer.

    Two phases, so that the result does not depend on how files fall into micro-batches. First the stream
    (``trigger(availableNow=True)``, at most ``max_files_per_trigger`` files a batch) only records the paths
    that arrived. Then one call of ``handler(files, run)`` gets all files that no earlier run has handled,
    so all part files of a file id come together. A run that fails is repeated under the same number by
    the next call, on the files recorded so far. Returns the number of runs handled (0 or 1).

    ``archive`` (K-6): the files of handled runs move to ``Processed`` beside them, after the run is marked as handled; a
    move that did not end is ended by the next call. The outcomes are in ``<checkpoint>_files/archived/run=<n>``.
    """
    source_options.setdefault("max_files_per_trigger", MAX_FILES_PER_TRIGGER)
    base = checkpoint.rstrip("/") + "_files"
    arrived, handled = f"{base}/arrived", f"{base}/handled"

    def record(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{arrived}/batch={batch_id}")

    q = (file_stream(spark, folder, **source_options).writeStream.foreachBatch(record)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    batches = folder_numbers(spark, arrived, "batch")
    runs = folder_numbers(spark, handled, "run", complete=True)
    if archive:
        _archive(spark, base, runs)
    # a handled run names the last micro-batch that it took; earlier ones are never read again
    last = spark.read.parquet(f"{handled}/run={runs[-1]}").first()[0] if runs else -1
    new = [b for b in batches if b > last]
    if not new:
        return 0
    files = spark.read.parquet(*[f"{arrived}/batch={b}" for b in new]).select("path", "file_id").distinct()
    if files.isEmpty():
        return 0
    run = runs[-1] + 1 if runs else 0
    handler(files, run)
    spark.createDataFrame([(new[-1],)], "last_batch long").write.mode("overwrite").parquet(f"{handled}/run={run}")
    if archive:
        _archive(spark, base, runs + [run])
    return 1


def _archive(spark: SparkSession, base: str, runs: list[int]) -> None:
    """Move the files of the handled ``runs`` that have not been moved."""
    done = set(folder_numbers(spark, f"{base}/archived", "run", complete=True))
    todo = [i for i, n in enumerate(runs) if n not in done]
    if not todo:
        return
    batches = folder_numbers(spark, f"{base}/arrived", "batch")

    def last(i: int) -> int:
        return spark.read.parquet(f"{base}/handled/run={runs[i]}").first()[0] if i >= 0 else -1
    for i in todo:
        taken = [f"{base}/arrived/batch={b}" for b in batches if last(i - 1) < b <= last(i)]
        move_processed(spark.read.parquet(*taken)).write.mode("overwrite").parquet(f"{base}/archived/run={runs[i]}")


def folder_numbers(spark: SparkSession, root: str, name: str, complete: bool = False) -> list[int]:
    """The numbers n of the folders ``root/<name>=<n>``, in order; ``complete``: only those with ``_SUCCESS``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}=*" + ("/_SUCCESS" if complete else ""))
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    names = [(s.getPath().getParent() if complete else s.getPath()).getName() for s in found]
    return sorted(int(n[len(name) + 1:]) for n in names)
