"""Streams: batch result = stream result, a restart on the same checkpoint does nothing, and a
replayed batch overwrites its own output (R-2, R-5)."""

from pyspark.sql import functions as F

from leadmill.plans import jobs as pl
from leadmill.plans.ingest import land_files
from leadmill.session import scratch_path
from leadmill.sources import files as fl
from leadmill.sources import fixtures as fx
from leadmill.sources.tables import Tables
from leadmill.streaming.file_stream import run_available

CSV = {"header": "true", "multiLine": "true", "escape": '"'}


def _setup(spark, sf):
    t = Tables(spark, sf)
    vendor = fx.write_vendor_files(spark, sf, scratch_path(spark, "vendor"))
    books = fx.write_vendor_workbooks(spark, sf, scratch_path(spark, "xlsx"))
    landing = land_files(spark, fl.list_files(spark, vendor), t.drive_metadata, t.nodes, scratch_path(spark, "landing"),
                         workbooks=books)
    catalog = t.drive_metadata.withColumn("has_been_processed", F.lit(None).cast("boolean"))
    tracking = t.tracking.withColumn("lead_uuid", F.col("lead_uuid").cast("string")) \
                         .withColumn("city_search_lead_uuid", F.col("city_search_lead_uuid").cast("string"))
    return t, f"{landing}/file_type=zi_search", catalog, tracking


def _sheet_rows(spark, state):
    df = spark.read.options(**CSV).csv(state.path("sheets"))
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


def test_stream_equals_batch_and_restart_is_noop(spark, sf_small):
    t, folder, catalog, tracking = _setup(spark, sf_small)
    s1 = pl.State(spark, scratch_path(spark, "state")).init(catalog=catalog, tracking=tracking)
    n = run_available(spark, folder, s1.path("_ck"), lambda df, b: pl.lead_batch(s1, df, b, fx.BATCH_TS, t.customers))
    assert n == 1
    stream_rows = _sheet_rows(spark, s1)
    assert stream_rows
    # a restart on the same checkpoint hands over no file
    n2 = run_available(spark, folder, s1.path("_ck"), lambda df, b: pl.lead_batch(s1, df, b, fx.BATCH_TS, t.customers))
    assert n2 == 0 and _sheet_rows(spark, s1) == stream_rows
    # the same files as one plain batch
    s2 = pl.State(spark, scratch_path(spark, "state")).init(catalog=catalog, tracking=tracking)
    files = fl.list_files(spark, folder).select("path", "file_id")
    pl.lead_batch(s2, files, 0, fx.BATCH_TS, t.customers)
    assert _sheet_rows(spark, s2) == stream_rows
    # replaying batch 0 (e.g. after a lost executor) rewrites the same outputs
    pl.lead_batch(s2, files, 0, fx.BATCH_TS, t.customers)
    assert _sheet_rows(spark, s2) == stream_rows
    assert s2.read("tracking", 0).count() == s1.read("tracking", 0).count()
    # every processed file is flagged at the end of the batch
    done = s1.read("catalog", 0).where("has_been_processed").select("id")
    assert done.join(files.select(F.col("file_id").alias("id")), "id").count() == files.select("file_id").distinct().count()


def test_fresh_leads_never_tracked_after_batch(spark, sf_small):
    t, folder, catalog, tracking = _setup(spark, sf_small)
    s = pl.State(spark, scratch_path(spark, "state")).init(catalog=catalog, tracking=tracking)
    run_available(spark, folder, s.path("_ck"), lambda df, b: pl.lead_batch(s, df, b, fx.BATCH_TS, t.customers))
    sheets = spark.read.options(**CSV).csv(s.path("sheets"))
    # one row per e-mail across all sheets; no e-mail of the output was tracked before the batch
    assert sheets.groupBy("Email").count().where("count > 1").count() == 0
    before = tracking.select(F.col("email_address").alias("Email"))
    assert sheets.join(before, "Email").count() == 0
    # after the batch every exported e-mail is tracked
    after = s.read("tracking", 0).select(F.col("email_address").alias("Email")).distinct()
    assert sheets.where(F.col("Email").isNotNull()).join(after, "Email", "left_anti").count() == 0


def test_backlog_in_small_micro_batches_sends_each_email_once(spark, sf_small):
    t, folder, catalog, tracking = _setup(spark, sf_small)
    s = pl.State(spark, scratch_path(spark, "state")).init(catalog=catalog, tracking=tracking)
    n = run_available(spark, folder, s.path("_ck"), lambda df, b: pl.lead_batch(s, df, b, fx.BATCH_TS, t.customers),
                      max_files_per_trigger=1)
    files = fl.list_files(spark, folder).select("file_id").distinct().count()
    assert n == 1 and files >= 1
    # the same as one unlimited batch: raw rows, sheets, tracking, notices and flags
    whole = pl.State(spark, scratch_path(spark, "state")).init(catalog=catalog, tracking=tracking)
    run_available(spark, folder, whole.path("_ck"), lambda df, b: pl.lead_batch(whole, df, b, fx.BATCH_TS, t.customers))
    assert _sheet_rows(spark, s) == _sheet_rows(spark, whole)
    reads = {"raw_leads": lambda x: x.raw_keyed("leads", "email_address").read(0), "tracking": lambda x: x.read("tracking", 0),
             "outbox": lambda x: spark.read.parquet(x.path("outbox/batch=0000000000")), "catalog": lambda x: x.read("catalog", 0)}
    for name, read in reads.items():
        a, b = read(s), read(whole)
        assert a.count() == b.count() and a.exceptAll(b.select(a.columns)).isEmpty(), name
    sheets = spark.read.options(**CSV).csv(s.path("sheets"))
    assert sheets.count() > 0
    assert sheets.groupBy("Email").count().where("count > 1").count() == 0     # each e-mail goes out once
    last = s.read("catalog", n - 1).where("has_been_processed").count()
    assert last == files

