"""Registered queries of the triggered pipelines (R-1 … R-6), run as file streams to completion.

Each query derives its landing files from the driver tables, starts from the fixture state,
processes every available file (``availableNow``) and returns what the pipeline wrote.
Each has a DuckDB oracle over the driver's tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import files as fl
from ..sources import fixtures as fx
from ..sources.tables import Tables
from ..streaming.file_stream import run_available
from . import jobs as pl
from .ingest import ingest
from .q_ingest import _INGEST_COLS, _ingest_sql, _vendor_root, _xlsx_root
from .registry import query
from .stream_sql import (outbox_after, stream_city_outbox_sql, stream_city_sql, stream_enriched_outbox_sql, stream_enriched_sql,
                         sync_sql, timer_catalog_sql, timer_landed_sql, timer_notices_sql, tracking_after)

CSV_READ = {"header": "true", "multiLine": "true", "escape": '"'}


def _landed(spark, sf_dir) -> str:
    from .q_ingest import _land
    return _land(spark, sf_dir, fresh=False)


def _text_keys(tracking):
    """Stored tracking keys are uuid texts (raw rows get content uuids)."""
    return tracking.withColumn("lead_uuid", F.col("lead_uuid").cast("string")) \
                   .withColumn("city_search_lead_uuid", F.col("city_search_lead_uuid").cast("string"))


def _fresh_catalog(catalog):
    """The catalog before any file was loaded: no file is flagged processed yet."""
    return catalog.withColumn("has_been_processed", F.lit(None).cast("boolean"))


def _sheets(spark, state: pl.State):
    return fl.read_sheets(spark, state.path("sheets"))


def _stream_leads_sql(tracking: bool = False) -> str:
    """Oracle of ``stream_leads``: the raw rows the landing zone's zi_search files load to (same
    values as ``ingest_csv``, content uuids), ranked per e-mail on the fixture's tracking."""
    from ..schemas import LEADS_DATA_COLUMNS
    from ..sources.fixture_sql import sql_det_uuid, sql_keyed_rows, with_views
    lay = "((o_orderkey//150)%3)"
    values = {
        "zoominfo_contact_id": "CAST(o_orderkey AS VARCHAR)",
        "first_name": "'F'||o_custkey", "last_name": "'L'||o_custkey",
        "job_title": "CASE WHEN o_orderkey%19=0 THEN NULL ELSE substring(o_orderpriority, 3, 20) END",
        "job_function": "o_orderstatus",
        "email_address": "CASE WHEN o_orderkey%17=0 OR o_orderkey%23=0 THEN NULL ELSE 'c'||o_custkey||'@x.com' END",
        "linkedin_contact_profile_url": "'https://linkedin.example/in/c'||o_custkey",
        "company_name": ("CASE WHEN o_orderkey%31=0 THEN 'Co'||(o_custkey%97)||' \"The Best\"' "
                         "WHEN o_orderkey%29=0 THEN 'Co'||(o_custkey%97)||', Inc' ELSE 'Co'||(o_custkey%97) END"),
        "mobile_phone": f"CASE WHEN {lay}=1 THEN '' WHEN o_orderkey%2<>0 THEN '555'||o_orderkey END",
        "direct_phone_number": f"CASE WHEN {lay}=2 THEN '' WHEN o_orderkey%3<>0 THEN '777'||o_orderkey END",
        "person_zip_code": "lpad(CAST(o_orderkey%100000 AS VARCHAR), 5, '0')",
        "revenue_in_000s_usd": f"CASE WHEN {lay}=2 THEN '' ELSE CAST(o_orderkey%1000 AS VARCHAR) END",
        "company_country": "CASE WHEN o_orderpriority LIKE '1%' THEN 'Canada' ELSE 'United States' END",
    }
    blank = "''"
    cols = ",\n    ".join(f"{values.get(c, blank)} AS {c}" for c in LEADS_DATA_COLUMNS)
    uid = sql_det_uuid("drive_metadata_uuid", *LEADS_DATA_COLUMNS)
    sql = f"""
WITH raw0 AS (
  SELECT d.uuid AS drive_metadata_uuid,
    {cols}
  FROM orders JOIN drive_metadata d ON d.id='id'||(o_orderkey//150)
  JOIN nodes f ON f.id=d.id AND f.kind='file' JOIN nodes p ON p.id=f.parent
  WHERE trim(lower(replace(p.name, ' ', '_')))='zi_search'),
raw AS ({sql_keyed_rows("raw0", uid)}),
e AS (SELECT r.*, row_number() OVER (PARTITION BY r.email_address ORDER BY r.uuid) AS rn
      FROM raw r
      WHERE r.email_address IS NOT NULL AND r.company_country='United States'
        AND NOT EXISTS (SELECT 1 FROM sales_customer_view c WHERE c.email=r.email_address)
        AND NOT EXISTS (SELECT 1 FROM tracking t WHERE CAST(t.lead_uuid AS VARCHAR)=r.uuid)
        AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.email_address=r.email_address))
SELECT e.first_name AS "First Name", e.last_name AS "Last Name", e.job_title AS "Title", e.job_function AS "Role",
  e.email_address AS "Email", e.linkedin_contact_profile_url AS "Linkedin", e.company_name AS "Company",
  '="'||coalesce(coalesce(e.mobile_phone, e.direct_phone_number), '')||'"' AS "Phone",
  d.hubspot_owner AS "Hubspot Owner", d.zi_search AS "ZI Search", d.id AS file_id,
  'Quick Mail Output - Week 5' AS book, d.name AS sheet
FROM e JOIN drive_metadata d ON d.uuid=e.drive_metadata_uuid
WHERE e.rn=1 AND d.config_file_uuid IS NOT NULL"""
    if tracking:
        sql = tracking_after(sql[:sql.index("SELECT e.first_name")], "r.email_address", "lead_uuid", ("'posted'", "r.uuid"))
    return with_views(sql, "drive_metadata", "nodes", "sales_customer_view", "tracking")


def _run_leads(spark, sf_dir) -> pl.State:
    t = Tables(spark, sf_dir)
    landing = _landed(spark, sf_dir)
    state = pl.State(spark, scratch_path(spark, "state")).init(catalog=_fresh_catalog(t.drive_metadata), tracking=_text_keys(t.tracking))
    customers = t.customers
    run_available(spark, f"{landing}/file_type=zi_search", state.path("_checkpoint"),
                  lambda df, bid: pl.lead_batch(state, df, bid, fx.BATCH_TS, customers))
    return state


@query("stream_leads", _stream_leads_sql())
def stream_leads(spark, sf_dir):
    """R-2 + R-5 + R-6: lead files arriving in the zi_search landing folder."""
    return _sheets(spark, _run_leads(spark, sf_dir))


@query("stream_leads_tracking", _stream_leads_sql(tracking=True))
def stream_leads_tracking(spark, sf_dir):
    """T-1 and U-4 of the lead stream: the tracking rows it leaves, only for files that sent something."""
    return _run_leads(spark, sf_dir).read("tracking", 0).select("uuid", "lead_uuid", "status", "email_address")


@query("stream_leads_outbox", outbox_after(_stream_leads_sql(tracking=True), "lead_uuid"))
def stream_leads_outbox(spark, sf_dir):
    """A-1 and K-8 of the lead stream: the notices it leaves."""
    return spark.read.parquet(_run_leads(spark, sf_dir).path("outbox")).select("name", "drive_metadata_uuid", "text")


def _run_city(spark, sf_dir) -> pl.State:
    t = Tables(spark, sf_dir)
    from .q_ingest import derived_once
    root = derived_once(spark, sf_dir, "city_files",
                        lambda: fx.write_city_files(spark, sf_dir, scratch_path(spark, "city_files")))
    state = pl.State(spark, scratch_path(spark, "state")).init(catalog=_fresh_catalog(t.drive_metadata), franchises=t.franchises)
    source = t.franchise_list
    run_available(spark, root, state.path("_checkpoint"),
                  lambda df, bid: pl.city_batch(state, df, bid, fx.BATCH_TS, source))
    return state


@query("stream_city", stream_city_sql())
def stream_city(spark, sf_dir):
    """R-3: city-search listing files; franchises upserted first, sheets always recomputed."""
    return _sheets(spark, _run_city(spark, sf_dir))


@query("stream_city_outbox", stream_city_outbox_sql())
def stream_city_outbox(spark, sf_dir):
    """K-8 of the city stream: one notice for each written sheet."""
    return spark.read.parquet(_run_city(spark, sf_dir).path("outbox")).select("file_id", "link", "sheet_name", "text")


def _run_enriched(spark, sf_dir) -> pl.State:
    t = Tables(spark, sf_dir)
    from .q_ingest import derived_once
    root = derived_once(spark, sf_dir, "enriched_files",
                        lambda: fx.write_enriched_files(spark, sf_dir, scratch_path(spark, "enriched_files")))
    state = pl.State(spark, scratch_path(spark, "state")).init(catalog=_fresh_catalog(t.drive_metadata), tracking=_text_keys(t.tracking))
    customers = t.customers
    run_available(spark, root, state.path("_checkpoint"),
                  lambda df, bid: pl.enriched_batch(state, df, bid, fx.BATCH_TS, customers))
    return state


@query("stream_enriched", stream_enriched_sql())
def stream_enriched(spark, sf_dir):
    """R-4: enriched contact files; personal and generic sheets."""
    return _sheets(spark, _run_enriched(spark, sf_dir))


@query("stream_enriched_tracking", stream_enriched_sql(tracking=True))
def stream_enriched_tracking(spark, sf_dir):
    """T-2 and U-5 of the enriched stream: the tracking rows it leaves."""
    return _run_enriched(spark, sf_dir).read("tracking", 0).select("uuid", "city_search_lead_uuid", "status", "email_address")


@query("stream_enriched_outbox", stream_enriched_outbox_sql())
def stream_enriched_outbox(spark, sf_dir):
    """A-2 and K-8 of the enriched stream: the notices it leaves, with the book's link."""
    return spark.read.parquet(_run_enriched(spark, sf_dir).path("outbox")).select("name", "drive_metadata_uuid", "text")


@query("timer_sync", sync_sql())
def timer_sync(spark, sf_dir):
    """R-1: listing -> catalog append, file types, config, flags, on a filled catalog."""
    t = Tables(spark, sf_dir)
    catalog, notices, ready = pl.sync(fx.listing_records(spark, sf_dir, id_shift=5), t.nodes, t.drive_metadata,
                                      t.config_sheet, fx.BATCH_TS)
    return catalog.select("uuid", "id", "name", "file_type", "config_file_uuid", "has_posted_on_slack")


def _run_timer(spark, sf_dir) -> pl.State:
    """The first run: the catalog is empty, so every listed file is new and every ready one lands."""
    t = Tables(spark, sf_dir)
    state = pl.State(spark, scratch_path(spark, "timer")).init(catalog=t.drive_metadata.limit(0))
    pl.timer_run(state, fx.listing_records(spark, sf_dir), t.nodes, t.config_sheet, fl.list_files(spark, _vendor_root(spark, sf_dir)),
                 0, fx.BATCH_TS, workbooks=_xlsx_root(spark, sf_dir))
    return state


@query("timer_catalog", timer_catalog_sql())
def timer_catalog(spark, sf_dir):
    """R-1 whole: the catalog that the run publishes."""
    return _run_timer(spark, sf_dir).read("catalog", 0).select(
        "uuid", "id", "name", "file_type", "config_file_uuid", "has_posted_on_slack", "lastmodifyinguser_displayname", "parents",
        "created_at")


@query("timer_notices", timer_notices_sql())
def timer_notices(spark, sf_dir):
    """R-1 whole: the notices of files without a config."""
    return spark.read.parquet(_run_timer(spark, sf_dir).path("notices")).select("uuid", "text")


@query("timer_landed", timer_landed_sql(_ingest_sql()))
def timer_landed(spark, sf_dir):
    """R-1 whole: the rows of the files that the run landed, read back."""
    state = _run_timer(spark, sf_dir)
    return ingest(spark, state.path("landing"), state.read("catalog", 0), "leads", fx.BATCH_TS).select(*_INGEST_COLS)


@query("sync_quarantine", """
SELECT d.id, replace(lower(trim(p.name)), ' ', '_') AS file_type
FROM drive_metadata d JOIN nodes p ON p.id=d.parent AND p.kind='folder'
WHERE replace(lower(trim(p.name)), ' ', '_') NOT IN ('zi_search', 'city_search', 'data_drop')""", ("drive_metadata", "nodes"))
def sync_quarantine(spark, sf_dir):
    """V-1 in the timer run: files whose folder's name is no file type, with that name."""
    state = _run_timer(spark, sf_dir)
    known = state.read("catalog", 0).select(F.col("uuid").alias("_u"), "id")
    bad = spark.read.parquet(state.path("unknown_types"))
    return bad.join(known, F.col("uuid") == F.col("_u")).select("id", "file_type")
