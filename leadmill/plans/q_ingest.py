"""Registered queries of file ingestion, loads, sinks, checks and scalar helpers.

File-based queries first write the vendor files (derived by Spark from ``orders``) to a fresh
folder below the shared work folder, then run the operator on them.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import functions as F

from ..functions import scalar as X
from ..functions.headers import clean_headers
from ..operators import align as al
from ..operators import catalog as cat
from ..operators import leads as ld
from ..operators import listing as ls
from ..schemas import CATALOG_NULL_ON_INSERT, ENRICHED_DATA_COLUMNS, insert_columns
from ..session import scratch_path
from ..sinks import writers as wr
from ..sinks.archive import not_processed
from ..sinks.sheets import Sheets
from ..sources import files as fl
from ..sources import fixtures as fx
from ..sources.tables import Tables
from ..streaming.file_stream import run_available
from .ingest import enriched_select, ingest, ingest_checked, land_files
from .registry import query

_BATCH = "TIMESTAMP '2024-01-29 12:00:00'"

# Expected raw lead rows (subset of columns) after ingesting the vendor files.
_INGEST_COLS = ["file_id", "drive_metadata_uuid", "zoominfo_contact_id", "first_name", "last_name", "job_title",
                "email_address", "company_name", "mobile_phone", "direct_phone_number", "person_zip_code",
                "revenue_in_000s_usd", "company_country", "middle_name", "created_at"]


def _ingest_sql(missing: str = "''", where: str = "") -> str:
    lay = "((o_orderkey//150)%3)"
    return f"""
SELECT 'id'||(o_orderkey//150) AS file_id, d.uuid AS drive_metadata_uuid, CAST(o_orderkey AS VARCHAR) AS zoominfo_contact_id,
  'F'||o_custkey AS first_name, 'L'||o_custkey AS last_name,
  CASE WHEN o_orderkey%19=0 THEN NULL ELSE substring(o_orderpriority, 3, 20) END AS job_title,
  CASE WHEN o_orderkey%17=0 OR o_orderkey%23=0 THEN NULL ELSE 'c'||o_custkey||'@x.com' END AS email_address,
  CASE WHEN o_orderkey%31=0 THEN 'Co'||(o_custkey%97)||' "The Best"' WHEN o_orderkey%29=0 THEN 'Co'||(o_custkey%97)||', Inc'
       ELSE 'Co'||(o_custkey%97) END AS company_name,
  CASE WHEN {lay}=1 THEN {missing} WHEN o_orderkey%2<>0 THEN '555'||o_orderkey END AS mobile_phone,
  CASE WHEN {lay}=2 THEN {missing} WHEN o_orderkey%3<>0 THEN '777'||o_orderkey END AS direct_phone_number,
  lpad(CAST(o_orderkey%100000 AS VARCHAR), 5, '0') AS person_zip_code,
  CASE WHEN {lay}=2 THEN {missing} ELSE CAST(o_orderkey%1000 AS VARCHAR) END AS revenue_in_000s_usd,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'Canada' ELSE 'United States' END AS company_country,
  {missing} AS middle_name, {_BATCH} AS created_at
FROM orders JOIN drive_metadata d ON d.id='id'||(o_orderkey//150) {where}"""


_DERIVED: dict[tuple, str] = {}


def derived_once(spark, sf_dir: str, name: str, make) -> str:
    """Folder of files derived from the tables, written once per session and data folder and
    then read like any landing zone (the files are a deterministic function of the tables)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _DERIVED:
        _DERIVED[key] = make()
    return _DERIVED[key]


def _vendor_root(spark, sf_dir) -> str:
    return derived_once(spark, sf_dir, "vendor",
                        lambda: fx.write_vendor_files(spark, sf_dir, scratch_path(spark, "vendor")))


def _xlsx_root(spark, sf_dir) -> str:
    return derived_once(spark, sf_dir, "xlsx",
                        lambda: fx.write_vendor_workbooks(spark, sf_dir, scratch_path(spark, "xlsx")))


def _ingested(spark, sf_dir, columns=None):
    t = Tables(spark, sf_dir)
    return ingest(spark, _vendor_root(spark, sf_dir), t.drive_metadata, "leads", fx.BATCH_TS, columns=columns)


_CSV_FILES = "WHERE d.name LIKE '%.csv'"


@query("ingest_csv", _ingest_sql(where=_CSV_FILES), ("drive_metadata",))
def ingest_csv(spark, sf_dir):
    return _ingested(spark, sf_dir).select(*_INGEST_COLS)


@query("align_fill", _ingest_sql(where=_CSV_FILES), ("drive_metadata",))
def align_fill(spark, sf_dir):
    """P-6: columns missing from a file's layout are '' (not NULL)."""
    return _ingested(spark, sf_dir).select(*_INGEST_COLS)


_INTERSECT = ["zoominfo_contact_id", "first_name", "last_name", "job_title", "email_address", "company_name",
              "mobile_phone", "direct_phone_number", "person_zip_code", "revenue_in_000s_usd", "company_country"]


@query("align_intersect", _ingest_sql("NULL", where=_CSV_FILES), ("drive_metadata",))
def align_intersect(spark, sf_dir):
    """P-5: with an explicit column list only common columns are loaded; the rest stay NULL."""
    return _ingested(spark, sf_dir, columns=_INTERSECT).select(*_INGEST_COLS)


_DAMAGED = """
WITH l AS (SELECT o_orderkey AS k, o_orderkey//150 AS f, CASE WHEN (o_orderkey//150)%7=3 THEN 'new' ELSE 'id' END||(o_orderkey//150) AS fid,
             email_address, coalesce(email_address, '')||','||o_orderkey AS two, '"'||coalesce(job_title, '')||', line"' AS title, job_title
           FROM orders JOIN leads ON leads.uuid=o_orderkey),
known AS (SELECT l.*, d.uuid AS fu FROM l LEFT JOIN drive_metadata d ON d.id=l.fid)"""


def _damaged(spark, sf_dir):
    t = Tables(spark, sf_dir)
    root = derived_once(spark, sf_dir, "damaged", lambda: fx.write_damaged_files(spark, sf_dir, scratch_path(spark, "damaged")))
    return ingest_checked(spark, None, t.drive_metadata, "leads", fx.BATCH_TS, files=fl.list_files(spark, root, "*.txt"))


@query("ingest_ragged", _DAMAGED + """
SELECT fu AS drive_metadata_uuid, CAST(k AS VARCHAR) AS zoominfo_contact_id, nullif(email_address, '') AS email_address,
  CASE WHEN k%17<>0 THEN coalesce(job_title, '')||', line' END AS job_title
FROM known WHERE fu IS NOT NULL AND (k%13<>0 OR k%17=0)""", ("leads", "drive_metadata"))
def ingest_ragged(spark, sf_dir):
    """S-6: of damaged files the records that fit the header; records with fewer cells are filled with NULL."""
    return _damaged(spark, sf_dir)[0].select("drive_metadata_uuid", "zoominfo_contact_id", "email_address", "job_title")


@query("ingest_quarantine", _DAMAGED + """
SELECT fid AS file_id, 'more cells than the header' AS reason, two||','||title||',one more' AS record
FROM known WHERE fu IS NOT NULL AND k%13=0 AND k%17<>0
UNION ALL SELECT DISTINCT fid, 'file without a header', CAST(NULL AS VARCHAR) FROM known WHERE f%5=2 AND fu IS NOT NULL
UNION ALL SELECT DISTINCT fid, 'file unknown to the catalog', NULL FROM known WHERE fu IS NULL
UNION ALL SELECT DISTINCT fid, 'file unknown to the catalog', NULL FROM known WHERE fu IS NULL AND f%5=2""", ("leads", "drive_metadata"))
def ingest_quarantine(spark, sf_dir):
    """S-6 / S-7: what ingestion refuses, with the reason: ragged records, files without a header, unknown files."""
    return _damaged(spark, sf_dir)[1].select("file_id", "reason", "record")


def _land(spark, sf_dir, fresh: bool = True):
    """K-3: land every catalogued vendor file under file_type=<landing folder>/file_id=<id>."""
    t = Tables(spark, sf_dir)

    def make():
        files = fl.list_files(spark, _vendor_root(spark, sf_dir))
        return land_files(spark, files, t.drive_metadata, t.nodes, scratch_path(spark, "landing"),
                          workbooks=_xlsx_root(spark, sf_dir))
    return make() if fresh else derived_once(spark, sf_dir, "landing", make)


@query("ingest_landing", _ingest_sql(), ("drive_metadata",))
def ingest_landing(spark, sf_dir):
    """S-7: landed files are read back by header group and loaded like the originals."""
    t = Tables(spark, sf_dir)
    return ingest(spark, _land(spark, sf_dir, fresh=False), t.drive_metadata, "leads", fx.BATCH_TS).select(*_INGEST_COLS)


@query("land_csv", """
SELECT trim(lower(replace(p.name, ' ', '_'))) AS file_type, 'id'||(o_orderkey//150) AS file_id, count(*) AS n_rows
FROM orders JOIN nodes f ON f.id='id'||(o_orderkey//150) JOIN nodes p ON p.id=f.parent
GROUP BY 1, 2""", ("nodes",))
def land_csv(spark, sf_dir):
    landed = _land(spark, sf_dir)
    df = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(landed)
    return df.groupBy("file_type", "file_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("landing_files", """
SELECT DISTINCT 'id'||(o_orderkey//150) AS file_id FROM orders JOIN drive_metadata d ON d.id='id'||(o_orderkey//150)
WHERE d.name LIKE '%.csv'""", ("drive_metadata",))
def landing_files(spark, sf_dir):
    return fl.list_files(spark, _vendor_root(spark, sf_dir)).select("file_id").distinct()


@query("append_load", _ingest_sql(where=_CSV_FILES), ("drive_metadata",))
def append_load(spark, sf_dir):
    """K-2: load the same files twice into a table partitioned by file: the replay replaces."""
    rows = _ingested(spark, sf_dir).select(*_INGEST_COLS)
    table = scratch_path(spark, "leads_raw")
    wr.append_load(rows, table)
    wr.append_load(rows, table)
    return spark.read.parquet(table).select(*_INGEST_COLS)


@query("nan_to_null", """
SELECT CAST(o_orderkey AS VARCHAR) AS zoominfo_contact_id, CASE WHEN o_orderkey%11=0 THEN 'line one'||chr(10)||'line two' END AS notes,
  CASE WHEN o_orderkey%19=0 THEN 'N/A' ELSE substring(o_orderpriority, 3, 20) END AS job_title
FROM orders""")
def nan_to_null(spark, sf_dir):
    """P-3: only the text 'nan' becomes NULL; 'N/A' stays text here (it is nulled at CSV read)."""
    v = fx.vendor_rows(spark, sf_dir).select("zoominfo_contact_id", "notes", "job_title")
    return al.nan_to_null(v)


def _profile_sql(view: str, cols: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, max(coalesce(length(CAST({c} AS VARCHAR)), 3)) AS max_length FROM {view}" for c in cols)


_CITY_COLS = ["uuid", "drive_metadata_uuid", "type", "phone", "title", "dataid", "website", "address", "emails_0", "position", "rating",
              "reviews", "emails_1", "emails_2", "emails_3"]


@query("max_lengths", _profile_sql("city_search", _CITY_COLS), ("city_search",))
def max_lengths(spark, sf_dir):
    return wr.max_lengths(Tables(spark, sf_dir).city_search)


_LEAD_COLS = ["uuid", "drive_metadata_uuid", "first_name", "last_name", "job_title", "job_function", "email_address",
              "linkedin_contact_profile_url", "company_name", "mobile_phone", "direct_phone_number", "company_country",
              "created_at"]


@query("replace_load", _profile_sql("leads", _LEAD_COLS), ("leads",))
def replace_load(spark, sf_dir):
    """K-1: replace the staging table, return its column profile (A-7)."""
    return wr.replace_load(al.to_text(Tables(spark, sf_dir).leads), scratch_path(spark, "stg_leads"), fx.BATCH_TS)


@query("sheet_output", """
SELECT 'Quick Mail Output - Week 5' AS book, f.file_name AS sheet, coalesce(f."First Name", '') AS "First Name",
  coalesce(f."Email", '') AS "Email", coalesce(f."Phone", '') AS "Phone", coalesce(f."ZI Search", '') AS "ZI Search", f.file_id
FROM (SELECT e.first_name AS "First Name", e.email_address AS "Email",
        '="'||coalesce(coalesce(e.mobile_phone, e.direct_phone_number),'')||'"' AS "Phone", d.zi_search AS "ZI Search",
        d.name AS file_name, d.id AS file_id
      FROM (SELECT s.*, row_number() OVER (PARTITION BY s.email_address ORDER BY s.created_at DESC NULLS FIRST, s.uuid) AS rn
            FROM leads s
            WHERE s.email_address IS NOT NULL AND s.company_country='United States'
              AND NOT EXISTS (SELECT 1 FROM sales_customer_view c WHERE c.email=s.email_address)
              AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.lead_uuid=s.uuid)
              AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.email_address=s.email_address)) e
      JOIN drive_metadata d ON d.uuid=e.drive_metadata_uuid WHERE e.rn=1 AND d.config_file_uuid IS NOT NULL) f""",
       ("leads", "sales_customer_view", "tracking", "drive_metadata"))
def sheet_output(spark, sf_dir):
    """K-4: output rows written to one folder per (book, sheet, file_id), read back."""
    t = Tables(spark, sf_dir)
    frame = ld.output_frame(ld.fresh_leads(t.leads, t.customers, t.tracking, t.drive_metadata))
    book = F.concat(F.lit("Quick Mail Output - "), X.week_label(X.ntz(fx.BATCH_TS)))
    rows = frame.select(book.alias("book"), F.col("file_name").alias("sheet"),
                        "First Name", "Email", "Phone", "ZI Search", "file_id")
    out = scratch_path(spark, "sheets")
    wr.sheet_output(rows, out)
    back = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(out)
    # a sheet cell is text: an empty cell reads as '' whether NULL or '' was written
    return back.select("book", "sheet", "file_id", *[F.coalesce(F.col(c), F.lit("")).alias(c)
                                          for c in ("First Name", "Email", "Phone", "ZI Search")])


@query("read_config", "SELECT * FROM config_sheet", ("config_sheet",))
def read_config(spark, sf_dir):
    path = scratch_path(spark, "config")
    Tables(spark, sf_dir).config_sheet.write.mode("overwrite").options(**wr.CSV_WRITE_OPTIONS).csv(path)
    return fl.read_config(spark, path)


@query("read_franchises", 'SELECT CAST(row_no AS VARCHAR) AS row_no, "Franchise Name", "Domain Name" FROM franchise_list',
       ("franchise_list",))
def read_franchises(spark, sf_dir):
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "drive")
    t.franchise_list.write.mode("overwrite").options(**wr.CSV_WRITE_OPTIONS).csv(f"{root}/FRANCHISE Master List")
    # a second list under another name must be ignored by the title guard
    t.franchise_list.write.mode("overwrite").options(**wr.CSV_WRITE_OPTIONS).csv(f"{root}/Other List")
    return fl.read_franchises(spark, fl.list_files(spark, root))


_ENRICHED_VENDOR = {"first_name": "First Name", "last_name": "Last Name",
                    "main_point_of_contact_email": "Main Point of Contact Email",
                    "main_contact_linkedin": "Main Contact Linkedin", "generic_contact_email": "Generic Contact Email",
                    "company_name": "Company Name", "phone": "Phone", "drive_metadata_uuid": "drive_metadata_uuid"}


@query("enriched_ingest", """
SELECT first_name, last_name, main_point_of_contact_email, main_contact_linkedin, generic_contact_email, company_name,
  CAST(NULL AS VARCHAR) AS website, phone, drive_metadata_uuid FROM city_search_enriched""", ("city_search_enriched",))
def enriched_ingest(spark, sf_dir):
    """P-12: vendor headings cleaned (P-1), then a strict selection of the enriched columns."""
    e = Tables(spark, sf_dir).enriched
    vendor = e.select(*[F.col(c).alias(h) for c, h in _ENRICHED_VENDOR.items()],
                      F.lit(None).cast("string").alias("Website"), F.lit("x").alias("Extra Column"))
    return enriched_select(clean_headers(vendor), ENRICHED_DATA_COLUMNS + ["drive_metadata_uuid"])


@query("catalog_append", f"""
SELECT 'id'||(s_suppkey+5) AS id, s_name||CASE WHEN s_suppkey%3=0 THEN '.xlsx' ELSE '.csv' END AS name,
  '[''n'||s_nationkey||''']' AS parents, CASE WHEN s_suppkey%2=0 THEN 'True' ELSE 'False' END AS lastmodifyinguser_me,
  '' AS lastmodifyinguser_photolink, '' AS createdtime, CAST(NULL AS VARCHAR) AS config_file_uuid,
  CAST(NULL AS VARCHAR) AS file_type, CAST(NULL AS BOOLEAN) AS has_been_processed, {_BATCH} AS created_at
FROM supplier WHERE s_suppkey+5 >= (SELECT count(*) FROM supplier)""")
def catalog_append(spark, sf_dir):
    """K-2 + P-7 for the catalog: new listing records (J-1), flattened (P-14), cleaned (P-1),
    text (P-2), stamped (P-4), aligned with '' (P-6), six columns NULL (P-7)."""
    t = Tables(spark, sf_dir)
    rec = clean_headers(ls.flatten_records(fx.listing_records(spark, sf_dir, id_shift=5)))
    new = cat.new_files(rec, t.drive_metadata)
    target = [c for c in insert_columns("drive_metadata") if c not in CATALOG_NULL_ON_INSERT + ["created_at"]]
    rows = al.catalog_insert_shape(al.stamp(al.align_fill(new, target), fx.BATCH_TS))
    return rows.select("id", "name", "parents", "lastmodifyinguser_me", "lastmodifyinguser_photolink", "createdtime",
                       "config_file_uuid", "file_type", "has_been_processed", "created_at")


@query("file_counts", """
SELECT drive_metadata_uuid, count(*) AS n_rows, count(email_address) AS n_with_email FROM leads GROUP BY 1""", ("leads",))
def file_counts(spark, sf_dir):
    """A-8: rows per file and rows with an e-mail (decide whether later steps run)."""
    return Tables(spark, sf_dir).leads.groupBy("drive_metadata_uuid").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("email_address").alias("n_with_email"))


@query("dup_keys", """
SELECT email_address, count(*) AS n FROM leads WHERE email_address IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
       ("leads",))
def dup_keys(spark, sf_dir):
    """V-2: keys that occur more than once (a merge source must have one row per key)."""
    return Tables(spark, sf_dir).leads.where(F.col("email_address").isNotNull()).groupBy("email_address") \
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


@query("orphans", """
SELECT 'leads' AS table_name, 'drive_metadata_uuid' AS check_name,
  count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM drive_metadata d WHERE d.uuid=l.drive_metadata_uuid)) AS n_bad FROM leads l
UNION ALL SELECT 'tracking', 'lead_uuid',
  count(*) FILTER (WHERE t.lead_uuid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM leads l WHERE l.uuid=t.lead_uuid)) FROM tracking t
UNION ALL SELECT 'tracking', 'city_search_lead_uuid',
  count(*) FILTER (WHERE t.city_search_lead_uuid IS NOT NULL
                   AND NOT EXISTS (SELECT 1 FROM city_search_enriched e WHERE e.uuid=t.city_search_lead_uuid)) FROM tracking t
UNION ALL SELECT 'tracking', 'email_address not null', count(*) FILTER (WHERE email_address IS NULL) FROM tracking
UNION ALL SELECT 'city_search', 'drive_metadata_uuid',
  count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM drive_metadata d WHERE d.uuid=c.drive_metadata_uuid)) FROM city_search c""",
       ("leads", "tracking", "city_search_enriched", "city_search", "drive_metadata"))
def orphans(spark, sf_dir):
    """V-3: foreign-key orphans (anti joins to the parent) and NOT NULL violations, as counts."""
    from ..operators.checks import fk_orphans, null_count
    t = Tables(spark, sf_dir)
    parts = [
        fk_orphans(t.leads, "drive_metadata_uuid", t.drive_metadata, "uuid", "leads"),
        fk_orphans(t.tracking, "lead_uuid", t.leads, "uuid", "tracking"),
        fk_orphans(t.tracking, "city_search_lead_uuid", t.enriched, "uuid", "tracking"),
        null_count(t.tracking, "email_address", "tracking"),
        fk_orphans(t.city_search, "drive_metadata_uuid", t.drive_metadata, "uuid", "city_search"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("exclude_names", "SELECT id, name FROM nodes WHERE kind='file' AND NOT contains(name, '.xlsx')", ("nodes",))
def exclude_names(spark, sf_dir):
    """F-10: drop listing rows whose name contains a text."""
    n = Tables(spark, sf_dir).nodes
    return n.where((F.col("kind") == "file") & ~F.col("name").contains(".xlsx")).select("id", "name")


@query("scalar_domain_key", """
SELECT uuid, website, CASE WHEN regexp_matches(website, 'https?://([^/]*)') THEN regexp_extract(website, 'https?://([^/]*)', 1) END AS host,
  replace(coalesce(CASE WHEN regexp_matches(website, 'https?://([^/]*)') THEN regexp_extract(website, 'https?://([^/]*)', 1) END,
                   website), 'www.', '') AS domain_key
FROM city_search""", ("city_search",))
def scalar_domain_key(spark, sf_dir):
    c = Tables(spark, sf_dir).city_search
    return c.select("uuid", "website", X.url_host("website").alias("host"), X.domain_key("website").alias("domain_key"))


@query("scalar_iso_week", "SELECT o_orderkey, 'Week '||weekofyear(o_orderdate) AS sheet_week FROM orders")
def scalar_iso_week(spark, sf_dir):
    o = Tables(spark, sf_dir).raw("orders")
    return o.select("o_orderkey", X.week_label(F.col("o_orderdate")).alias("sheet_week"))


@query("scalar_paths", """
SELECT uuid, replace(name, 'xlsx', 'csv') AS blob_name,
  replace('salesfiles/zi_search/'||replace(name, 'xlsx', 'csv'), 'salesfiles/', '') AS blob_path,
  string_split('salesfiles/zi_search/'||replace(name, 'xlsx', 'csv'), '/')[-1] AS file_name
FROM drive_metadata""", ("drive_metadata",))
def scalar_paths(spark, sf_dir):
    d = Tables(spark, sf_dir).drive_metadata
    full = F.concat(F.lit("salesfiles/zi_search/"), X.xlsx_to_csv(F.col("name")))
    return d.select("uuid", X.xlsx_to_csv(F.col("name")).alias("blob_name"),
                    X.strip_container(full, "salesfiles").alias("blob_path"), X.last_path_segment(full).alias("file_name"))


@query("archive", """
SELECT f.id, f.parent, k.pid AS processed_folder_id, k.pid IS NULL AS create_processed_folder
FROM nodes f JOIN drive_metadata d ON d.id=f.id
LEFT JOIN (SELECT parent, min(id) AS pid FROM nodes WHERE kind='folder' AND name='Processed' AND NOT coalesce(trashed, false)
           GROUP BY parent) k ON k.parent=f.parent
WHERE f.kind='file' AND d.has_been_processed""", ("nodes", "drive_metadata"))
def archive(spark, sf_dir):
    """K-6: processed files and the sibling 'Processed' folder they move to (to be created when
    absent). ``archive_moved`` is the move itself."""
    t = Tables(spark, sf_dir)
    done = t.drive_metadata.where(F.col("has_been_processed")).select(F.col("id").alias("_id"))
    files = t.nodes.where(F.col("kind") == "file").join(done, F.col("id") == F.col("_id")).select("id", "parent")
    look = ls.folder_lookup(t.nodes).select(F.col("id").alias("_p"), "processed_folder_id")
    out = files.join(look, files["parent"] == look["_p"], "left")
    return out.select("id", "parent", "processed_folder_id",
                      F.col("processed_folder_id").isNull().alias("create_processed_folder"))


@query("ingest_xlsx", _ingest_sql() + " WHERE d.name LIKE '%.xlsx'", ("drive_metadata",))
def ingest_xlsx(spark, sf_dir):
    """S-8: the .xlsx lead files as workbooks, read one task per workbook, loaded like CSV."""
    t = Tables(spark, sf_dir)
    return ingest(spark, _xlsx_root(spark, sf_dir), t.drive_metadata, "leads", fx.BATCH_TS, fmt="xlsx").select(*_INGEST_COLS)


@query("ingest_xlsx_typed", """
WITH o AS (SELECT o_orderkey AS k, 'id'||(o_orderkey//150) AS file_id, o_orderdate,
             TIMESTAMP '2000-01-01 00:00:00' + INTERVAL 1 SECOND * (o_orderkey%86400) AS clock, o_orderkey%100 AS hours FROM orders)
SELECT file_id, CAST(k AS VARCHAR) AS zoominfo_contact_id,
  CASE WHEN k%9<>0 THEN strftime(o_orderdate, '%Y-%m-%d')||strftime(clock, ' %H:%M:%S') END AS ordered,
  strftime(clock, '%H:%M:%S') AS called,
  CASE WHEN hours<24 THEN '' WHEN hours<48 THEN '1 day, ' ELSE (hours//24)||' days, ' END||(hours%24)||':00:00' AS talked,
  CASE WHEN k%2=1 THEN 'True' ELSE 'False' END AS subscribed, CAST(NULL AS VARCHAR) AS score,
  CASE WHEN k%4=0 THEN CAST(k%1000//4 AS VARCHAR) ELSE CAST(CAST(k%1000 AS DOUBLE)/4 AS VARCHAR) END AS price
FROM o""")
def ingest_xlsx_typed(spark, sf_dir):
    """S-8: typed cells as text: dates in both date systems, times, elapsed times, booleans, errors (missing), numbers."""
    from ..sources.xlsx import read_rows, rows_by_header
    root = derived_once(spark, sf_dir, "typed", lambda: fx.write_typed_workbooks(spark, sf_dir, scratch_path(spark, "typed")))
    (rows,) = rows_by_header(spark, read_rows(spark, root))
    return rows.drop("path")


@query("archive_moved", """
SELECT 'id'||(o_orderkey//150) AS file_id, false AS at_source, 2*count(*) AS rows_archived
FROM orders JOIN drive_metadata d ON d.id='id'||(o_orderkey//150) WHERE d.name LIKE '%.csv' GROUP BY 1""", ("drive_metadata",))
def archive_moved(spark, sf_dir):
    """K-6: two streams' runs over arriving lead files, each of which moves its files to ``Processed``; what is found at the
    source and at the target afterwards."""
    root, state = scratch_path(spark, "arriving"), scratch_path(spark, "archive_state")
    for _ in range(2):                              # the second time under new file names
        fx.write_vendor_files(spark, sf_dir, root)
        run_available(spark, root, f"{state}/checkpoint", lambda files, run: files.write.parquet(f"{state}/files/run={run}"), archive=True)
    found = fl.list_files(spark, root)
    left = found.where(not_processed(F.col("path"))).select(F.col("file_id").alias("_left")).distinct()
    groups = fl.read_header_groups(spark, found.where(~not_processed(F.col("path"))))
    counts = [g.groupBy("file_id").agg(F.count(F.lit(1)).alias("n")) for g in groups]
    rows = functools.reduce(lambda a, b: a.unionByName(b), counts).groupBy("file_id").agg(F.sum("n").alias("rows_archived"))
    return rows.join(left, F.col("file_id") == F.col("_left"), "left").select(
        "file_id", F.col("_left").isNotNull().alias("at_source"), "rows_archived")


_SHEET_RUNS = {"F": 0, "O": 1, "P": 2}          # the run that writes a lead, by the status of its order


@query("sheet_append", """
WITH l AS (SELECT d.name AS sheet, d.name LIKE '%.xlsx' AS cleared, job_function AS run, l.uuid, coalesce(email_address, '') AS email,
             coalesce(direct_phone_number, '') AS phone, bool_or(job_function='P') OVER (PARTITION BY d.name) AS p
           FROM leads l JOIN drive_metadata d ON d.uuid=l.drive_metadata_uuid),
kept AS (SELECT *, CASE WHEN run='P' THEN 3 WHEN run='O' THEN 2 ELSE 1 END AS n FROM l WHERE NOT cleared OR NOT p OR run='P'),
placed AS (SELECT sheet, email, phone, row_number() OVER (PARTITION BY sheet ORDER BY n, uuid) + 1 AS row_no FROM kept)
SELECT sheet, CAST(row_no AS BIGINT) AS row_no, email||'|'||phone AS cells FROM placed
UNION ALL SELECT DISTINCT sheet, CAST(1 AS BIGINT), 'Email|Phone' FROM kept""", ("leads", "drive_metadata"))
def sheet_append(spark, sf_dir):
    """K-4 over three runs, the last one repeated: leads of new sheets, more leads below them, then leads that replace the sheets of
    workbooks and go below those of CSV files."""
    t = Tables(spark, sf_dir)
    names = t.drive_metadata.select(F.col("uuid").alias("_u"), F.col("name").alias("sheet"))
    rows = t.leads.join(names, F.col("drive_metadata_uuid") == F.col("_u")).select(
        F.lit("Quick Mail Output").alias("book"), "sheet", F.col("email_address").alias("Email"), F.col("direct_phone_number").alias("Phone"),
        "uuid", "job_function")
    sheets = Sheets(spark, scratch_path(spark, "sheet_rows"))
    for status, run in [*_SHEET_RUNS.items(), ("P", 2)]:
        sheets.write(rows.where(F.col("job_function") == status), ["Email", "Phone"], ["uuid"], run,
                     replace=F.col("sheet").endswith(".xlsx") if status == "P" else False)
    return sheets.read(2).select("sheet", "row_no", F.array_join("cells", "|").alias("cells"))


@query("replace_table", f"""
SELECT uuid, email_address, phone, CAST(max(length(email_address)) OVER () AS INTEGER) AS email_length, inserted_at
FROM (SELECT CAST(uuid AS VARCHAR) AS uuid, email_address, coalesce(mobile_phone, direct_phone_number) AS phone, {_BATCH} AS inserted_at
      FROM leads WHERE email_address IS NOT NULL) l""", ("leads",))
def replace_table(spark, sf_dir):
    """K-1 + K-5: a database that is created twice, a table that is filled and then replaced by one with other columns."""
    leads = Tables(spark, sf_dir).leads
    path = scratch_path(spark, "stg")
    wr.replace_table(leads, "leadmill_stg", "leads_load", path, fx.BATCH_TS - dt.timedelta(days=1))
    second = leads.where(F.col("email_address").isNotNull()).select(
        "uuid", "email_address", F.coalesce("mobile_phone", "direct_phone_number").alias("phone"))
    wr.replace_table(second, "leadmill_stg", "leads_load", path, fx.BATCH_TS)
    declared = spark.sql("DESCRIBE leadmill_stg.leads_load").where(F.col("col_name") == "email_address")
    length = declared.select(F.regexp_extract("data_type", r"(\d+)", 1).cast("int")).scalar()
    return spark.read.table("leadmill_stg.leads_load").withColumn("email_length", length).withColumnRenamed("_inserted_at", "inserted_at")
