"""Registered queries of the lead-vendor pipeline (W-1, P-10, T-1, U-4, A-1) and the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as cat
from ..operators import leads as ld
from ..sources.fixture_sql import sql_det_uuid
from ..sources.fixtures import BATCH_TS
from ..sources.tables import Tables
from .registry import query

_BATCH = "TIMESTAMP '2024-01-29 12:00:00'"

FRESH_SQL = """
SELECT e.uuid, e.first_name, e.last_name, e.job_title, e.job_function, e.email_address,
  e.linkedin_contact_profile_url, e.company_name, coalesce(e.mobile_phone, e.direct_phone_number) AS phone_number,
  d.zi_search, d.hubspot_owner, d.name AS file_name, d.id AS file_id, e.drive_metadata_uuid
FROM (SELECT s.*, row_number() OVER (PARTITION BY s.email_address ORDER BY s.created_at DESC NULLS FIRST, s.uuid) AS rn
      FROM leads s
      WHERE s.email_address IS NOT NULL AND s.company_country='United States'
        AND NOT EXISTS (SELECT 1 FROM sales_customer_view c WHERE c.email=s.email_address)
        AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.lead_uuid=s.uuid)
        AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.email_address=s.email_address)) e
JOIN drive_metadata d ON d.uuid=e.drive_metadata_uuid
WHERE e.rn=1 AND d.config_file_uuid IS NOT NULL"""
FRESH_VIEWS = ("leads", "sales_customer_view", "tracking", "drive_metadata")


def fresh(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ld.fresh_leads(t.leads, t.customers, t.tracking, t.drive_metadata)


query("fresh_leads", FRESH_SQL, FRESH_VIEWS)(fresh)


@query("output_frame", f"""
SELECT first_name AS "First Name", last_name AS "Last Name", job_title AS "Title", job_function AS "Role",
  email_address AS "Email", linkedin_contact_profile_url AS "Linkedin", company_name AS "Company",
  '="'||coalesce(phone_number,'')||'"' AS "Phone", hubspot_owner AS "Hubspot Owner", zi_search AS "ZI Search",
  file_id, file_name
FROM ({FRESH_SQL}) f""", FRESH_VIEWS)
def output_frame(spark, sf_dir):
    return ld.output_frame(fresh(spark, sf_dir))


@query("track_posted", f"""
SELECT uuid, lead_uuid, city_search_lead_uuid, status, email_address, created_at FROM tracking
UNION ALL
SELECT {sql_det_uuid("'posted'", 'l.uuid')} AS uuid, l.uuid AS lead_uuid, CAST(NULL AS BIGINT) AS city_search_lead_uuid,
  'posted' AS status, l.email_address, {_BATCH} AS created_at
FROM leads l
WHERE l.email_address IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.lead_uuid=l.uuid AND t.city_search_lead_uuid IS NULL)""",
       ("leads", "tracking"))
def track_posted(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ld.track_posted(t.leads, t.tracking, BATCH_TS)


@query("track_customers", f"""
SELECT t.uuid, t.lead_uuid, t.city_search_lead_uuid,
  CASE WHEN t.status='posted' AND EXISTS (SELECT 1 FROM leads l JOIN sales_customer_view c ON c.email=l.email_address
                                          WHERE l.uuid=t.lead_uuid) THEN 'shopify_customer' ELSE t.status END AS status,
  t.email_address,
  CASE WHEN t.status='posted' AND EXISTS (SELECT 1 FROM leads l JOIN sales_customer_view c ON c.email=l.email_address
                                          WHERE l.uuid=t.lead_uuid) THEN {_BATCH} ELSE t.created_at END AS created_at
FROM tracking t
UNION ALL
SELECT {sql_det_uuid("'shopify_customer'", 'l.uuid')}, l.uuid, CAST(NULL AS BIGINT), 'shopify_customer', l.email_address, {_BATCH}
FROM leads l
WHERE EXISTS (SELECT 1 FROM sales_customer_view c WHERE c.email=l.email_address)
  AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.lead_uuid=l.uuid)""",
       ("leads", "sales_customer_view", "tracking"))
def track_customers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ld.track_customers(t.leads, t.customers, t.tracking, BATCH_TS)


@query("metrics_leads", """
SELECT l.drive_metadata_uuid, d.name,
  CAST(sum(CASE WHEN t.status='shopify_customer' THEN 1 ELSE 0 END) AS BIGINT) AS number_of_shopify_customers,
  CAST(sum(CASE WHEN t.status='posted' THEN 1 ELSE 0 END) AS BIGINT) AS number_of_posted_leads,
  d.created_at
FROM tracking t JOIN leads l ON l.uuid=t.lead_uuid LEFT JOIN drive_metadata d ON d.uuid=l.drive_metadata_uuid
GROUP BY l.drive_metadata_uuid, d.name, d.created_at""", ("leads", "tracking", "drive_metadata"))
def metrics_leads(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ld.status_metrics(t.tracking, t.leads, t.drive_metadata)


# ---- catalog ---------------------------------------------------------------------------------

@query("missing_config", """
SELECT uuid, name, created_at, lastmodifyinguser_displayname, file_type FROM drive_metadata
WHERE config_file_uuid IS NULL AND has_posted_on_slack IS NULL AND file_type NOT IN ('city_search')""",
       ("drive_metadata",))
def missing_config(spark, sf_dir):
    return cat.missing_config(Tables(spark, sf_dir).drive_metadata) \
              .select("uuid", "name", "created_at", "lastmodifyinguser_displayname", "file_type")


@query("mark_posted", """
SELECT uuid, CASE WHEN config_file_uuid IS NULL AND has_posted_on_slack IS NULL THEN true ELSE has_posted_on_slack END
  AS has_posted_on_slack
FROM drive_metadata""", ("drive_metadata",))
def mark_posted(spark, sf_dir):
    return cat.mark_posted(Tables(spark, sf_dir).drive_metadata).select("uuid", "has_posted_on_slack")


@query("ready_files", """
SELECT d.id, d.name, d.file_type FROM drive_metadata d
WHERE d.id IN (SELECT id FROM new_listing) AND (d.config_file_uuid IS NOT NULL OR d.file_type='city_search')""",
       ("drive_metadata", "new_listing"))
def ready_files(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cat.ready_files(t.drive_metadata, t.new_listing).select("id", "name", "file_type")


@query("unprocessed_files", """
SELECT d.id, d.name, d.file_type FROM drive_metadata d
WHERE (d.config_file_uuid IS NOT NULL OR d.file_type='city_search') AND NOT coalesce(d.has_been_processed, false)""",
       ("drive_metadata",))
def unprocessed_files(spark, sf_dir):
    return cat.ready_files(Tables(spark, sf_dir).drive_metadata).select("id", "name", "file_type")


@query("typed_files", "SELECT uuid, id, file_type FROM drive_metadata WHERE file_type IS NOT NULL", ("drive_metadata",))
def typed_files(spark, sf_dir):
    return cat.typed_files(Tables(spark, sf_dir).drive_metadata).select("uuid", "id", "file_type")


@query("new_files", """
SELECT n.id, n.name FROM new_listing n WHERE NOT EXISTS (SELECT 1 FROM drive_metadata d WHERE d.id=n.id)""",
       ("new_listing", "drive_metadata"))
def new_files(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cat.new_files(t.new_listing, t.drive_metadata)


@query("apply_config", f"""
SELECT d.uuid,
  CASE WHEN d.config_file_uuid IS NULL AND c.filename IS NOT NULL THEN {sql_det_uuid("'config'", 'd.uuid', 'c.filename')}
       ELSE d.config_file_uuid END AS config_file_uuid,
  CASE WHEN d.config_file_uuid IS NULL AND c.filename IS NOT NULL THEN c.hubspot_owner ELSE d.hubspot_owner END AS hubspot_owner,
  CASE WHEN d.config_file_uuid IS NULL AND c.filename IS NOT NULL THEN c.zi_search ELSE d.zi_search END AS zi_search
FROM drive_metadata d LEFT JOIN config_sheet c ON c.filename=d.name""", ("drive_metadata", "config_sheet"))
def apply_config(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cat.apply_config(t.drive_metadata, t.config_sheet, BATCH_TS) \
              .select("uuid", "config_file_uuid", "hubspot_owner", "zi_search")


DERIVE_SQL = """
SELECT d.uuid, CASE WHEN x.t='data_drop' THEN 'zi_search' ELSE x.t END AS file_type
FROM drive_metadata d
JOIN (SELECT id, replace(lower(trim(name)),' ','_') AS t FROM nodes WHERE kind='folder') x
  ON x.id = replace(trim(both '[]' from d.parents), '''', '')
WHERE d.file_type IS NULL"""


@query("derive_file_types", DERIVE_SQL, ("drive_metadata", "nodes"))
def derive_file_types(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cat.derive_file_types(t.drive_metadata, t.nodes.where(F.col("kind") == "folder"))


@query("apply_file_types", f"""
SELECT d.uuid, coalesce(d.file_type, CASE WHEN x.file_type IN ('city_search','zi_search') THEN x.file_type END) AS file_type
FROM drive_metadata d LEFT JOIN ({DERIVE_SQL}) x ON x.uuid=d.uuid""", ("drive_metadata", "nodes"))
def apply_file_types(spark, sf_dir):
    t = Tables(spark, sf_dir)
    derived = cat.derive_file_types(t.drive_metadata, t.nodes.where(F.col("kind") == "folder"))
    return cat.apply_file_types(t.drive_metadata, derived, BATCH_TS).select("uuid", "file_type")


@query("enum_check", f"""
SELECT uuid, file_type FROM ({DERIVE_SQL}) x WHERE file_type IS NULL OR file_type NOT IN ('city_search','zi_search')""",
       ("drive_metadata", "nodes"))
def enum_check(spark, sf_dir):
    from ..functions.scalar import FILE_TYPE_VALUES
    t = Tables(spark, sf_dir)
    derived = cat.derive_file_types(t.drive_metadata, t.nodes.where(F.col("kind") == "folder"))
    return cat.split_enum(derived, "file_type", FILE_TYPE_VALUES)[1]


@query("mark_processed", """
SELECT d.uuid, d.id, CASE WHEN r.id IS NOT NULL THEN true ELSE d.has_been_processed END AS has_been_processed
FROM drive_metadata d LEFT JOIN (SELECT DISTINCT id FROM drive_metadata
   WHERE (config_file_uuid IS NOT NULL OR file_type='city_search') AND NOT coalesce(has_been_processed, false)) r ON r.id=d.id""",
       ("drive_metadata",))
def mark_processed(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ready = cat.ready_files(t.drive_metadata)
    return cat.mark_processed(t.drive_metadata, ready).select("uuid", "id", "has_been_processed")


@query("rename_ext", """
SELECT uuid, replace(name, 'xlsx', 'csv') AS name FROM drive_metadata""", ("drive_metadata",))
def rename_ext(spark, sf_dir):
    return cat.rename_ext(Tables(spark, sf_dir).drive_metadata).select("uuid", "name")


@query("uuid_by_id", """
SELECT n.id, min(d.uuid) AS uuid FROM new_listing n JOIN drive_metadata d ON d.id=n.id GROUP BY n.id""",
       ("new_listing", "drive_metadata"))
def uuid_by_id(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cat.uuid_by_id(t.drive_metadata, t.new_listing)
