"""Registered queries of the city-search pipeline, franchises and the outbox."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as cat
from ..operators import city as cy
from ..operators import franchises as fr
from ..operators import leads as ld
from ..operators import outbox as ob
from ..sources.fixture_sql import sql_det_uuid, sql_domain_key
from ..sources.fixtures import BATCH_TS
from ..sources.tables import Tables
from .registry import query

_BATCH = "TIMESTAMP '2024-01-29 12:00:00'"
_EMAIL = "coalesce(s.main_point_of_contact_email, s.generic_contact_email)"

CITY_FRESH_SQL = f"""
SELECT e.uuid, e.first_name, e.last_name, '' AS job_title, '' AS job_function, e.email_address, e.main_contact_linkedin,
  e.company_name, e.phone AS phone_number, d.zi_search, d.hubspot_owner, d.name AS file_name, d.id AS file_id,
  e.drive_metadata_uuid
FROM (SELECT s.*, {_EMAIL} AS email_address,
        row_number() OVER (PARTITION BY {_EMAIL} ORDER BY s.created_at DESC NULLS FIRST, s.uuid) AS rn
      FROM city_search_enriched s
      WHERE {_EMAIL} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM sales_customer_view c WHERE c.email={_EMAIL})
        AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.city_search_lead_uuid=s.uuid)
        AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.email_address={_EMAIL})) e
JOIN drive_metadata d ON d.uuid=e.drive_metadata_uuid
WHERE e.rn=1 AND d.config_file_uuid IS NOT NULL"""
CITY_FRESH_VIEWS = ("city_search_enriched", "sales_customer_view", "tracking", "drive_metadata")


def city_fresh(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cy.city_fresh_leads(t.enriched, t.customers, t.tracking, t.drive_metadata)


query("city_fresh_leads", CITY_FRESH_SQL, CITY_FRESH_VIEWS)(city_fresh)

CITY_FRAME_SQL = f"""
SELECT first_name AS "First Name", last_name AS "Last Name", job_title AS "Title", job_function AS "Role",
  email_address AS "Email", main_contact_linkedin AS "Linkedin", company_name AS "Company",
  '="'||coalesce(phone_number,'')||'"' AS "Phone", hubspot_owner AS "Hubspot Owner", zi_search AS "ZI Search",
  file_id, file_name
FROM ({CITY_FRESH_SQL}) f"""


@query("split_generic", f'SELECT * FROM ({CITY_FRAME_SQL}) x WHERE "First Name" IS NULL AND "Last Name" IS NULL',
       CITY_FRESH_VIEWS)
def split_generic(spark, sf_dir):
    return cy.split_generic(ld.output_frame(city_fresh(spark, sf_dir)))


@query("split_personal", f'SELECT * FROM ({CITY_FRAME_SQL}) x WHERE "First Name" IS NOT NULL AND "Last Name" IS NOT NULL',
       CITY_FRESH_VIEWS)
def split_personal(spark, sf_dir):
    return cy.split_personal(ld.output_frame(city_fresh(spark, sf_dir)))


CITY_SHEET_SQL = f"""
SELECT city.uuid, f.franchise_name, f.domain_name, city.type, '' AS first_name, '' AS last_name,
  '' AS "Main Point of Contact Email", '' AS "Main Contact Linkedin", '' AS "Generic Contact Email",
  city.title AS company_name, city.website, city.phone, city.position, city.rating, city.address, city.reviews,
  city.emails_0, city.emails_1, city.emails_2, city.emails_3, d.name AS file_name, d.id AS file_id
FROM city_search city JOIN drive_metadata d ON d.uuid=city.drive_metadata_uuid
LEFT JOIN city_search_franchises f ON {sql_domain_key('f.domain_name')} = {sql_domain_key('city.website')}
WHERE city.dataid NOT IN (SELECT c2.dataid FROM city_search c2
  WHERE c2.drive_metadata_uuid NOT IN (SELECT d2.uuid FROM drive_metadata d2 WHERE d2.id=d.id))"""
CITY_SHEET_VIEWS = ("city_search", "drive_metadata", "city_search_franchises")


def city_sheet(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cy.city_sheet(t.city_search, t.drive_metadata, t.franchises)


query("city_sheet", CITY_SHEET_SQL, CITY_SHEET_VIEWS)(city_sheet)

_PART_COLS = ("uuid, {fr}type, first_name, last_name, \"Main Point of Contact Email\", \"Main Contact Linkedin\", "
              "\"Generic Contact Email\", company_name, website, '=\"'||coalesce(phone,'')||'\"' AS phone, position, rating, address, reviews, "
              "emails_0, emails_1, emails_2, emails_3, "
              "file_id, substring(file_name, 1, 30)||'{suffix}' AS sheet")


@query("city_sheet_franchise",
       f"SELECT {_PART_COLS.format(fr='franchise_name, domain_name, ', suffix='_franchise')} FROM ({CITY_SHEET_SQL}) s "
       "WHERE franchise_name IS NOT NULL", CITY_SHEET_VIEWS)
def city_sheet_franchise(spark, sf_dir):
    return cy.city_sheet_parts(city_sheet(spark, sf_dir))[0]


@query("city_sheet_other",
       f"SELECT {_PART_COLS.format(fr='', suffix='_non_franchise')} FROM ({CITY_SHEET_SQL}) s WHERE franchise_name IS NULL",
       CITY_SHEET_VIEWS)
def city_sheet_other(spark, sf_dir):
    return cy.city_sheet_parts(city_sheet(spark, sf_dir))[1]


@query("not_in_nulls", """
SELECT city.uuid, city.dataid, d.id AS file_id
FROM city_search_nulls city JOIN drive_metadata d ON d.uuid=city.drive_metadata_uuid
WHERE city.dataid NOT IN (SELECT c2.dataid FROM city_search_nulls c2
  WHERE c2.drive_metadata_uuid NOT IN (SELECT d2.uuid FROM drive_metadata d2 WHERE d2.id=d.id))""",
       ("city_search_nulls", "drive_metadata"))
def not_in_nulls(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cy.unseen_elsewhere(t.city_search_nulls, t.drive_metadata).select("uuid", "dataid", "file_id")


@query("city_track_posted", f"""
SELECT uuid, lead_uuid, city_search_lead_uuid, status, email_address, created_at FROM tracking
UNION ALL
SELECT {sql_det_uuid("'posted'", "'city'", 's.uuid', 'NULL')}, CAST(NULL AS BIGINT), s.uuid, 'posted', {_EMAIL}, {_BATCH}
FROM city_search_enriched s
WHERE {_EMAIL} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.city_search_lead_uuid=s.uuid)""",
       ("city_search_enriched", "tracking"))
def city_track_posted(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cy.city_track_posted(t.enriched, t.tracking, BATCH_TS)


_CITY_HIT = (f"EXISTS (SELECT 1 FROM city_search_enriched s JOIN sales_customer_view c ON c.email={_EMAIL} "
             "WHERE s.uuid=t.city_search_lead_uuid)")


@query("city_track_customers", f"""
SELECT t.uuid, t.lead_uuid, t.city_search_lead_uuid,
  CASE WHEN t.status='posted' AND {_CITY_HIT} THEN 'shopify_customer' ELSE t.status END AS status,
  t.email_address, CASE WHEN t.status='posted' AND {_CITY_HIT} THEN {_BATCH} ELSE t.created_at END AS created_at
FROM tracking t
UNION ALL
SELECT {sql_det_uuid("'shopify_customer'", 's.uuid')}, CAST(NULL AS BIGINT), s.uuid, 'shopify_customer', {_EMAIL}, {_BATCH}
FROM city_search_enriched s
WHERE EXISTS (SELECT 1 FROM sales_customer_view c WHERE c.email={_EMAIL})
  AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.city_search_lead_uuid=s.uuid)""",
       ("city_search_enriched", "sales_customer_view", "tracking"))
def city_track_customers(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cy.city_track_customers(t.enriched, t.customers, t.tracking, BATCH_TS)


@query("metrics_city", """
SELECT l.drive_metadata_uuid, d.name,
  CAST(sum(CASE WHEN t.status='shopify_customer' THEN 1 ELSE 0 END) AS BIGINT) AS number_of_shopify_customers,
  CAST(sum(CASE WHEN t.status='posted' THEN 1 ELSE 0 END) AS BIGINT) AS number_of_posted_leads,
  d.created_at
FROM tracking t JOIN city_search_enriched l ON l.uuid=t.city_search_lead_uuid
LEFT JOIN drive_metadata d ON d.uuid=l.drive_metadata_uuid
GROUP BY l.drive_metadata_uuid, d.name, d.created_at""", ("city_search_enriched", "tracking", "drive_metadata"))
def metrics_city(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cy.city_metrics(t.tracking, t.enriched, t.drive_metadata)


# ---- franchises ------------------------------------------------------------------------------

_SRC_SQL = """src AS (SELECT row_no, franchise_name, domain_name FROM (
  SELECT row_no, "Franchise Name" AS franchise_name, "Domain Name" AS domain_name,
    row_number() OVER (PARTITION BY "Domain Name" ORDER BY row_no) AS rn FROM franchise_list) x WHERE rn=1)"""


@query("dedup_franchises", f"WITH {_SRC_SQL} SELECT * FROM src", ("franchise_list",))
def dedup_franchises(spark, sf_dir):
    src = Tables(spark, sf_dir).franchise_list.toDF("row_no", "franchise_name", "domain_name")
    return fr.keep_first(src, "domain_name", "row_no")


@query("upsert_franchises", f"""
WITH {_SRC_SQL}
SELECT t.uuid, t.franchise_name, t.domain_name, t.created_at,
  CASE WHEN EXISTS (SELECT 1 FROM src WHERE src.franchise_name=t.franchise_name AND src.domain_name=t.domain_name)
       THEN {_BATCH} ELSE t.updated_at END AS updated_at
FROM city_search_franchises t
UNION ALL
SELECT {sql_det_uuid("'franchise'", 'row_no', 'franchise_name', 'domain_name')}, franchise_name, domain_name, {_BATCH},
  CAST(NULL AS TIMESTAMP)
FROM src WHERE NOT EXISTS (SELECT 1 FROM city_search_franchises t
                           WHERE t.franchise_name=src.franchise_name AND t.domain_name=src.domain_name)""",
       ("franchise_list", "city_search_franchises"))
def upsert_franchises(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return fr.upsert_franchises(t.franchises, t.franchise_list, BATCH_TS)


# ---- outbox ----------------------------------------------------------------------------------

_NL = "chr(10)"


@query("outbox_missing_config", f"""
SELECT uuid, {_NL}||'Missing Config File: '||coalesce(name,'None')||{_NL}||'Created At: '
  ||coalesce(strftime(created_at, '%Y-%m-%d %H:%M:%S'),'None')||{_NL}||'Last Modified By: '
  ||coalesce(lastmodifyinguser_displayname,'None')||{_NL}||'file_type: '||coalesce(file_type,'None')||{_NL}
  ||'Please update this file so an output file can be created.'||{_NL} AS text
FROM drive_metadata
WHERE config_file_uuid IS NULL AND has_posted_on_slack IS NULL AND file_type NOT IN ('city_search')""",
       ("drive_metadata",))
def outbox_missing_config(spark, sf_dir):
    return ob.missing_config_messages(cat.missing_config(Tables(spark, sf_dir).drive_metadata))


@query("outbox_metrics", f"""
SELECT name, drive_metadata_uuid, {_NL}||name||':'||{_NL}||'Number of Leads: '||number_of_posted_leads||{_NL}
  ||'Number of Shopify Customers: '||number_of_shopify_customers||{_NL} AS text
FROM (SELECT l.drive_metadata_uuid, d.name,
        sum(CASE WHEN t.status='shopify_customer' THEN 1 ELSE 0 END) AS number_of_shopify_customers,
        sum(CASE WHEN t.status='posted' THEN 1 ELSE 0 END) AS number_of_posted_leads
      FROM tracking t JOIN leads l ON l.uuid=t.lead_uuid LEFT JOIN drive_metadata d ON d.uuid=l.drive_metadata_uuid
      GROUP BY l.drive_metadata_uuid, d.name) m
WHERE name IS NOT NULL""", ("leads", "tracking", "drive_metadata"))
def outbox_metrics(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return ob.metrics_messages(ld.status_metrics(t.tracking, t.leads, t.drive_metadata))


@query("outbox_sheet_ready", f"""
SELECT DISTINCT file_id, 'City Search Output/'||substring(file_name,1,30)||'_non_franchise' AS link, file_name AS sheet_name,
  'Hi <@sales-owner>, <City Search Output/'||substring(file_name,1,30)||'_non_franchise|City Search - '||file_name
  ||' is ready to be dispersed.>' AS text
FROM ({CITY_SHEET_SQL}) s""", CITY_SHEET_VIEWS)
def outbox_sheet_ready(spark, sf_dir):
    sheets = city_sheet(spark, sf_dir).select(
        "file_id", F.concat(F.lit("City Search Output/"), F.substring("file_name", 1, 30), F.lit("_non_franchise")).alias("link"),
        F.col("file_name").alias("sheet_name")).distinct()
    return ob.sheet_ready_messages(sheets, owner="sales-owner")
