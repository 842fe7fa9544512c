"""Oracle SQL (DuckDB) for the pipeline queries: what the sync and the streams must leave behind,
derived independently from the driver tables."""

from __future__ import annotations

from ..schemas import ENRICHED_DATA_COLUMNS
from ..sources.fixture_sql import sql_det_uuid, sql_keyed_rows, with_views

_EXT = "CASE WHEN s_suppkey%3=0 THEN '.xlsx' ELSE '.csv' END"


def sync_sql() -> str:
    """R-1: catalog + new listed files, file types from parent folders, config, notice flags."""
    new_uuid = sql_det_uuid("'file'", "'id'||(s_suppkey+5)")
    cfg_uuid = sql_det_uuid("'config'", "c1.uuid", "c.filename")
    sql = f"""
WITH c0 AS (
  SELECT uuid, id, name, parents, file_type, config_file_uuid, has_posted_on_slack FROM drive_metadata
  UNION ALL
  SELECT {new_uuid}, 'id'||(s_suppkey+5), s_name||{_EXT}, '[''n'||s_nationkey||''']', NULL, NULL, NULL
  FROM supplier WHERE NOT EXISTS (SELECT 1 FROM drive_metadata d WHERE d.id='id'||(s_suppkey+5))),
ft AS (SELECT c0.uuid, CASE WHEN x.t='data_drop' THEN 'zi_search' ELSE x.t END AS t
       FROM c0 JOIN (SELECT id, replace(lower(trim(name)),' ','_') AS t FROM nodes WHERE kind='folder') x
         ON x.id=replace(trim(both '[]' from c0.parents), '''', '')
       WHERE c0.file_type IS NULL),
c1 AS (SELECT c0.uuid, c0.id, c0.name, c0.config_file_uuid, c0.has_posted_on_slack,
         coalesce(c0.file_type, CASE WHEN ft.t IN ('city_search','zi_search') THEN ft.t END) AS file_type
       FROM c0 LEFT JOIN ft ON ft.uuid=c0.uuid),
c2 AS (SELECT c1.uuid, c1.id, c1.name, c1.file_type, c1.has_posted_on_slack,
         CASE WHEN c1.config_file_uuid IS NULL AND c.filename IS NOT NULL THEN {cfg_uuid}
              ELSE c1.config_file_uuid END AS config_file_uuid
       FROM c1 LEFT JOIN config_sheet c ON c.filename=c1.name)
SELECT uuid, id, name, file_type, config_file_uuid,
  CASE WHEN config_file_uuid IS NULL AND has_posted_on_slack IS NULL THEN true ELSE has_posted_on_slack END
    AS has_posted_on_slack
FROM c2"""
    return with_views(sql, "drive_metadata", "nodes", "config_sheet")


# The catalog that the first run leaves where there was none: all suppliers' files are new.
_FIRST_RUN = f"""
WITH listed AS (SELECT s_suppkey AS k, 'id'||s_suppkey AS id, s_name||{_EXT} AS name, 'n'||s_nationkey AS parent FROM supplier),
typed AS (SELECT l.k, l.id, l.name, l.parent, {sql_det_uuid("'file'", "l.id")} AS uuid,
            CASE replace(lower(trim(f.name)),' ','_') WHEN 'data_drop' THEN 'zi_search' WHEN 'zi_search' THEN 'zi_search'
              WHEN 'city_search' THEN 'city_search' END AS file_type
          FROM listed l LEFT JOIN nodes f ON f.id=l.parent AND f.kind='folder'),
c AS (SELECT t.*, CASE WHEN s.filename IS NOT NULL THEN {sql_det_uuid("'config'", "t.uuid", "s.filename")} END AS config_file_uuid
      FROM typed t LEFT JOIN config_sheet s ON s.filename=t.name),
ready AS (SELECT * FROM c WHERE config_file_uuid IS NOT NULL OR file_type='city_search')"""


def timer_catalog_sql() -> str:
    """R-1 on an empty catalog: the catalog's columns that the run fills."""
    return with_views(_FIRST_RUN + """
SELECT uuid, id, name, file_type, config_file_uuid, CASE WHEN config_file_uuid IS NULL THEN true END AS has_posted_on_slack,
  'user'||(k%4) AS lastmodifyinguser_displayname, '['||chr(39)||parent||chr(39)||']' AS parents,
  TIMESTAMP '2024-01-29 12:00:00' AS created_at
FROM c""", "nodes", "config_sheet")


def timer_notices_sql() -> str:
    return with_views(_FIRST_RUN + """
SELECT uuid, chr(10)||'Missing Config File: '||name||chr(10)||'Created At: 2024-01-29 12:00:00'||chr(10)||'Last Modified By: user'
  ||(k%4)||chr(10)||'file_type: '||file_type||chr(10)||'Please update this file so an output file can be created.'||chr(10) AS text
FROM c WHERE config_file_uuid IS NULL AND file_type<>'city_search'""", "nodes", "config_sheet")


def timer_landed_sql(ingest_sql: str) -> str:
    """``ingest_sql``: the rows of all vendor files with their ``file_id``; those of the ready files have landed."""
    return with_views(_FIRST_RUN + f"""
SELECT r.* EXCLUDE (drive_metadata_uuid), ready.uuid AS drive_metadata_uuid
FROM ({ingest_sql}) r JOIN ready ON ready.id=r.file_id""", "drive_metadata", "nodes", "config_sheet")


def tracking_after(ctes: str, email: str, key: str, new_key: tuple[str, ...]) -> str:
    """Tracking rows after a run, from the CTEs ``raw`` (all rows) and ``e`` (ranked): old rows, a 'posted' row
    for each untracked row of a file that sent something, and customers marked among them."""
    return f"""{ctes.rstrip().rstrip(",")},
sent AS (SELECT DISTINCT e.drive_metadata_uuid AS f FROM e JOIN drive_metadata d ON d.uuid=e.drive_metadata_uuid
         WHERE e.rn=1 AND d.config_file_uuid IS NOT NULL),
r AS (SELECT raw.* FROM raw JOIN sent ON sent.f=raw.drive_metadata_uuid),
t AS (SELECT uuid, CAST({key} AS VARCHAR) AS {key}, status, email_address FROM tracking
      UNION ALL
      SELECT {sql_det_uuid(*new_key)}, r.uuid, 'posted', {email} FROM r
      WHERE {email} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tracking o WHERE CAST(o.{key} AS VARCHAR)=r.uuid)),
hit AS (SELECT r.uuid FROM r WHERE EXISTS (SELECT 1 FROM sales_customer_view c WHERE c.email={email}))
SELECT uuid, {key}, CASE WHEN status='posted' AND {key} IN (SELECT uuid FROM hit) THEN 'shopify_customer' ELSE status END AS status,
  email_address FROM t"""


def outbox_after(tracking_sql: str, key: str, line: str = "''") -> str:
    """Notices after a run, from the SQL of its tracking rows: posted leads and customers by file, and ``line``."""
    at = tracking_sql.rindex("SELECT uuid, " + key)
    return f"""{tracking_sql[:at].rstrip()},
after AS ({tracking_sql[at:]}),
m AS (SELECT r.drive_metadata_uuid AS f, count(*) FILTER (WHERE a.status='posted') AS p,
        count(*) FILTER (WHERE a.status='shopify_customer') AS s
      FROM after a JOIN r ON r.uuid=a.{key} GROUP BY 1)
SELECT d.name, m.f AS drive_metadata_uuid, chr(10)||d.name||':'||chr(10)||'Number of Leads: '||m.p||chr(10)
  ||'Number of Shopify Customers: '||m.s||chr(10)||{line} AS text
FROM m JOIN drive_metadata d ON d.uuid=m.f"""


def stream_enriched_sql(tracking: bool = False) -> str:
    """R-4: enriched files (every catalogued file), raw rows with content uuids; latest contact
    per coalesced e-mail on the fixture tracking; personal and generic sheets."""
    values = {
        "first_name": "CASE WHEN o_orderkey%5<>0 THEN 'F'||o_custkey END",
        "last_name": "CASE WHEN o_orderkey%5 NOT IN (0,1) THEN 'L'||o_custkey END",
        "main_point_of_contact_email": "CASE WHEN o_orderkey%3<>0 THEN 'c'||o_custkey||'@x.com' END",
        "main_contact_linkedin": "'https://linkedin.example/in/c'||o_custkey",
        "generic_contact_email": "CASE WHEN o_orderkey%4<>0 THEN 'info'||(o_custkey%200)||'@y.com' END",
        "company_name": "'Co'||(o_custkey%97)",
        "website": "CAST(NULL AS VARCHAR)",
        "phone": "CASE WHEN o_orderkey%7<>0 THEN '777'||o_orderkey END",
    }
    cols = ",\n    ".join(f"{values[c]} AS {c}" for c in ENRICHED_DATA_COLUMNS)
    uid = sql_det_uuid("drive_metadata_uuid", *ENRICHED_DATA_COLUMNS)
    email = "coalesce(r.main_point_of_contact_email, r.generic_contact_email)"
    sql = f"""
WITH raw0 AS (
  SELECT d.uuid AS drive_metadata_uuid,
    {cols}
  FROM orders JOIN drive_metadata d ON d.id='id'||(o_orderkey//150)),
raw AS ({sql_keyed_rows("raw0", uid)}),
e AS (SELECT r.*, {email} AS email_address,
        row_number() OVER (PARTITION BY {email} ORDER BY r.uuid) AS rn
      FROM raw r
      WHERE {email} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM sales_customer_view c WHERE c.email={email})
        AND NOT EXISTS (SELECT 1 FROM tracking t WHERE CAST(t.city_search_lead_uuid AS VARCHAR)=r.uuid)
        AND NOT EXISTS (SELECT 1 FROM tracking t WHERE t.email_address={email})),
f AS (SELECT e.first_name AS "First Name", e.last_name AS "Last Name", '' AS "Title", '' AS "Role",
        e.email_address AS "Email", e.main_contact_linkedin AS "Linkedin", e.company_name AS "Company",
        '="'||coalesce(e.phone, '')||'"' AS "Phone", d.hubspot_owner AS "Hubspot Owner", d.zi_search AS "ZI Search",
        d.id AS file_id, d.name AS file_name
      FROM e JOIN drive_metadata d ON d.uuid=e.drive_metadata_uuid
      WHERE e.rn=1 AND d.config_file_uuid IS NOT NULL)
SELECT "First Name", "Last Name", CAST(NULL AS VARCHAR) AS "Title", CAST(NULL AS VARCHAR) AS "Role", "Email", "Linkedin",
  "Company", "Phone", "Hubspot Owner", "ZI Search", file_id, 'Quick Mail Output - Week 5' AS book, file_name AS sheet
FROM f WHERE "First Name" IS NOT NULL AND "Last Name" IS NOT NULL
UNION ALL
SELECT "First Name", "Last Name", NULL, NULL, "Email", "Linkedin", "Company", "Phone", "Hubspot Owner", "ZI Search",
  file_id, 'Quick Mail Output - Week 5', 'Generic of '||file_name
FROM f WHERE "First Name" IS NULL AND "Last Name" IS NULL"""
    if tracking:
        sql = tracking_after(sql[:sql.index("f AS (SELECT e.first_name")], email, "city_search_lead_uuid",
                             ("'posted'", "'city'", "r.uuid", "NULL"))
    return with_views(sql, "drive_metadata", "sales_customer_view", "tracking")


def stream_city_sql() -> str:
    """R-3: franchises upserted from the master list first; listing files loaded with the table's
    columns (P-5, others NULL); both sheets of every file recomputed."""
    from ..schemas import CITY_SEARCH_DATA_COLUMNS
    from .q_city import CITY_SHEET_SQL
    present = {"type": "c.type", "phone": "c.phone", "title": "c.title", "dataid": "c.dataid", "website": "c.website",
               **{x: f"c.{x}" for x in ("address", "position", "rating", "reviews", "emails_0", "emails_1", "emails_2", "emails_3")}}
    cols = ",\n    ".join(f"{present.get(x, 'CAST(NULL AS VARCHAR)')} AS {x}" for x in CITY_SEARCH_DATA_COLUMNS)
    uid = sql_det_uuid("drive_metadata_uuid", *CITY_SEARCH_DATA_COLUMNS)
    ins = sql_det_uuid("'franchise'", "row_no", "franchise_name", "domain_name")
    sheet = CITY_SHEET_SQL.replace("city_search_franchises", "fr").replace("city_search", "raw")
    blanks = ('CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name, '
              'CAST(NULL AS VARCHAR) AS "Main Point of Contact Email", CAST(NULL AS VARCHAR) AS "Main Contact Linkedin", '
              'CAST(NULL AS VARCHAR) AS "Generic Contact Email"')
    tail = "company_name, website, '=\"'||coalesce(phone,'')||'\"' AS phone, position, rating, address, reviews, emails_0, emails_1, emails_2, emails_3, file_id, 'City Search Output - Week 5' AS book"
    sql = f"""
WITH src AS (SELECT row_no, franchise_name, domain_name FROM (
  SELECT row_no, "Franchise Name" AS franchise_name, "Domain Name" AS domain_name,
    row_number() OVER (PARTITION BY "Domain Name" ORDER BY row_no) AS rn FROM franchise_list) x WHERE rn=1),
fr AS (SELECT uuid, franchise_name, domain_name FROM city_search_franchises
       UNION ALL
       SELECT {ins}, franchise_name, domain_name FROM src
       WHERE NOT EXISTS (SELECT 1 FROM city_search_franchises t
                         WHERE t.franchise_name=src.franchise_name AND t.domain_name=src.domain_name)),
raw0 AS (SELECT d.uuid AS drive_metadata_uuid,
    {cols}
  FROM city_search c JOIN drive_metadata d ON d.id='id'||(c.uuid%10)),
raw AS ({sql_keyed_rows("raw0", uid)}),
s AS ({sheet})
SELECT uuid, franchise_name, domain_name, type, {blanks}, {tail}, substring(file_name,1,30)||'_franchise' AS sheet
FROM s WHERE franchise_name IS NOT NULL
UNION ALL
SELECT uuid, NULL, NULL, type, {blanks}, {tail}, substring(file_name,1,30)||'_non_franchise'
FROM s WHERE franchise_name IS NULL"""
    return with_views(sql, "drive_metadata", "city_search", "city_search_franchises", "franchise_list")


def stream_enriched_outbox_sql() -> str:
    """R-4: one notice for each file that sent something, with the link to the book."""
    return outbox_after(stream_enriched_sql(tracking=True), "city_search_lead_uuid",
                        "chr(10)||'Spreadsheet: <sheets/Quick Mail Output - Week 5|Quick Mail Output - Week 5 - '||d.name||'>'")


def stream_city_outbox_sql() -> str:
    """R-3: one notice for each sheet with rows."""
    return f"""
SELECT DISTINCT file_id, 'sheets/'||book||'/'||sheet AS link, sheet AS sheet_name,
  'Hi <@sales-owner>, <sheets/'||book||'/'||sheet||'|City Search - '||sheet||' is ready to be dispersed.>' AS text
FROM ({stream_city_sql()}) written"""
