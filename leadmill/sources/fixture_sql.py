"""The fixture views of ``fixtures.py`` as DuckDB SQL text, for the oracle queries.

``with_views(sql, names)`` prefixes a query with ``WITH`` clauses for the views it names, so the
oracle needs no extra registered views. Keep every view equal to its DataFrame twin.
"""

from __future__ import annotations

_EXT = "CASE WHEN {k}%3=0 THEN '.xlsx' ELSE '.csv' END"
_FOLDER_TYPE = ("CASE {k}%5 WHEN 0 THEN 'ZI Search' WHEN 1 THEN ' City Search ' WHEN 2 THEN 'Data Drop' "
                "WHEN 3 THEN 'city_search' ELSE 'Archive Box' END")
_HOST = ("replace(CASE WHEN {u} LIKE '%http://%' OR {u} LIKE '%https://%' "
         "THEN regexp_extract({u}, 'https?://([^/]*)', 1) ELSE {u} END, 'www.', '')")

VIEWS: dict[str, str] = {
    "drive_metadata": f"""
SELECT 'f'||s_suppkey AS uuid, 'id'||s_suppkey AS id, s_name||{_EXT.format(k='s_suppkey')} AS name,
  CASE WHEN s_suppkey%4=0 THEN 'city_search' WHEN s_suppkey%4=3 THEN NULL ELSE 'zi_search' END AS file_type,
  CASE WHEN s_suppkey%5<>0 THEN 'cfg'||s_suppkey END AS config_file_uuid,
  CASE WHEN s_suppkey%5<>0 THEN 'owner'||(s_suppkey%3) END AS hubspot_owner,
  CASE WHEN s_suppkey%5<>0 THEN 'search'||s_suppkey END AS zi_search,
  CASE WHEN s_suppkey%10=0 THEN true END AS has_posted_on_slack,
  CASE WHEN s_suppkey%7=0 THEN true WHEN s_suppkey%7=1 THEN false END AS has_been_processed,
  'n'||s_nationkey AS parent, '[''n'||s_nationkey||''']' AS parents,
  'user'||(s_suppkey%4) AS lastmodifyinguser_displayname,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 DAY * (s_suppkey%28) AS created_at
FROM supplier""",
    "leads": """
SELECT o_orderkey AS uuid, 'f'||(o_orderkey//150) AS drive_metadata_uuid,
  'F'||o_custkey AS first_name, 'L'||o_custkey AS last_name, substring(o_orderpriority, 3, 20) AS job_title,
  o_orderstatus AS job_function,
  CASE WHEN o_orderkey%17=0 THEN NULL WHEN o_orderkey%23=0 THEN '' ELSE 'c'||o_custkey||'@x.com' END AS email_address,
  'https://linkedin.example/in/c'||o_custkey AS linkedin_contact_profile_url, 'Co'||(o_custkey%97) AS company_name,
  CASE WHEN o_orderkey%2<>0 THEN '555'||o_orderkey END AS mobile_phone,
  CASE WHEN o_orderkey%3<>0 THEN '777'||o_orderkey END AS direct_phone_number,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'Canada' ELSE 'United States' END AS company_country,
  o_orderdate AS created_at
FROM orders""",
    "sales_customer_view": """
SELECT 'c'||c_custkey||'@x.com' AS email FROM customer WHERE c_mktsegment='BUILDING'""",
    "tracking": """
SELECT 't'||o_orderkey AS uuid,
  CASE WHEN o_orderdate < TIMESTAMP '1995-03-01 00:00:00' THEN o_orderkey END AS lead_uuid,
  CASE WHEN o_orderdate >= TIMESTAMP '2001-06-01 00:00:00' THEN o_orderkey END AS city_search_lead_uuid,
  CASE WHEN o_orderkey%3=0 THEN 'emailed' ELSE 'posted' END AS status,
  'c'||o_custkey||'@x.com' AS email_address, o_orderdate AS created_at
FROM orders WHERE o_orderdate < TIMESTAMP '1995-03-01 00:00:00' OR o_orderdate >= TIMESTAMP '2001-06-01 00:00:00'""",
    "city_search": """
SELECT page_id AS uuid, 'f'||(page_id%10) AS drive_metadata_uuid,
  CASE WHEN page_id%4=0 THEN 'chain' ELSE 'local' END AS type,
  CASE WHEN page_id%5<>0 THEN '+1-303-'||page_id END AS phone, 'Biz '||page_id AS title,
  CASE WHEN page_id%6=0 THEN 'd'||(page_id%37) ELSE 'u'||page_id END AS dataid,
  CASE WHEN page_id%13<>0 THEN url END AS website, 'addr '||page_id AS address,
  CASE WHEN page_id%2=0 THEN 'hello'||page_id||'@biz.com' END AS emails_0,
  CAST(page_id%20+1 AS VARCHAR) AS position,
  CASE WHEN page_id%3<>0 THEN '4.'||(page_id%10) END AS rating,
  CASE WHEN page_id%3<>0 THEN CAST(page_id%300 AS VARCHAR) END AS reviews,
  CASE WHEN page_id%4=0 THEN 'sales'||page_id||'@biz.com' END AS emails_1,
  CASE WHEN page_id%8=0 THEN 'info'||page_id||'@biz.com' END AS emails_2,
  CASE WHEN page_id%16=0 THEN 'desk'||page_id||'@biz.com' END AS emails_3
FROM pages""",
    "city_search_nulls": """
SELECT page_id AS uuid, 'f'||(page_id%10) AS drive_metadata_uuid,
  CASE WHEN page_id%10=1 AND page_id%3=0 THEN NULL WHEN page_id%6=0 THEN 'd'||(page_id%37) ELSE 'u'||page_id END AS dataid,
  CASE WHEN page_id%13<>0 THEN url END AS website
FROM pages""",
    "city_search_franchises": f"""
SELECT 'fr'||m AS uuid, 'Franchise '||m AS franchise_name,
  CASE WHEN m%2=0 THEN 'https://www.'||host||'/store' ELSE host END AS domain_name,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
FROM (SELECT host, min(page_id) AS m FROM (SELECT page_id, {_HOST.format(u='url')} AS host FROM pages) p
      WHERE host LIKE '%.example.org' GROUP BY host) g""",
    "franchise_list": f"""
SELECT page_id AS row_no, 'Franchise '||page_id AS "Franchise Name", host AS "Domain Name"
FROM (SELECT page_id, {_HOST.format(u='url')} AS host FROM pages) p WHERE host LIKE '%.example.org'""",
    "city_search_enriched": """
SELECT o_orderkey AS uuid, 'f'||(o_orderkey//150) AS drive_metadata_uuid,
  CASE WHEN o_orderkey%5<>0 THEN 'F'||o_custkey END AS first_name,
  CASE WHEN o_orderkey%5 NOT IN (0,1) THEN 'L'||o_custkey END AS last_name,
  CASE WHEN o_orderkey%3<>0 THEN 'c'||o_custkey||'@x.com' END AS main_point_of_contact_email,
  'https://linkedin.example/in/c'||o_custkey AS main_contact_linkedin,
  CASE WHEN o_orderkey%4<>0 THEN 'info'||(o_custkey%200)||'@y.com' END AS generic_contact_email,
  'Co'||(o_custkey%97) AS company_name,
  CASE WHEN o_orderkey%7<>0 THEN '777'||o_orderkey END AS phone,
  CASE WHEN o_orderkey%9<>0 THEN o_orderdate END AS created_at
FROM orders""",
    "new_listing": """
SELECT 'id'||(s_suppkey+5) AS id, s_name AS name FROM supplier""",
    "config_sheet": f"""
SELECT CASE WHEN s_acctbal < 500.0 THEN 'no such file '||s_suppkey ELSE s_name||{_EXT.format(k='s_suppkey')} END AS filename,
  'owner'||(s_suppkey%3) AS hubspot_owner, 'search'||s_suppkey AS zi_search
FROM supplier WHERE s_acctbal < 3000.0""",
    "folder_names": f"""
SELECT 'n'||n_nationkey AS id, {_FOLDER_TYPE.format(k='n_nationkey')} AS name FROM nation""",
    "nodes": f"""
SELECT 'r'||r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent, r_name AS name, 'folder' AS kind, false AS trashed,
  TIMESTAMP '2024-01-01 00:00:00' AS created_time, TIMESTAMP '2024-01-01 00:00:00' AS modified_time,
  CAST(NULL AS VARCHAR) AS file_extension FROM region
UNION ALL SELECT 'n'||n_nationkey, 'r'||n_regionkey, {_FOLDER_TYPE.format(k='n_nationkey')}, 'folder', false,
  TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 00:00:00', CAST(NULL AS VARCHAR) FROM nation
UNION ALL SELECT 'p'||n_nationkey, 'n'||n_nationkey, 'Processed', 'folder', false,
  TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 00:00:00', CAST(NULL AS VARCHAR) FROM nation WHERE n_nationkey%3=0
UNION ALL SELECT 'id'||s_suppkey,
  CASE WHEN s_suppkey%6=5 AND s_nationkey%3=0 THEN 'p'||s_nationkey ELSE 'n'||s_nationkey END,
  s_name||{_EXT.format(k='s_suppkey')}, 'file', s_suppkey%11=10,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 DAY * (s_suppkey%28),
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 DAY * (s_suppkey%28) + INTERVAL 1 DAY * (s_suppkey%5),
  substring({_EXT.format(k='s_suppkey')}, 2, 4) FROM supplier""",
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with ``WITH`` definitions of the named fixture views (in dependency order)."""
    body = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    sql = sql.strip()
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {body},\n{sql[len('WITH RECURSIVE '):]}"
    if sql.upper().startswith("WITH "):
        return f"WITH {body},\n{sql[5:]}"
    return f"WITH {body}\n{sql}"


def sql_det_uuid(*exprs: str) -> str:
    """DuckDB text of ``functions.scalar.det_uuid`` over SQL expressions."""
    parts = ", ".join(f"coalesce(length(CAST({e} AS VARCHAR))||':'||CAST({e} AS VARCHAR), 'n')" for e in exprs)
    h = f"md5(concat({parts}))"
    return (f"(substr({h},1,8)||'-'||substr({h},9,4)||'-'||substr({h},13,4)||'-'||substr({h},17,4)"
            f"||'-'||substr({h},21,12))")


def sql_keyed_rows(rows: str, uid: str) -> str:
    """DuckDB text of ``operators.align.row_uuid``: ``rows`` with ``uuid``, equal rows numbered from the second on."""
    return (f"SELECT * EXCLUDE (u0, nth), CASE WHEN nth=1 THEN u0 ELSE {sql_det_uuid(chr(39) + 'repeat' + chr(39), 'u0', 'nth')} END AS uuid "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY u0) AS nth FROM (SELECT *, {uid} AS u0 FROM {rows}) x) y")


def sql_domain_key(col: str) -> str:
    """DuckDB text of ``functions.scalar.domain_key``."""
    return (f"replace(coalesce(CASE WHEN regexp_matches({col}, 'https?://([^/]*)') "
            f"THEN regexp_extract({col}, 'https?://([^/]*)', 1) END, {col}), 'www.', '')")
