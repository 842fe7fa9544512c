"""Registered queries over the drive listing (S-1 … S-5, J-9, J-10, P-14, O-1, P-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as X
from ..functions.headers import clean_headers
from ..operators import listing as ls
from ..sources import fixtures as fx
from ..sources.fixtures import NOW
from ..sources.tables import Tables
from .registry import query

_DAY_BOUND = "TIMESTAMP '2024-01-22 00:00:00'"      # date_trunc(NOW) - 7 days
_SENSOR_BOUND = "TIMESTAMP '2024-01-29 11:59:00'"   # NOW - 60 s


@query("recent_files_recursive", f"""
WITH RECURSIVE walk(root, folder) AS (
  SELECT id, id FROM nodes WHERE parent IS NULL
  UNION ALL
  SELECT w.root, n.id FROM walk w JOIN nodes n ON n.parent=w.folder
  WHERE n.kind='folder' AND NOT coalesce(n.trashed, false) AND n.name<>'Processed')
SELECT w.root, f.id, f.name, f.parent, f.created_time, f.modified_time, f.file_extension
FROM walk w JOIN nodes f ON f.parent=w.folder
WHERE f.kind='file' AND NOT coalesce(f.trashed, false) AND f.name<>'Processed'
  AND (f.modified_time >= {_DAY_BOUND} OR f.created_time >= {_DAY_BOUND})""", ("nodes",))
def recent_files_recursive(spark, sf_dir):
    n = Tables(spark, sf_dir).nodes
    return ls.recent_files_recursive(n, n.where(F.col("parent").isNull()), NOW, 7)


@query("folder_children", """
SELECT parent, id, name, kind FROM nodes WHERE parent IS NOT NULL AND NOT coalesce(trashed, false) AND name<>'Processed'""",
       ("nodes",))
def folder_children(spark, sf_dir):
    return ls.children(Tables(spark, sf_dir).nodes).select("parent", "id", "name", "kind")


@query("recent_files_flat", f"""
SELECT id, name, modified_time FROM nodes
WHERE kind<>'folder' AND NOT coalesce(trashed, false) AND (modified_time > {_DAY_BOUND} OR created_time > {_DAY_BOUND})""",
       ("nodes",))
def recent_files_flat(spark, sf_dir):
    return ls.recent_files_flat(Tables(spark, sf_dir).nodes, NOW, 7).select("id", "name", "modified_time")


@query("recent_files_sensor", f"""
SELECT id, name, modified_time FROM nodes
WHERE kind<>'folder' AND NOT coalesce(trashed, false) AND (modified_time > {_SENSOR_BOUND} OR created_time > {_SENSOR_BOUND})""",
       ("nodes",))
def recent_files_sensor(spark, sf_dir):
    return ls.recent_files_flat(Tables(spark, sf_dir).nodes, NOW, sensor=True).select("id", "name", "modified_time")


@query("folder_lookup", """
SELECT f.id, f.name, f.parent IS NULL AS is_root, coalesce(k.n, 0) AS n_child_folders, k.pid AS processed_folder_id
FROM nodes f LEFT JOIN (SELECT parent, count(*) AS n, min(CASE WHEN name='Processed' THEN id END) AS pid
                        FROM nodes WHERE kind='folder' AND NOT coalesce(trashed, false) AND parent IS NOT NULL
                        GROUP BY parent) k ON k.parent=f.id
WHERE f.kind='folder' AND NOT coalesce(f.trashed, false)""", ("nodes",))
def folder_lookup(spark, sf_dir):
    return ls.folder_lookup(Tables(spark, sf_dir).nodes)


@query("parent_folder_name", """
SELECT f.id, f.name, f.parent, p.name AS parent_name, f.file_extension,
  trim(lower(replace(p.name, ' ', '_'))) AS landing_folder
FROM nodes f LEFT JOIN nodes p ON p.id=f.parent WHERE f.kind='file'""", ("nodes",))
def parent_folder_name(spark, sf_dir):
    out = ls.parent_names(Tables(spark, sf_dir).nodes)
    return out.withColumn("landing_folder", X.landing_folder(F.col("parent_name")))


@query("folder_parents", """
SELECT DISTINCT f.id, f.name, f.parent, p.name AS parent_name
FROM nodes f JOIN nodes p ON p.id=f.parent
WHERE f.kind='folder' AND NOT coalesce(f.trashed, false) AND p.kind='folder' AND NOT coalesce(p.trashed, false)""",
       ("nodes",))
def folder_parents(spark, sf_dir):
    return ls.folder_parents(Tables(spark, sf_dir).nodes)


@query("folder_ancestors", """
WITH RECURSIVE up(id, anc, lvl) AS (
  SELECT id, parent, 1 FROM nodes WHERE parent IS NOT NULL
  UNION ALL SELECT up.id, n.parent, up.lvl+1 FROM up JOIN nodes n ON n.id=up.anc WHERE n.parent IS NOT NULL)
SELECT up.id, up.lvl, n.name FROM up JOIN nodes n ON n.id=up.anc""", ("nodes",))
def folder_ancestors(spark, sf_dir):
    return ls.ancestors(Tables(spark, sf_dir).nodes)


_FLAT_SQL = """
SELECT 'id'||s_suppkey AS id, s_name||CASE WHEN s_suppkey%3=0 THEN '.xlsx' ELSE '.csv' END AS name,
  '[''n'||s_nationkey||''']' AS parents, '[''owner'||(s_suppkey%3)||'@corp.com'']' AS owners,
  'user'||(s_suppkey%4) AS lastmodifyinguser_displayname, 'drive#user' AS lastmodifyinguser_kind,
  CASE WHEN s_suppkey%2=0 THEN 'True' ELSE 'False' END AS lastmodifyinguser_me,
  'perm'||s_suppkey AS lastmodifyinguser_permissionid,
  CASE WHEN s_suppkey%6<>0 THEN 'user'||(s_suppkey%4)||'@corp.com' END AS lastmodifyinguser_emailaddress,
  CASE WHEN s_suppkey%3=0 THEN 'xlsx' ELSE 'csv' END AS fileextension
FROM supplier"""


@query("flatten_listing", _FLAT_SQL)
def flatten_listing(spark, sf_dir):
    return clean_headers(ls.flatten_records(Tables(spark, sf_dir).listing_records))


@query("clean_headers", _FLAT_SQL)
def clean_headers_q(spark, sf_dir):
    """P-1 on the flattened API names ('lastModifyingUser.displayName' -> 'lastmodifyinguser_displayname')."""
    return clean_headers(ls.flatten_records(Tables(spark, sf_dir).listing_records))


@query("union_listings", f"""
SELECT id, name, parents, owners, lastmodifyinguser_displayname, lastmodifyinguser_kind, lastmodifyinguser_me,
  lastmodifyinguser_permissionid, lastmodifyinguser_emailaddress, fileextension FROM ({_FLAT_SQL}) a
UNION ALL
SELECT id, name, '['''||parent||''']', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM nodes WHERE kind='folder' AND parent IS NOT NULL""",
       ("nodes",))
def union_listings(spark, sf_dir):
    t = Tables(spark, sf_dir)
    files = clean_headers(ls.flatten_records(t.listing_records))
    folders = t.nodes.where((F.col("kind") == "folder") & F.col("parent").isNotNull()).select(
        "id", "name", ls.py_list_text(F.array(F.col("parent"))).alias("parents"))
    return ls.union_listings(files, folders)


@query("scalar_parent_text", """
SELECT uuid, parents, replace(trim(both '[]' from parents), '''', '') AS parent FROM drive_metadata""",
       ("drive_metadata",))
def scalar_parent_text(spark, sf_dir):
    d = Tables(spark, sf_dir).drive_metadata
    return d.select("uuid", "parents", X.parent_from_text(F.col("parents")).alias("parent"))


@query("scalar_file_type", """
SELECT id, name, CASE WHEN replace(lower(trim(name)),' ','_')='data_drop' THEN 'zi_search'
                      ELSE replace(lower(trim(name)),' ','_') END AS file_type,
  trim(lower(replace(name,' ','_'))) AS landing_folder
FROM nodes WHERE kind='folder'""", ("nodes",))
def scalar_file_type(spark, sf_dir):
    n = Tables(spark, sf_dir).nodes.where(F.col("kind") == "folder")
    return n.select("id", "name", X.file_type_from_folder(F.col("name")).alias("file_type"),
                    X.landing_folder(F.col("name")).alias("landing_folder"))


_RECORDS_SQL = """
SELECT 'id'||s_suppkey AS id, s_name||CASE WHEN s_suppkey%3=0 THEN '.xlsx' ELSE '.csv' END AS name,
  '[''n'||s_nationkey||''''||CASE WHEN s_suppkey%4=1 THEN ', ''shared''' ELSE '' END||']' AS parents,
  '[{''displayName'': ''user'||(s_suppkey%4)||''', ''me'': '||CASE WHEN s_suppkey%2=0 THEN 'True' ELSE 'False' END
    ||CASE WHEN s_suppkey%6<>0 THEN ', ''emailAddress'': "o''user'||(s_suppkey%4)||'@corp.com"' ELSE '' END||'}]' AS owners,
  CASE WHEN s_suppkey%5<>0 THEN 'user'||(s_suppkey%4) END AS lastmodifyinguser_displayname,
  CASE WHEN s_suppkey%5<>0 THEN '{''link'': ''p/'||s_suppkey||''', ''size'': '||(s_suppkey%9)||'}' END AS lastmodifyinguser_photo,
  CASE WHEN s_suppkey%8<>0 THEN CAST(s_suppkey*1000 AS VARCHAR) END AS size
FROM supplier"""


@query("flatten_record_path", _RECORDS_SQL)
def flatten_record_path(spark, sf_dir):
    """P-14: answers as JSON text, their ``files`` one row each, flattened one level; deeper levels as Python prints them."""
    return clean_headers(ls.flatten_records(ls.listing_records(fx.listing_pages(spark, sf_dir), fx.PAGE_SCHEMA)))


@query("flatten_of_parent", f"SELECT id, name, parents FROM ({_RECORDS_SQL}) r WHERE contains(parents, '''shared''')")
def flatten_of_parent(spark, sf_dir):
    """P-14: only the files that have a given folder among their parents."""
    records = ls.listing_records(fx.listing_pages(spark, sf_dir), fx.PAGE_SCHEMA)
    return ls.flatten_records(records.select("id", "name", "parents"), parent="shared")


@query("folder_parents_listed", """
WITH live AS (SELECT * FROM nodes WHERE kind='folder' AND NOT coalesce(trashed, false)),
edges AS (SELECT id, name, parent FROM live WHERE parent IS NOT NULL
          UNION ALL SELECT id, name, 'r0' FROM live WHERE name='Processed' UNION ALL SELECT id, name, 'gone' FROM live WHERE parent IS NULL)
SELECT DISTINCT e.id, e.name, e.parent, p.name AS parent_name FROM edges e JOIN live p ON p.id=e.parent""", ("nodes",))
def folder_parents_listed(spark, sf_dir):
    """J-9 where a folder may lie in several folders: 'Processed' folders also in the first root, roots in one that is not there."""
    nodes = Tables(spark, sf_dir).nodes
    also = F.when(F.col("name") == "Processed", F.array(F.col("parent"), F.lit("r0"), F.col("parent"))).otherwise(F.array(F.col("parent")))
    listed = F.when(F.col("parent").isNull(), F.array(F.lit("gone"))).otherwise(also)
    return ls.folder_parents(nodes.withColumn("parent", listed))
