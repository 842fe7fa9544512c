"""Drive listing operators over an edge table ``nodes(id, parent, name, kind, trashed,
created_time, modified_time, file_extension)``: the recursive recent-file walk (S-1), children
(S-2), flat recent listing (S-3), folder lookups (S-4), parent names (S-5, J-9), ancestors (J-10),
the one-level flatten of API records (P-14) and the union of differing listings (O-1).

Tree walks are closures by doubling: after round k all paths of up to 2^k steps are known, so a tree of depth d takes
log2(d) rounds, over its folders only; files join the result once. Trees may be of any depth, nodes may have
several parents, and cycles end by themselves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import day_floor_minus, seconds_before
from ..session import work_dir

PROCESSED = "Processed"


def _visible(nodes: DataFrame) -> Column:
    """S-2 filter: not trashed and not named 'Processed' (so its subtree is never entered)."""
    return ~F.coalesce(F.col("trashed"), F.lit(False)) & (F.col("name") != PROCESSED)


def children(nodes: DataFrame) -> DataFrame:
    """S-2 for every folder at once: the visible children of each parent."""
    return nodes.where(F.col("parent").isNotNull() & _visible(nodes))


def _closure(edges: DataFrame) -> DataFrame:
    """(id, anc, lvl): all that each ``id`` of ``edges`` (id, anc) reaches, with the least number of steps. A path of h + m steps, m <= h,
    is one of exactly h steps and one of m, so a round joins only the paths found last with those known, and
    only new pairs are checkpointed."""
    work_dir(edges.sparkSession)
    h, last = 1, edges.where(F.col("id").isNotNull() & F.col("anc").isNotNull()).distinct().withColumn("lvl", F.lit(1)).checkpoint()
    known = last
    while True:
        longest = last.where(F.col("lvl") == h)
        if longest.isEmpty():
            return known
        on = known.select(F.col("id").alias("_i"), F.col("anc").alias("_a"), F.col("lvl").alias("_l"))
        step = longest.join(on, longest["anc"] == on["_i"]).groupBy("id", F.col("_a").alias("anc")).agg(
            F.min(F.col("lvl") + F.col("_l")).alias("lvl"))
        last = step.join(known, ["id", "anc"], "left_anti").checkpoint()
        known, h = known.unionByName(last), 2 * h


def recent_files_recursive(nodes: DataFrame, roots: DataFrame, now: dt.datetime, delta_days: int = 7) -> DataFrame:
    """S-1: files below each root (column ``root``) modified or created on/after today − n days.

    The reference compares ISO texts: the API's '…T00:00:00.000Z' sorts above the bound
    '…T00:00:00', so a stamp equal to the bound passes — i.e. ``>=`` on timestamps.
    """
    d = day_floor_minus(now, delta_days)
    vis = children(nodes).select("id", "parent", "name", "kind", "created_time", "modified_time", "file_extension")
    folders = vis.where(F.col("kind") == "folder").select("id", F.col("parent").alias("anc"))
    root = roots.select(F.col("id").alias("root")).distinct()
    below = _closure(folders).where(F.col("id") != F.col("anc")).join(root, F.col("anc") == F.col("root"))
    walked = below.select("root", F.col("id").alias("folder")).unionByName(root.select("root", F.col("root").alias("folder")))
    files = vis.where((F.col("kind") == "file") & ((F.col("modified_time") >= d) | (F.col("created_time") >= d)))
    return walked.join(files, walked["folder"] == files["parent"]).select(
        "root", "id", "name", "parent", "created_time", "modified_time", "file_extension")


def recent_files_flat(nodes: DataFrame, now: dt.datetime, delta_days: int = 7, sensor: bool = False,
                      sensor_seconds: int = 60) -> DataFrame:
    """S-3: every non-folder, non-trashed item changed after the bound (the API's strict '>').
    Day mode: today − n days at midnight; sensor mode: now − 60 s. The reference reads one page
    of at most 1000 items; here every matching item is returned."""
    d = seconds_before(now, sensor_seconds) if sensor else day_floor_minus(now, delta_days)
    return nodes.where((F.col("kind") != "folder") & ~F.coalesce(F.col("trashed"), F.lit(False))
                       & ((F.col("modified_time") > d) | (F.col("created_time") > d)))


def folder_lookup(nodes: DataFrame) -> DataFrame:
    """S-4 for all folders: root flag (shared top level), number of child folders, and the id of
    the child folder named 'Processed' (existence = not NULL)."""
    live = nodes.where((F.col("kind") == "folder") & ~F.coalesce(F.col("trashed"), F.lit(False)))
    kids = live.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("_p")).agg(
        F.count(F.lit(1)).alias("n_child_folders"),
        F.min(F.when(F.col("name") == PROCESSED, F.col("id"))).alias("processed_folder_id"))
    out = live.join(kids, live["id"] == kids["_p"], "left")
    return out.select("id", "name", F.col("parent").isNull().alias("is_root"),
                      F.coalesce(F.col("n_child_folders"), F.lit(0)).alias("n_child_folders"), "processed_folder_id")


def parent_names(nodes: DataFrame) -> DataFrame:
    """S-5: each file's parent id, parent name and extension — one join instead of one API call
    per file."""
    files = nodes.where(F.col("kind") == "file")
    par = nodes.select(F.col("id").alias("_pid"), F.col("name").alias("parent_name"))
    return files.join(par, files["parent"] == par["_pid"], "left").select(
        "id", "name", "parent", "parent_name", "file_extension")


def folder_parents(nodes: DataFrame) -> DataFrame:
    """J-9: live folders with their parent's name; folders whose parent is not a live folder (the
    roots) drop out of the inner join; whole-row distinct. ``parent`` may be an array: one row for each parent then."""
    live = nodes.where((F.col("kind") == "folder") & ~F.coalesce(F.col("trashed"), F.lit(False)))
    par = live.select(F.col("id").alias("_pid"), F.col("name").alias("parent_name"))
    if nodes.schema["parent"].dataType.typeName() == "array":
        live = live.withColumn("parent", F.explode("parent"))
    return live.join(par, F.col("parent") == F.col("_pid")).select("id", "name", "parent", "parent_name").distinct()


def ancestors(nodes: DataFrame) -> DataFrame:
    """J-10 for every node: (id, lvl, name) of each ancestor, nearest first (lvl 1 = parent)."""
    start = nodes.where(F.col("parent").isNotNull()).select("id", F.col("parent").alias("anc"))
    inner = start.join(start.select(F.col("anc").alias("_in")).distinct(), F.col("id") == F.col("_in"), "left_semi")
    far = _closure(inner).select(F.col("id").alias("_i"), F.col("anc").alias("_a"), F.col("lvl").alias("_l"))
    up = start.withColumn("lvl", F.lit(1)).unionByName(
        start.join(far, F.col("anc") == F.col("_i")).select("id", F.col("_a").alias("anc"), (F.col("_l") + 1).alias("lvl")))
    up = up.groupBy("id", "anc").agg(F.min("lvl").alias("lvl"))
    names = nodes.select(F.col("id").alias("_nid"), "name")
    return up.join(names, up["anc"] == names["_nid"]).select("id", "lvl", "name")


def _quoted(c: Column) -> Column:
    """Python ``repr`` of a text: single quotes, double ones if it holds single quotes only; backslashes and line breaks escaped."""
    t = c
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        t = F.replace(t, F.lit(plain), F.lit(escaped))
    both = F.concat(F.lit("'"), F.replace(t, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"')), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(both)


def py_repr(c: Column, dtype) -> Column:
    """Python ``repr`` of a JSON value: None, True / False, numbers, quoted texts, lists, and dicts, of which keys with a NULL
    value are left out (JSON text read with a schema does not tell an absent key from a null)."""
    kind = dtype.typeName()
    if kind == "struct":
        items = [F.when(c.getField(f.name).isNotNull(), F.concat(F.lit(f"'{f.name}': "), py_repr(c.getField(f.name), f.dataType)))
                 for f in dtype.fields]
        text = F.concat(F.lit("{"), F.concat_ws(", ", *items), F.lit("}"))
    elif kind == "array":
        text = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: py_repr(x, dtype.elementType)), ", "), F.lit("]"))
    elif kind == "string":
        text = _quoted(c)
    else:
        text = py_text(c, dtype)
    return F.coalesce(text, F.lit("None"))


def py_list_text(arr: Column) -> Column:
    """Python ``str(list_of_str)``: "['a', 'b']"; NULL stays NULL."""
    return F.when(arr.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(arr, lambda x: F.coalesce(_quoted(x), F.lit("None"))), ", "),
                                            F.lit("]")))


def py_text(c: Column, dtype) -> Column:
    """Python ``str(value)`` for P-2 (booleans print as True/False, lists and dicts as Python prints them); NULL stays NULL."""
    kind = dtype.typeName()
    if kind == "boolean":
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if kind in ("struct", "array"):
        return F.when(c.isNotNull(), py_repr(c, dtype))
    return c.cast("string")


def listing_records(pages: DataFrame, schema: str, record_path: str | list[str] = "files", column: str = "page") -> DataFrame:
    """P-14: the records of API answers kept as JSON text, one row per record with the fields of the record as columns.

    ``schema`` is the answer's type as DDL; ``record_path`` the field that lists the records (a list of names goes down
    through nested lists). Text that is not JSON of that type, and an answer without the field, are errors, as in
    the reference; an empty list gives no record, a NULL page none either.
    """
    steps = [record_path] if isinstance(record_path, str) else list(record_path)
    rows = pages.where(F.col(column).isNotNull()).select(F.from_json(column, schema, {"mode": "FAILFAST"}).alias("_r"))
    for name in steps:
        listed = F.col("_r").getField(name)
        wrong = F.raise_error(F.lit(f"no {name!r} in an answer")).cast(rows.select(listed.alias("x")).schema["x"].dataType)
        rows = rows.select(F.explode(F.when(listed.isNull(), wrong).otherwise(listed)).alias("_r"))
    return rows.select("_r.*")


def flatten_records(records: DataFrame, parent: str | None = None) -> DataFrame:
    """P-14 + P-2: one-level flatten of listing records (struct fields become ``outer.inner``
    columns, deeper levels stay nested), everything in its Python text form. With
    ``parent`` only records whose ``parents`` contain it are kept."""
    if parent is not None:
        records = records.where(F.array_contains(F.col("parents"), parent))
    cols = []
    for f in records.schema.fields:
        if f.dataType.typeName() == "struct":
            for sub in f.dataType.fields:
                cols.append(py_text(F.col(f"`{f.name}`.`{sub.name}`"), sub.dataType).alias(f"{f.name}.{sub.name}"))
        else:
            cols.append(py_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name))
    return records.select(*cols)


def union_listings(*frames: DataFrame) -> DataFrame:
    """O-1: ``pd.concat`` of frames with differing columns — by name, missing columns NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
