"""P-14: answers as JSON text, nested lists, Python's text of nested values; K-1: declared lengths."""

import pytest
from pyspark.sql import functions as F

from leadmill.operators import listing as ls
from leadmill.session import scratch_path
from leadmill.sinks import writers as wr
from leadmill.sources.fixtures import BATCH_TS


def _pages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "page string")


def test_python_text_of_values(spark):
    value = {"s": "it's", "q": "a\"b'c", "b": True, "n": 3, "l": ["x\\y", "two\nlines"], "d": {"k": [1, 2]}}
    schema = "v struct<s: string, q: string, b: boolean, n: int, l: array<string>, d: struct<k: array<int>>>"
    df = spark.createDataFrame([(value,)], schema)
    got = df.select(ls.py_text(F.col("v"), df.schema["v"].dataType)).first()[0]
    assert got == str(value)
    assert spark.createDataFrame([([None, "a"],), (None,)], "a array<string>").select(ls.py_list_text(F.col("a"))).collect() == [
        ("[None, 'a']",), (None,)]


def test_record_paths(spark):
    schema = "groups array<struct<files: array<struct<id: string>>>>"
    pages = _pages(spark, '{"groups": [{"files": [{"id": "a"}, {"id": "b"}]}, {"files": []}]}', '{"groups": []}', None)
    assert sorted(r.id for r in ls.listing_records(pages, schema, ["groups", "files"]).collect()) == ["a", "b"]
    for text in ('{"other": []}', "no json"):
        with pytest.raises(Exception):
            ls.listing_records(_pages(spark, text), schema, "groups").collect()


def test_replaced_table_keeps_declared_lengths(spark):
    path = scratch_path(spark, "stg")
    df = spark.createDataFrame([("a", None), ("bcd", "x")], "k string, v string")
    wr.ensure_database(spark, "leadmill_test")
    wr.replace_table(df, "leadmill_test", "t", path, BATCH_TS)
    wr.replace_table(df.select("k"), "leadmill_test", "t", path, BATCH_TS)
    table = spark.read.table("leadmill_test.t")
    assert table.columns == ["k", "_inserted_at"] and sorted(r.k for r in table.collect()) == ["a", "bcd"]
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        spark.sql("INSERT INTO leadmill_test.t VALUES ('toolong', TIMESTAMP_NTZ '2024-01-01 00:00:00')")
    wr.replace_table(df.limit(0), "leadmill_test", "t", path, BATCH_TS)
    assert spark.read.table("leadmill_test.t").count() == 0


def test_deep_tree_cycle_and_two_parents(spark):
    """Both walks against breadth-first search in Python."""
    edges = [(f"c{i}", f"c{i - 1}") for i in range(1, 40)] + [("x", "y"), ("y", "z"), ("z", "x"), ("m", "c3"), ("m", "c30"), ("s", "s")]
    rows = [("c0", None, "c0", "folder")] + [(i, p, i, "folder") for i, p in edges] + \
        [(f"f{i}", p, f"f{i}", "file") for i, p in enumerate(["c39", "m", "x", "c0", "gone"])]
    nodes = spark.createDataFrame(rows, "id string, parent string, name string, kind string").selectExpr(
        "*", "false AS trashed", "timestamp_ntz '2024-01-28 00:00:00' AS created_time", "timestamp_ntz '2024-01-28 00:00:00' AS modified_time",
        "'csv' AS file_extension")
    parents = {}
    for i, p, _, _ in rows:
        parents.setdefault(i, set()).update({p} - {None})

    def up(node):
        lvl, front, found = 0, {node}, {}
        while front:
            lvl, front = lvl + 1, {p for n in front for p in parents.get(n, ())}
            front = {p for p in front if p not in found}
            found.update(dict.fromkeys(front, lvl))
        return found
    want = sorted((n, lvl, a) for n in parents for a, lvl in up(n).items() for _ in range(sum(r[0] == a for r in rows)))
    assert sorted((r.id, r.lvl, r.name) for r in ls.ancestors(nodes).collect()) == want
    roots = spark.createDataFrame([("c0",), ("x",), ("c35",)], "id string")
    got = sorted((r.root, r.id) for r in ls.recent_files_recursive(nodes, roots, BATCH_TS).collect())
    assert got == sorted((root, f) for root in ("c0", "x", "c35") for f in parents if f[0] == "f" and root in up(f))


def test_recent_paths(spark):
    import datetime as dt
    import os
    from leadmill.sources import files as fl
    root = scratch_path(spark, "drive")
    now = dt.datetime(2024, 1, 29, 12, 0, 0, 500_000)
    midnight = dt.datetime(2024, 1, 22)
    times = {"a/at_bound.csv": midnight, "a/b/before.csv": midnight - dt.timedelta(milliseconds=1), "a/b/c/new.csv": now,
             "a/Processed/moved.csv": now, "a/new.txt": now, "a/sensor.csv": now - dt.timedelta(seconds=60),
             "a/sensor_later.csv": now - dt.timedelta(seconds=60) + dt.timedelta(milliseconds=1)}
    for name, time in times.items():
        path = f"{root}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write("h\n")
        micros = round(time.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) * 1_000_000
        os.utime(path, ns=(micros, micros))
    names = lambda df: sorted(r.file_name for r in df.collect())
    assert names(fl.recent_paths(spark, root, now)) == ["at_bound.csv", "new.csv", "sensor.csv", "sensor_later.csv"]
    assert names(fl.recent_paths(spark, root, now, delta_days=None)) == ["new.csv", "sensor_later.csv"]
    assert names(fl.recent_paths(spark, root, now + dt.timedelta(days=40))) == []
