"""Small CSV files are read by tasks, with the rows that Spark's reader gives and without their paths in the driver."""

import os

import pytest
from pyspark.sql import functions as F

from leadmill.session import scratch_path
from leadmill.sinks import archive as ar
from leadmill.sources import files as fl


def _put(root, name, data):
    path = f"{root}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _read(spark, root, **options):
    groups, bad = fl.read_checked(spark, fl.list_files(spark, root), **options)
    rows = sorted((r.file_id, r.x, r.y) for g in groups for r in g.select("file_id", *[F.coalesce(c, F.lit("-")).alias(c) for c in "xy"]).collect())
    return groups, rows, sorted(map(tuple, bad.select("file_id", "reason", "record").collect()))


def test_paths_of_small_files_stay_out_of_the_driver(spark):
    root = scratch_path(spark, "small")
    for i in range(30):
        _put(root, f"file_id={i:02d}/part.csv", f'x,y\n{i},"a\nb"\n'.encode() if i % 3 else f"x,y\n{i},c\n".encode())
    groups, rows, bad = _read(spark, root)
    assert rows == [(f"{i:02d}", str(i), "a\nb" if i % 3 else "c") for i in range(30)] and not bad
    assert not [p for g in groups for p in g.inputFiles() if p.endswith(".csv")]


ODD = {
    "ends": b'x,y\r\n1,2\r\n"a,b","c ""q"""\r\n\r\n  \r\n3\r\n4,5,6\r\n',
    "breaks": b'x,y\n"l1\n\nl2",2\n\n3,"4"\n5,6,"7\n8"\n',
    "windows breaks": b'x,y\r\n1,2\r\n"a\r\nb",3\r\n',
    "inch": b'x,y\n5" pipe,2\n3,4\n',
    "open": b'x,y\n"a\nb",2\n"un,3\n4,5\n',
    "junk": b'x,y\n"a"b,2\n"c" ,3\n "d",4\n',
    "blanks": b'x,y\n"a\nb",2\n  \n3,4\n',
    "bytes": b"\xef\xbb\xbfx,y\n1,\xff\xfe2\n",
    "cut": b'x,y\n#3,4\n"5\n6",7',
    "header only": b"x,y\n",
}


@pytest.mark.parametrize("name", sorted(ODD))
def test_tasks_read_what_sparks_reader_reads(spark, monkeypatch, name):
    root = scratch_path(spark, "odd")
    _put(root, "file_id=sheet%3D1/one part.csv", ODD[name])
    _, rows, bad = _read(spark, root)
    with monkeypatch.context() as m:
        m.setattr(fl, "_small", lambda path: (fl.SMALL_BYTES + 1, None))       # as if it were large; goes to the tasks with ``_sniff``
        groups, want, want_bad = _read(spark, root)
        assert any(p.endswith(".csv") for g in groups for p in g.inputFiles()) or name == "header only"
    assert (rows, bad) == (want, want_bad)


def test_files_without_cells_and_mixed_headers(spark):
    root = scratch_path(spark, "mixed")
    _put(root, "file_id=a/p.csv", b"\n")
    _put(root, "file_id=b/p.csv", b"x,y\n1,2\n")
    _put(root, "file_id=c/p.csv", b"y,x\n3,4\n")
    _, rows, bad = _read(spark, root)
    assert rows == [("b", "1", "2"), ("c", "4", "3")] and bad == [("a", "file without a header", None)]

def test_moves_are_dealt_to_all_cores(spark):
    root = scratch_path(spark, "moved")
    for i in range(40):
        _put(root, f"file_id={i}/part.csv", b"x\n1\n")
    moved = ar.move_processed(fl.list_files(spark, root).select("path"))
    assert "REPARTITION_BY_NUM" in moved._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in moved.groupBy("outcome").count().collect()] == [("moved", 40)]
