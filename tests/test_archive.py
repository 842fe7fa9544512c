"""K-6: files move after their run is marked as handled; cut moves are ended, and nothing is overwritten."""

import os

import pytest

from leadmill.session import scratch_path
from leadmill.sinks import archive as ar
from leadmill.streaming import file_stream as fs


def _put(root, name, text):
    path = f"{root}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_move_file_can_be_repeated(tmp_path):
    a, b = _put(tmp_path, "x/part.csv", "1"), f"{tmp_path}/x/Processed/part.csv"
    assert ar.move_file(f"file://{a}", f"file:{b}") == ar.MOVED
    assert ar.move_file(a, b) == ar.MOVED_BEFORE
    _put(tmp_path, "x/part.csv", "1")                       # both are there: a copy that was not followed by its delete
    assert ar.move_file(a, b) == ar.MOVED and not os.path.exists(a)
    _put(tmp_path, "x/part.csv", "2")                       # another file of that name
    assert ar.move_file(a, b) == ar.NAME_TAKEN and os.path.exists(a) and open(b).read() == "1"
    assert ar.move_file(f"{tmp_path}/no.csv", f"{tmp_path}/Processed/no.csv") == ar.ABSENT


def test_cut_move_is_ended_by_the_next_call(spark, monkeypatch):
    root, state = scratch_path(spark, "arriving"), scratch_path(spark, "archive")
    handled = []

    def run(**options):
        return fs.run_available(spark, root, f"{state}/ck", lambda files, n: handled.append((n, files.count())), archive=True)
    _put(root, "file_id=a/one file.csv", "h\n1\n")
    _put(root, "file_id=b/part.csv", "h\n2\n")
    move = fs.move_processed

    def lost(files):
        raise OSError("lost")
    monkeypatch.setattr(fs, "move_processed", lost)
    with pytest.raises(OSError):
        run()
    assert handled == [(0, 2)] and os.path.exists(f"{root}/file_id=b/part.csv")
    monkeypatch.setattr(fs, "move_processed", move)
    assert run() == 0                                       # nothing new, but the move is made up for
    assert os.listdir(f"{root}/file_id=a") == ["Processed"]
    assert sorted(f for f in os.listdir(f"{root}/file_id=a/Processed") if f[0] != ".") == ["one file.csv"]
    _put(root, "file_id=b/later.csv", "h\n3\n")
    assert run() == 1 and handled == [(0, 2), (1, 1)]       # what lies in Processed never arrives again
    assert run() == 0
    outcomes = spark.read.parquet(f"{state}/ck_files/archived").groupBy("run", "outcome").count().collect()
    assert sorted(map(tuple, outcomes)) == [(0, "moved", 2), (1, "moved", 1)]


def test_ragged_records_are_refused_whatever_columns_are_taken(spark):
    from leadmill.sources import files as fl
    root = scratch_path(spark, "ragged")
    _put(root, "file_id=a/part.csv", "x,y\n1,2\n3,4,5\n6\n")
    (group,), bad = fl.read_checked(spark, fl.list_files(spark, root))
    assert sorted(r.x for r in group.select("x").collect()) == ["1", "6"]
    assert group.count() == 2 and group.groupBy("file_id").count().collect()[0][1] == 2
    assert [r.record for r in bad.collect()] == ["3,4,5"] and bad.count() == 1
