"""Keyed tables: a run touches only the buckets of its keys, may be repeated, and survives growth."""

import os

import pytest
from pyspark.sql import functions as F

from leadmill.sinks import keyed_table as kt
from leadmill.session import scratch_path


def rows(spark, lo, hi, v):
    return spark.range(lo, hi).select(F.concat(F.lit("e"), "id").alias("email"), F.lit(v).alias("v"))


def content(df):
    return {r.email: r.v for r in df.collect()}


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(kt, "ROWS_PER_BUCKET", 50)


def update(table, keys, run, v):
    """Sets v of the given keys, whole buckets at a time; returns the buckets."""
    some = table.buckets_of(keys, "email", run)
    old = table.before(run, some)
    hit = keys.select(F.col("email").alias("_e"))
    new = old.join(hit, old.email == hit["_e"], "left").select("email", F.when(F.col("_e").isNotNull(), v).otherwise(F.col("v")).alias("v"))
    table.write(new, run)
    return some


def test_runs_touch_their_buckets_only(spark, small):
    t = kt.KeyedTable(spark, scratch_path(spark, "keyed"), "email").create(rows(spark, 0, 1000, 0))
    some = update(t, rows(spark, 5, 8, None), 0, 1)
    assert 1 <= len(some) <= 3
    want = {f"e{i}": int(5 <= i < 8) for i in range(1000)}
    assert content(t.read(0)) == want and content(t.read(-1)) == dict.fromkeys(want, 0)
    assert {os.path.basename(os.path.dirname(f)) for f in t.written(0).inputFiles()} == {f"bucket={k}" for k in some}
    update(t, rows(spark, 5, 8, None), 0, 1)                 # the same run again
    assert content(t.read(0)) == want
    update(t, rows(spark, 7, 9, None), 1, 2)
    assert content(t.read(1)) == want | {"e7": 2, "e8": 2} and content(t.read(0)) == want


def test_bytes_of_a_run_do_not_follow_the_history(spark, small):
    sizes = []
    for n in (2000, 16000):
        t = kt.KeyedTable(spark, scratch_path(spark, "keyed"), "email").create(rows(spark, 0, n, 0))
        df = t.before(0, t.buckets_of(rows(spark, 5, 9, None), "email", 0))
        sizes.append(sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles()))
    assert sizes[1] < 1.5 * sizes[0]


def test_unfinished_runs_are_not_seen(spark, small):
    t = kt.KeyedTable(spark, scratch_path(spark, "keyed"), "email").create(rows(spark, 0, 100, 0))
    update(t, rows(spark, 0, 100, None), 0, 1)
    path = t._glob("base=*/run=0/_SUCCESS")[0]
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert set(content(t.read(0)).values()) == {0} and t.written(0).isEmpty()


def test_growth_and_a_repeated_run(spark, small, monkeypatch):
    t = kt.KeyedTable(spark, scratch_path(spark, "keyed"), "email", append=True).create(rows(spark, 0, 0, 0))
    t.write(rows(spark, 0, 300, 0), 0)
    monkeypatch.setattr(kt, "TARGET_BYTES", 200)
    assert t.settle_size(0) and len(t._bases()) == 2
    t.write(rows(spark, 0, 300, 0), 0)                       # run 0 again, after the new base
    assert content(t.written(0)).keys() == content(t.after(0)).keys() == content(t.read(0)).keys()
    assert t.read(0).count() == t.after(0).count() == 300
    t.write(rows(spark, 300, 310, 1), 1)
    assert t.read(1).count() == t.after(1).count() == 310 and t.before(1).count() == 300
    assert t.after(1, t.buckets_of(rows(spark, 305, 306, 0), "email", 1)).where("email = 'e305'").count() == 1
