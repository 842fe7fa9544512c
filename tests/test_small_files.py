"""Very many small files: the sink that writes them in tasks, and how many tasks list them."""

import os

import pytest
from pyspark.sql import functions as F

from leadmill.session import ensure_conf
from leadmill.sinks import writers as wr
from leadmill.sources import files as fl

ODD = ["plain", "", None, "a,b", 'say "hi"', "two\nlines", " spaces ", "back\\slash", "'", "#", "ünï"]


def _parts(root):
    return sorted(os.path.join(r, f) for r, _, fs in os.walk(root) for f in fs if f.startswith("part-") or "-part-" in f)


def _content(root):
    found = {}
    for p in _parts(root):
        if not p.endswith(".crc"):
            found.setdefault(os.path.relpath(os.path.dirname(p), root), []).append(open(p, newline="").read())
    return {k: sorted(v) for k, v in found.items()}


@pytest.fixture
def odd(spark):
    rows = [(f"s{k}/x=%[1]", k, a, b) for k, (a, b) in enumerate([(a, b) for a in ODD for b in ODD])] + [(None, -1, "n", "n"), ("", -2, "n", None)]
    return spark.createDataFrame(rows, "sheet string, n int, a string, b string").select("sheet", "n", "a", "b", F.col("a").alias("A, quoted"))


def test_partitioned_csv_has_the_bytes_and_folders_of_sparks_writer(spark, odd, tmp_path):
    mine, sparks = str(tmp_path / "mine"), str(tmp_path / "sparks")
    wr.write_partitioned_csv(odd, mine, ["sheet"])
    odd.repartition(3, "sheet").sortWithinPartitions("sheet").write.options(**wr.CSV_WRITE_OPTIONS).partitionBy("sheet").csv(sparks)
    mine, sparks = _content(mine), _content(sparks)
    assert len(mine) == len(ODD) ** 2 + 1
    assert {k: sorted("".join(v).splitlines()) for k, v in mine.items()} == {k: sorted("".join(v).splitlines()) for k, v in sparks.items()}


def test_partitioned_csv_replaces_only_its_folders_and_hides_its_parts(spark, tmp_path):
    out = str(tmp_path / "out")
    make = lambda ids, v: spark.createDataFrame([(i, v) for i in ids for _ in range(5)], "file_id string, v string")
    wr.write_partitioned_csv(make(["a", "b"], "1"), out, ["file_id"], rows_per_part=2)
    assert len(_parts(out)) == 6                                      # 5 rows a folder, 2 a part
    wr.write_partitioned_csv(make(["b"], "2"), out, ["file_id"])
    wr.write_partitioned_csv(make(["a"], "3"), out, ["file_id"], mode="append")
    rows = spark.read.option("header", "true").csv(out).groupBy("file_id", "v").count().collect()
    assert {tuple(r) for r in rows} == {("a", "1", 5), ("a", "3", 5), ("b", "2", 5)}
    assert not [f for f in os.listdir(out) if f.startswith(".")]
    empty = str(tmp_path / "empty")
    wr.write_partitioned_csv(make([], "1"), empty, ["file_id"])
    assert fl.list_files(spark, empty).count() == 0


def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path):
    out = str(tmp_path / "out")
    good = spark.createDataFrame([("a", "1")], "file_id string, v string")
    wr.write_partitioned_csv(good, out, ["file_id"])
    bad = good.withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        wr.write_partitioned_csv(bad, out, ["file_id"])
    assert [r.v for r in spark.read.option("header", "true").csv(out).collect()] == ["1"]
    assert os.listdir(out) == ["file_id=a"]


def test_the_parquet_table_keeps_types_and_replays(spark, tmp_path):
    out = str(tmp_path / "table")
    df = spark.createDataFrame([("f1", 1, None), ("f2", 2, "x")], "file_id string, n int, t string") \
        .withColumn("at", F.expr("TIMESTAMP_NTZ '2024-01-29 12:00:00'"))
    for _ in range(2):
        wr.append_load(df, out)
    back = spark.read.parquet(out)
    assert {f.name: f.dataType for f in back.schema} == {f.name: f.dataType for f in df.schema}
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    """Before: one task for each of up to 10,000 folders."""
    ensure_conf(spark)
    wr.write_partitioned_csv(spark.range(300).select(F.col("id").cast("string").alias("file_id"), "id"), str(tmp_path), ["file_id"])
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 64
    assert fl.list_files(spark, str(tmp_path)).count() == 300


@pytest.mark.parametrize("source, ending", [("text", "csv"), ("binaryFile", "xlsx")])
def test_a_task_reads_many_small_files(spark, tmp_path, source, ending):
    for i in range(400):
        (tmp_path / f"file_id=id{i}").mkdir()
        (tmp_path / f"file_id=id{i}" / f"a.{ending}").write_text("x\n1\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")          # a cluster's setting
    ensure_conf(spark)
    try:
        found = spark.read.format(source).option("recursiveFileLookup", "true").load(str(tmp_path))
        assert found.count() == 400 * (2 if source == "text" else 1)
        assert found.rdd.getNumPartitions() <= max(8, spark.sparkContext.defaultParallelism)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
