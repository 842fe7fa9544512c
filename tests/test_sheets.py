"""K-4: numbered sheet rows over runs: header only in empty sheets, appends below, shorter replacements, repeated runs."""

from pyspark.sql import functions as F

from leadmill.session import scratch_path
from leadmill.sinks.sheets import Sheets, numbered


def _rows(spark, triples):
    return spark.createDataFrame([("b", s, k, v) for s, k, v in triples], "book string, sheet string, k long, v string")


def _read(sheets, run):
    return sorted((r.sheet or "", r.row_no, tuple(r.cells)) for r in sheets.read(run).collect())


def test_append_replace_and_repeat(spark):
    sheets = Sheets(spark, scratch_path(spark, "sheets"))
    write = lambda triples, run, **o: sheets.write(_rows(spark, triples), ["v"], ["k"], run, **o)
    write([("2024", 2, "y"), ("2024", 1, "x"), (None, 1, None)], 0, replace=False)
    first = [("", 1, ("v",)), ("", 2, ("",)), ("2024", 1, ("v",)), ("2024", 2, ("x",)), ("2024", 3, ("y",))]
    assert _read(sheets, 0) == first
    for _ in range(2):                                      # a repeated run replaces its own rows
        write([("2024", 1, "z")], 1, replace=False)
        assert _read(sheets, 1) == first + [("2024", 4, ("z",))]
    write([("2024", 1, "w")], 2, replace=F.col("sheet") == "2024")
    assert _read(sheets, 2) == first[:2] + [("2024", 1, ("v",)), ("2024", 2, ("w",))]
    assert _read(sheets, 1) == first + [("2024", 4, ("z",))]
    empty = spark.createDataFrame([("b", "2024"), ("b", "new")], "book string, sheet string")
    write([], 3, replace=True, targets=empty)               # cleared: the header alone
    assert _read(sheets, 3) == first[:2] + [("2024", 1, ("v",)), ("new", 1, ("v",))]
    write([("new", 1, "u")], 4, replace=False)
    assert _read(sheets, 4)[-1] == ("new", 2, ("u",))


def test_numbers_of_a_hot_sheet_have_no_gaps(spark):
    df = spark.range(0, 20_000, 1, 7).select(F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("g"),
                                             (F.col("id") * 7919 % 20_011).alias("k"))
    got = numbered(df, ["g"], ["k"]).toPandas().sort_values(["g", "k"])
    for _, part in got.groupby("g"):
        assert list(part["row_no"]) == list(range(1, len(part) + 1))
