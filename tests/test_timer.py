"""The whole timer run (R-1): a run that failed is repeated under its number; later runs add to what is there."""

import pytest
from pyspark.sql import functions as F

from leadmill.plans import jobs as pl
from leadmill.plans.q_ingest import _vendor_root, _xlsx_root
from leadmill.session import scratch_path
from leadmill.sources import files as fl
from leadmill.sources import fixtures as fx
from leadmill.sources.tables import Tables


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.select(sorted(df.columns)).collect())


def test_failed_run_is_repeated_and_later_runs_add(spark, sf_small, monkeypatch):
    t = Tables(spark, sf_small)
    files = fl.list_files(spark, _vendor_root(spark, sf_small))
    state = pl.State(spark, scratch_path(spark, "timer")).init(catalog=t.drive_metadata.limit(0))

    def run(n, shift):
        pl.timer_run(state, fx.listing_records(spark, sf_small, id_shift=shift), t.nodes, t.config_sheet, files, n, fx.BATCH_TS,
                     workbooks=_xlsx_root(spark, sf_small))

    land = pl.land_files
    def fail_after_landing(*args, **options):
        land(*args, **options)
        raise OSError("lost")
    monkeypatch.setattr(pl, "land_files", fail_after_landing)
    with pytest.raises(OSError):
        run(0, 0)
    monkeypatch.setattr(pl, "land_files", land)
    assert state.keyed("catalog").before(1).count() == 0                # nothing is published
    run(0, 0)
    first = _rows(state.read("catalog", 0))
    notices = _rows(spark.read.parquet(state.path("notices")))
    landed = _rows(spark.read.text(state.path("landing")))
    assert len(first) == t.drive_metadata.count()
    ready = spark.read.parquet(state.path("ready"))
    absent = spark.read.parquet(state.path("absent"))
    ids = fl.list_files(spark, state.path("landing")).select("file_id").distinct()
    assert ready.count() == absent.count() + ids.count()

    run(1, 5)                                                           # five files more; the known ones stay as they are
    second = _rows(state.read("catalog", 1))
    assert len(second) == len(first) + 5 and set(first) <= set(second)
    assert not set(notices) & set(_rows(spark.read.parquet(state.path("notices/batch=0000000001"))))
    run(1, 5)                                                           # repeated under its number
    assert _rows(state.read("catalog", 1)) == second
    assert set(landed) <= set(_rows(spark.read.text(state.path("landing"))))
    assert spark.read.parquet(state.path("notices/batch=0000000001")).where(F.col("uuid").isNull()).count() == 0
