"""Whole pipelines (R-1 … R-6) assembled from the operators.

State lives in a folder of the shared work area. ``tracking`` (by e-mail), ``catalog`` (by file id) and the raw contact
tables (by e-mail) are keyed tables (``sinks.keyed_table``): run N reads, of version N−1, only the buckets that hold its
own keys, and writes only these, so its cost does not follow the history. The raw city table is
partitioned by ``file_id`` (append by dynamic partition overwrite); ``franchises`` are snapshots. A retried run
recomputes the same result under the same number.

Keys: a raw row's uuid is made from its content (X-14), e-mail included, and its tracking row carries that e-mail.
So all tracking rows that can match a row of a run, by lead or by e-mail, are in the buckets of the run's e-mails.

Order inside a lead batch follows the reference: fresh leads are selected on the old tracking
snapshot and written out (which materialises them) before tracking changes; tracking inserts
(T-1), then customer marks (U-4), then metrics (A-1) on the new snapshot; the processed flag
is set last (Q12).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from ..functions import scalar as X
from ..session import path_exists
from ..operators import catalog as cat
from ..operators import city as cy
from ..operators import franchises as fr
from ..operators import leads as ld
from ..operators import outbox as ob
from ..operators.joins import anti, semi
from ..schemas import CATALOG_NULL_ON_INSERT, ENRICHED_DATA_COLUMNS, insert_columns
from ..sinks import writers as wr
from ..sinks.keyed_table import KeyedTable
from ..sources import files as fl
from .ingest import ingest_checked, land_files

QUICK_MAIL_BOOK = "Quick Mail Output - "
CITY_BOOK = "City Search Output - "


KEYED = {"tracking": "email_address", "catalog": "id"}


class State:
    """The pipeline's tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def keyed(self, table: str) -> KeyedTable:
        return KeyedTable(self.spark, self.path(table), KEYED[table])

    def raw_keyed(self, table: str, key) -> KeyedTable:
        """A raw contact table by e-mail; each run appends its rows."""
        return KeyedTable(self.spark, self.path(f"raw_{table}"), key, append=True)

    def _snap(self, table: str, batch_id: int) -> str:
        tag = "initial" if batch_id < 0 else f"{batch_id:010d}"
        return f"{self.root}/{table}/snapshot={tag}"

    def read(self, table: str, batch_id: int, buckets: list[int] | None = None) -> DataFrame:
        if table in KEYED:
            return self.keyed(table).read(batch_id, buckets)
        return self.spark.read.parquet(self._snap(table, batch_id))

    def write(self, df: DataFrame, table: str, batch_id: int) -> None:
        if table in KEYED:
            self.keyed(table).write(df, batch_id)
        else:
            df.write.mode("overwrite").parquet(self._snap(table, batch_id))

    def init(self, **tables: DataFrame) -> "State":
        for name, df in tables.items():
            if name in KEYED:
                self.keyed(name).create(df)
            else:
                self.write(df, name, -1)
        return self

    def raw(self, table: str) -> DataFrame | None:
        """The raw table, or None before the first file is loaded. A table that cannot be read is an error."""
        path = self.path(f"raw_{table}")
        return self.spark.read.parquet(path) if path_exists(self.spark, path) else None

    def once(self, df: DataFrame, table: str, batch_id: int) -> DataFrame:
        """Write a batch's intermediate rows once and read them back wherever they are needed."""
        path = f"{self.path(table)}/batch={batch_id:010d}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def _catalog_of(state: State, files: DataFrame, batch_id: int) -> DataFrame:
    """The catalog's buckets that hold the run's files."""
    table = state.keyed("catalog")
    return table.before(batch_id, table.buckets_of(files, "file_id", batch_id))


def _gate(state: State, files: DataFrame, catalog: DataFrame, batch_id: int) -> DataFrame:
    """F-6: the files not yet processed. Parts that arrive after their file was processed are not loaded; they are
    reported in ``late/batch=<run>`` (path, file_id)."""
    todo = _unprocessed(files, catalog)
    late = anti(files, todo.select(F.col("path").alias("_todo")), F.col("path") == F.col("_todo"))
    late.select("path", "file_id").write.mode("overwrite").parquet(state.path(f"late/batch={batch_id:010d}"))
    return todo


def _load(state: State, table: str, key, files: DataFrame, catalog: DataFrame, batch_id: int, batch_ts: dt.datetime,
          required: list[str] | None = None) -> tuple[KeyedTable, DataFrame]:
    """Ingest the run's files and append them to the raw table by e-mail: (the table, the run's rows). What
    could not be loaded goes to ``quarantine/batch=<run>``."""
    new, bad = ingest_checked(state.spark, None, catalog, table, batch_ts, files=files, required=required)
    raw = state.raw_keyed(table, key)
    if not raw.exists():
        raw.create(new.limit(0))
    raw.write(new, batch_id)
    bad.write.mode("overwrite").parquet(state.path(f"quarantine/batch={batch_id:010d}"))
    return raw, raw.written(batch_id)


def _unprocessed(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """F-6 gate: drop files the catalog already flags as processed."""
    done = catalog.where(F.coalesce(F.col("has_been_processed"), F.lit(False))).select(F.col("id").alias("_done"))
    return anti(files, done, F.col("file_id") == F.col("_done"))


def _sent_files(rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """The rows of files that gave at least one fresh lead. Only these are tracked: a file without any
    (no config, or nothing new) sent nothing, so its e-mails stay free."""
    sent = fresh.select(F.col("drive_metadata_uuid").alias("_sent")).distinct()
    return semi(rows, sent, F.col("drive_metadata_uuid") == F.col("_sent"))


def lead_batch(state: State, files: DataFrame, batch_id: int, batch_ts: dt.datetime, customers: DataFrame) -> None:
    """R-2 body for all files of one run (``files``: path, file_id).

    Each e-mail of the run is ranked over every raw row loaded so far that has it: the buckets of the run's
    e-mails hold them all. Rows of files that sent nothing stay untracked and still rank.
    """
    catalog = _catalog_of(state, files, batch_id)
    files = _gate(state, files, catalog, batch_id)
    raw, batch_leads = _load(state, "leads", "email_address", files, catalog, batch_id, batch_ts)
    all_leads = raw.after(batch_id, raw.buckets_of(batch_leads, "email_address", batch_id))
    known = state.keyed("tracking")
    tracking = known.before(batch_id, known.buckets_of(batch_leads, "email_address", batch_id))
    # fresh leads (W-1) of this batch's files; only e-mails of the batch can rank there
    emails = batch_leads.select(F.col("email_address").alias("_e")).distinct()
    candidates = semi(all_leads.drop("file_id"), emails, F.col("email_address") == F.col("_e"))
    fresh = ld.fresh_leads(candidates, customers, tracking, catalog)
    fresh = semi(fresh, batch_leads.select(F.col("drive_metadata_uuid").alias("_u")).distinct(),
                 F.col("drive_metadata_uuid") == F.col("_u"))
    fresh = state.once(fresh, "fresh_leads", batch_id)      # selected on the old tracking rows, before they change
    book = F.concat(F.lit(QUICK_MAIL_BOOK), X.week_label(X.ntz(batch_ts)))
    sheet = ld.output_frame(fresh).withColumn("book", book).withColumn("sheet", F.col("file_name")).drop("file_name")
    wr.sheet_output(sheet, state.path("sheets"))
    batch_leads = _sent_files(batch_leads, fresh)
    t1 = ld.track_posted(batch_leads, tracking, batch_ts)   # T-1
    t2 = ld.track_customers(batch_leads, customers, t1, batch_ts)   # U-4
    state.write(t2, "tracking", batch_id)
    tracking_new = known.written(batch_id)
    metrics = ld.status_metrics(tracking_new, batch_leads, catalog)  # A-1
    ob.metrics_messages(metrics).write.mode("overwrite").parquet(state.path(f"outbox/batch={batch_id:010d}"))
    _finish(state, raw, catalog, files, batch_id)


def _finish(state: State, raw: KeyedTable | None, catalog: DataFrame, files: DataFrame, batch_id: int) -> None:
    """The processed flags, last (Q12); then tables whose buckets have grown get more of them."""
    state.write(cat.mark_processed(catalog, files.select(F.col("file_id").alias("id"))), "catalog", batch_id)
    for table in (state.keyed("catalog"), *((state.keyed("tracking"), raw) if raw is not None else ())):
        table.settle_size(batch_id)


def city_batch(state: State, files: DataFrame, batch_id: int, batch_ts: dt.datetime,
               franchise_source: DataFrame | None = None, owner: str = "sales-owner", links: str = "sheets/") -> None:
    """R-3 body: franchises upserted first (U-3); raw rows appended only for unprocessed files
    (P-5 with the table's columns); the output sheets are always recomputed (J-16); one notice
    to ``owner`` for each written sheet, whose link is ``links`` + book / sheet."""
    catalog = state.read("catalog", batch_id - 1)         # J-12 compares with the files of the whole history
    touched = _catalog_of(state, files, batch_id)
    franchises = state.read("franchises", batch_id - 1)
    if franchise_source is not None:
        franchises = fr.upsert_franchises(franchises, franchise_source, batch_ts)
    state.write(franchises, "franchises", batch_id)
    franchises = state.read("franchises", batch_id)
    todo = _unprocessed(files, catalog)
    cols = [c for c in insert_columns("city_search")]
    new, bad = ingest_checked(state.spark, None, catalog, "city_search", batch_ts, columns=cols, files=todo)
    wr.append_load(new, state.path("raw_city_search"))
    bad.write.mode("overwrite").parquet(state.path(f"quarantine/batch={batch_id:010d}"))
    city = state.raw("city_search")
    if city is None:
        city = new
    ids = files.select(F.col("file_id").alias("_fid")).distinct()
    sheet = cy.city_sheet(city.drop("file_id"), catalog, franchises,
                          file_ids=ids.select(F.col("_fid").alias("file_id")))
    franchise_part, other_part = cy.city_sheet_parts(state.once(sheet, "city_sheet", batch_id))
    book = F.concat(F.lit(CITY_BOOK), X.week_label(X.ntz(batch_ts)))
    for part in (franchise_part, other_part):
        wr.sheet_output(part.withColumn("book", book), state.path("sheets"))
    written = franchise_part.select("file_id", "sheet").union(other_part.select("file_id", "sheet")).distinct()
    written = written.select("file_id", F.concat(F.lit(links), book, F.lit("/"), "sheet").alias("link"), F.col("sheet").alias("sheet_name"))
    ob.sheet_ready_messages(written, owner).write.mode("overwrite").parquet(state.path(f"outbox/batch={batch_id:010d}"))
    _finish(state, None, touched, files, batch_id)


def enriched_batch(state: State, files: DataFrame, batch_id: int, batch_ts: dt.datetime, customers: DataFrame,
                   links: str = "sheets/") -> None:
    """R-4 body: strict column selection (P-12), append, W-2 for the batch's files, output frame
    split into personal / generic sheets (F-9), T-2, U-5, A-2, notices with the link to the book (``links`` + book)."""
    catalog = _catalog_of(state, files, batch_id)
    todo = _unprocessed(files, catalog)
    email = F.coalesce(F.col("main_point_of_contact_email"), F.col("generic_contact_email"))
    raw, batch_rows = _load(state, "city_search_enriched", email, todo, catalog, batch_id, batch_ts,
                            required=ENRICHED_DATA_COLUMNS)   # P-12: a file without these columns fails
    ids = files.select(F.col("file_id").alias("_fid")).distinct()
    again = anti(ids, todo.select(F.col("file_id").alias("_new")), F.col("_fid") == F.col("_new"))
    if not again.isEmpty():       # files that came again: their rows lie in any bucket
        batch_rows = batch_rows.unionByName(semi(raw.before(batch_id), again, F.col("file_id") == F.col("_fid")))
    all_rows = raw.after(batch_id, raw.buckets_of(batch_rows, email, batch_id))
    known = state.keyed("tracking")
    tracking = known.before(batch_id, known.buckets_of(batch_rows, email, batch_id))
    # only e-mails of the batch can rank in its files: prune the buckets to them first
    batch_emails = batch_rows.select(cy.coalesced_email(batch_rows).alias("_e")).distinct()
    pool = semi(all_rows.drop("file_id"), batch_emails, cy.coalesced_email(all_rows) == F.col("_e"))
    fresh = cy.city_fresh_leads(pool, customers, tracking, catalog)
    fresh = semi(fresh, ids, F.col("file_id") == F.col("_fid"))
    fresh = state.once(fresh, "fresh_enriched", batch_id)
    frame = ld.output_frame(fresh)
    book = F.concat(F.lit(QUICK_MAIL_BOOK), X.week_label(X.ntz(batch_ts)))
    personal = cy.split_personal(frame).withColumn("sheet", F.col("file_name"))
    generic = cy.split_generic(frame).withColumn("sheet", F.concat(F.lit("Generic of "), F.col("file_name")))
    for part in (personal, generic):
        wr.sheet_output(part.drop("file_name").withColumn("book", book), state.path("sheets"))
    batch_rows = _sent_files(batch_rows, fresh)
    t1 = cy.city_track_posted(batch_rows, tracking, batch_ts)
    t2 = cy.city_track_customers(batch_rows, customers, t1, batch_ts)
    state.write(t2, "tracking", batch_id)
    metrics = cy.city_metrics(known.written(batch_id), batch_rows, catalog)
    notices = ob.metrics_messages(metrics, F.concat(book, F.lit(" - "), F.col("name")), F.concat(F.lit(links), book))
    notices.write.mode("overwrite").parquet(state.path(f"outbox/batch={batch_id:010d}"))
    _finish(state, raw, catalog, files, batch_id)


def sync(listing: DataFrame, nodes: DataFrame, catalog: DataFrame, config: DataFrame, batch_ts: dt.datetime
         ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """R-1 (timer): new listed files are appended to the catalog (J-1, P-14 … P-7), file types
    derived from parent folders (P-15, U-2), config applied (U-1), missing-config notices
    produced (F-1, K-8) and flagged (D-1); the files first seen in this run and ready (F-2).

    Returns (new catalog, notices, ready files). ``timer_run`` is the whole run, with the landing of the ready files.
    """
    from ..functions.headers import clean_headers
    from ..operators import align as al
    from ..operators import listing as ls
    flat = clean_headers(ls.flatten_records(listing))
    new = cat.new_files(flat, catalog)
    target = [c for c in insert_columns("drive_metadata") if c not in CATALOG_NULL_ON_INSERT + ["created_at"]]
    rows = al.catalog_insert_shape(al.stamp(al.align_fill(new, target), batch_ts))
    rows = rows.withColumn("uuid", X.det_uuid(F.lit("file"), F.col("id")))
    c = catalog.unionByName(rows, allowMissingColumns=True)
    c = c.withColumn("parents", F.coalesce(F.col("parents"), F.lit("[]")))
    derived = cat.derive_file_types(c, nodes.where(F.col("kind") == "folder"))
    c = cat.apply_file_types(c, derived, batch_ts)
    c = cat.apply_config(c, config, batch_ts)
    notices = ob.missing_config_messages(cat.missing_config(c))
    c = cat.mark_posted(c)
    ready = cat.ready_files(c, new.select("id"))
    return c, notices, ready


def timer_run(state: State, listing: DataFrame, nodes: DataFrame, config: DataFrame, files: DataFrame, run: int,
              batch_ts: dt.datetime, workbooks: str | None = None) -> None:
    """R-1 whole: ``sync``, its notices, and the ready files' rows landed from the drive folder (``files``: path, file_id of
    its CSV files; ``workbooks``: folder of its workbooks, which are all opened).

    The listing and the config sheet are written down first, so that all outputs come from one state of them. Outputs:
    ``notices/batch=<run>`` (uuid, text), ``ready/batch=<run>``, ``absent/batch=<run>`` (ready files of which no row landed),
    ``quarantine/batch=<run>`` (records and files that landing refused), ``unknown_types/batch=<run>`` (uuid and derived type of
    files whose folder names no type, V-1)
    and ``landing`` by file. The catalog's version ``run`` is written last and publishes the run: a run that failed
    before is repeated under its number, finds the same new files and replaces its own outputs. Only buckets
    with changed rows are written.
    """
    listing, config = state.once(listing, "listing", run), state.once(config, "config", run)
    table = state.keyed("catalog")
    old = table.before(run)
    catalog, notices, ready = sync(listing, nodes, old, config, batch_ts)
    state.once(notices, "notices", run)
    ready = state.once(ready.select("id", "uuid", "name", "file_type"), "ready", run)
    ids = ready.select(F.col("id").alias("_ready"))
    landing = land_files(state.spark, semi(files, ids, F.col("file_id") == F.col("_ready")), ready, nodes, state.path("landing"),
                         workbooks=workbooks, quarantine=state.path(f"quarantine/batch={run:010d}"))
    derived = cat.derive_file_types(catalog, nodes.where(F.col("kind") == "folder"))      # valid types have been applied
    state.once(cat.split_enum(derived, "file_type", X.FILE_TYPE_VALUES)[1], "unknown_types", run)
    absent = ready
    if path_exists(state.spark, landing):
        landed = fl.list_files(state.spark, landing).select(F.col("file_id").alias("_landed")).distinct()
        absent = anti(ready, landed, F.col("id") == F.col("_landed"))
    state.once(absent, "absent", run)
    cols = old.columns
    changed = catalog.select(cols).exceptAll(old).select("id").distinct()
    touched = table.before(run, table.buckets_of(changed, "id", run)).select("id").union(changed)
    state.write(semi(catalog.select(cols), touched.select(F.col("id").alias("_t")), F.col("id") == F.col("_t")), "catalog", run)
