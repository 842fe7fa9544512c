"""City-search operators: the listing sheet (J-15/J-16, P-11, F-8), enriched contacts (W-2, F-9),
their tracking (T-2, U-5) and metrics (A-2). All files at once; ``file_id`` kept on every row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import det_uuid, ntz, sheet_name, text_escape
from ..session import work_dir
from .joins import anti, domain_join
from .leads import TRACKING_COLUMNS, blocked_emails, latest_per_key, status_metrics, track_customers

# Fixed values (must equal the reference's): blank hand-fill columns of the city sheet, in order.
CITY_BLANK_COLUMNS = ["first_name", "last_name", "Main Point of Contact Email", "Main Contact Linkedin",
                      "Generic Contact Email"]
CITY_TAIL_COLUMNS = ["website", "phone", "position", "rating", "address", "reviews", "emails_0", "emails_1",
                     "emails_2", "emails_3"]
FRANCHISE_SUFFIX = "_franchise"
NON_FRANCHISE_SUFFIX = "_non_franchise"


def coalesced_email(df: DataFrame):
    return F.coalesce(F.col("main_point_of_contact_email"), F.col("generic_contact_email"))


def unseen_elsewhere(city: DataFrame, catalog: DataFrame, null_safe: bool = False,
                     file_ids: DataFrame | None = None) -> DataFrame:
    """J-12 for every file at once: listing rows of file f whose ``dataid`` is
    ``NOT IN (dataids of rows outside f)``, with SQL's NULL rules per file:

    * no rows outside f: every row of f passes, NULL dataid too;
    * a NULL dataid outside f: no row of f passes (``null_safe=True`` ignores those NULLs);
    * otherwise a row passes when its dataid is not NULL and occurs in no other file.

    File f = catalog id; a row whose file uuid has no catalog row is outside every file.
    The listing is read twice: once for its counts per (dataid, file), which are checkpointed and from which the totals and the
    statistics per file and per dataid come, and once for the rows. The counts aggregate
    map-side, so a hot dataid or a hot file costs one row per task in the shuffle.
    ``file_ids`` (column ``file_id``) limits the output to those files; only their dataids are then
    counted one by one, all others in one count per file (one reading more, to find them).
    """
    carried = [F.col("name").alias("file_name")] if "name" in catalog.columns else []       # saves a second join
    ids = catalog.select(F.col("uuid").alias("_fu"), F.col("id").alias("file_id"), *carried)
    c = city.join(ids, city["drive_metadata_uuid"] == ids["_fu"], "left").drop("_fu")
    mine = c.where(F.col("file_id").isNotNull())
    if file_ids is None:
        seen = c.select(F.col("dataid").alias("_d"), "file_id", "dataid")
    else:       # dataids of other files only count by file
        mine = mine.join(file_ids.select(F.col("file_id").alias("_sel")).distinct(),
                         F.col("file_id") == F.col("_sel"), "left_semi")
        seen = c.select("dataid", "file_id").join(mine.select(F.col("dataid").alias("_d")).distinct(), F.col("dataid") == F.col("_d"), "left")
    work_dir(city.sparkSession)
    cells = seen.groupBy("_d", "file_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(F.col("dataid").isNull(), 1)).alias("_nulls")).checkpoint()
    per_file = cells.groupBy("file_id").agg(F.sum("_n").alias("_n_f"), F.sum("_nulls").alias("_nulls_f"))
    totals = cells.select(F.struct(F.sum("_n").alias("n"), F.sum("_nulls").alias("nulls"))).scalar()
    per_id = cells.where(F.col("_d").isNotNull()).groupBy("_d").agg(
        F.min("file_id").alias("_min_f"), F.max("file_id").alias("_max_f"),
        F.count(F.when(F.col("file_id").isNull(), 1)).alias("_orphans"))
    rows = mine.join(per_file, "file_id") \
            .join(per_id, F.col("dataid") == F.col("_d"), "left")
    others = totals.getField("n") - F.col("_n_f")
    other_nulls = totals.getField("nulls") - F.col("_nulls_f")
    only_here = F.col("dataid").isNotNull() & (F.col("_min_f") == F.col("_max_f")) & (F.col("_orphans") == 0)
    if null_safe:   # the set is the non-NULL dataids outside f
        keep = (others - other_nulls == 0) | only_here
    else:
        keep = (others == 0) | ((other_nulls == 0) & only_here)
    return rows.where(keep).drop("_n_f", "_nulls_f", "_d", "_min_f", "_max_f", "_orphans")


def city_sheet(city: DataFrame, catalog: DataFrame, franchises: DataFrame, null_safe: bool = False,
               file_ids: DataFrame | None = None) -> DataFrame:
    """J-15: the city-search output rows of every file (or of ``file_ids``): NOT IN over other
    files (J-12), inner join to the catalog (J-13), left join to franchises on the normalised
    domain (J-11), constant and renamed columns (P-13). One row per matching franchise, as in SQL."""
    rows = unseen_elsewhere(city, catalog, null_safe, file_ids)
    out = domain_join(rows, "website", franchises.select("franchise_name", "domain_name"), "domain_name", "left")
    return out.select(
        "uuid", "franchise_name", "domain_name", "type",
        *[F.lit("").alias(c) for c in CITY_BLANK_COLUMNS],
        F.col("title").alias("company_name"),
        *CITY_TAIL_COLUMNS, "file_name", "file_id")


def city_sheet_parts(sheet: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J-16 / P-11 / F-8: phone text-escaped, ``file_name`` dropped, split by franchise match;
    the non-franchise part also loses the two franchise columns. Each row carries its target
    sheet name (first 30 characters of the file name + suffix, X-9) and ``file_id``."""
    s = sheet.withColumn("phone", text_escape(F.col("phone")))
    fr = s.where(F.col("franchise_name").isNotNull()) \
          .withColumn("sheet", sheet_name(F.col("file_name"), FRANCHISE_SUFFIX)).drop("file_name")
    other = s.where(F.col("franchise_name").isNull()) \
             .withColumn("sheet", sheet_name(F.col("file_name"), NON_FRANCHISE_SUFFIX)) \
             .drop("file_name", "franchise_name", "domain_name")
    return fr, other


def city_fresh_leads(enriched: DataFrame, customers: DataFrame, tracking: DataFrame, catalog: DataFrame) -> DataFrame:
    """W-2: latest enriched contact per coalesced e-mail, like W-1 but keyed on
    ``coalesce(main, generic)`` and on ``city_search_lead_uuid``; NULL ``created_at`` ranks first."""
    e = enriched.withColumn("email_address", coalesced_email(enriched)).where(F.col("email_address").isNotNull())
    sent = tracking.where(F.col("city_search_lead_uuid").isNotNull()).select(F.col("city_search_lead_uuid").alias("_sent"))
    e = anti(e, sent, F.col("uuid") == F.col("_sent"))
    top = latest_per_key(e, "email_address")
    top = anti(top, blocked_emails(customers, tracking), F.col("email_address") == F.col("_blocked"))
    cat = catalog.where(F.col("config_file_uuid").isNotNull()).select(
        F.col("uuid").alias("_file_uuid"), F.col("name").alias("file_name"), F.col("id").alias("file_id"),
        "zi_search", "hubspot_owner")
    out = top.join(cat, top["drive_metadata_uuid"] == cat["_file_uuid"], "inner")
    return out.select("uuid", "first_name", "last_name", F.lit("").alias("job_title"), F.lit("").alias("job_function"),
                      "email_address", "main_contact_linkedin", "company_name", F.col("phone").alias("phone_number"),
                      "zi_search", "hubspot_owner", "file_name", "file_id", "drive_metadata_uuid")


def split_generic(frame: DataFrame) -> DataFrame:
    """F-9: rows with both names NULL (sheet 'Generic of <file>')."""
    return frame.where(F.col("First Name").isNull() & F.col("Last Name").isNull())


def split_personal(frame: DataFrame) -> DataFrame:
    """F-9: rows with both names present. Rows with exactly one name fall in neither (Q9)."""
    return frame.where(F.col("First Name").isNotNull() & F.col("Last Name").isNotNull())


def split_residual(frame: DataFrame) -> DataFrame:
    """Optional third output: the one-name rows the reference drops."""
    return frame.where(F.col("First Name").isNull() != F.col("Last Name").isNull())


def city_track_posted(enriched: DataFrame, tracking: DataFrame, batch_ts: dt.datetime, on_seen: str = "skip") -> DataFrame:
    """T-2: new tracking snapshot = old rows + a 'posted' row per enriched contact with an e-mail.

    ``on_seen='skip'`` (default) leaves out contacts that already have a tracking row;
    ``on_seen='repeat'`` reproduces the reference's outer join without a null test (Q1): nothing
    is left out and each existing tracking row of the contact adds one more copy.
    """
    e = enriched.select(F.col("uuid").alias("_c"), coalesced_email(enriched).alias("_email")) \
                .where(F.col("_email").isNotNull())
    t = tracking.select(*TRACKING_COLUMNS)
    seen = t.where(F.col("city_search_lead_uuid").isNotNull()).select(
        F.col("city_search_lead_uuid").alias("_s"), F.col("uuid").alias("_tu"))
    if on_seen == "skip":
        new = anti(e, seen, F.col("_c") == F.col("_s")).withColumn("_tu", F.lit(None).cast("string"))
    elif on_seen == "repeat":
        new = e.join(seen, F.col("_c") == F.col("_s"), "left").drop("_s")
    else:
        raise ValueError(f"on_seen must be 'skip' or 'repeat', not {on_seen!r}")
    rows = new.select(
        det_uuid(F.lit("posted"), F.lit("city"), F.col("_c"), F.col("_tu")).alias("uuid"),
        F.lit(None).cast(t.schema["lead_uuid"].dataType).alias("lead_uuid"),
        F.col("_c").cast(t.schema["city_search_lead_uuid"].dataType).alias("city_search_lead_uuid"),
        F.lit("posted").alias("status"), F.col("_email").alias("email_address"),
        ntz(batch_ts).alias("created_at"))
    return t.unionByName(rows)


def city_track_customers(enriched: DataFrame, customers: DataFrame, tracking: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    """U-5: U-4 on enriched contacts, keyed by ``city_search_lead_uuid``, coalesced e-mail."""
    return track_customers(enriched, customers, tracking, batch_ts, lead_key="city_search_lead_uuid",
                           email_expr=coalesced_email(enriched))


def city_metrics(tracking: DataFrame, enriched: DataFrame, catalog: DataFrame) -> DataFrame:
    """A-2: A-1 over enriched contacts (join on ``city_search_lead_uuid``)."""
    return status_metrics(tracking, enriched, catalog, lead_key="city_search_lead_uuid")
