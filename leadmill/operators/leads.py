"""Lead-vendor pipeline operators: fresh leads (W-1), output frame (P-9/P-10), tracking inserts
(T-1), customer marking (U-4) and per-file metrics (A-1).

All are pure ``DataFrame -> DataFrame`` functions; ``batch_ts`` is a parameter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import det_uuid, ntz, text_escape
from .joins import anti

US = "United States"

# Fixed values (must equal the reference's): output sheet headings and their source columns, in order.
SHEET_COLUMNS = [
    ("First Name", "first_name"),
    ("Last Name", "last_name"),
    ("Title", "job_title"),
    ("Role", "job_function"),
    ("Email", "email_address"),
    ("Linkedin", "linkedin_contact_profile_url"),
    ("Company", "company_name"),
    ("Phone", "phone_number"),
    ("Hubspot Owner", "hubspot_owner"),
    ("ZI Search", "zi_search"),
]

FRESH_COLUMNS = ["uuid", "first_name", "last_name", "job_title", "job_function", "email_address",
                 "linkedin_contact_profile_url", "company_name", "phone_number", "zi_search",
                 "hubspot_owner", "file_name", "file_id", "drive_metadata_uuid"]


def blocked_emails(customers: DataFrame, tracking: DataFrame) -> DataFrame:
    """E-mails that disqualify a lead: customers (J-2) and any tracked e-mail (J-4), one column."""
    return (customers.select(F.col("email").alias("_blocked"))
            .unionByName(tracking.select(F.col("email_address").alias("_blocked"))))


def latest_per_key(df: DataFrame, key: str, order_col: str = "created_at", tie_col: str = "uuid") -> DataFrame:
    """Top-1 row per key by ``order_col`` DESC with NULLs first (Postgres DESC order), ties by
    ``tie_col`` ascending (Q3). ``row_number() = 1`` plans as a partial + final
    ``WindowGroupLimit``, so a hot key is cut to one row per task before the shuffle."""
    w = Window.partitionBy(key).orderBy(F.col(order_col).desc_nulls_first(), F.col(tie_col).asc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def fresh_leads(leads: DataFrame, customers: DataFrame, tracking: DataFrame, catalog: DataFrame,
                blank_as_null: bool = False) -> DataFrame:
    """W-1 with F-4, J-2, J-3, J-4, F-5, J-13, for all files at once.

    Eligible = e-mail not null, US company, no tracking row for the lead, e-mail neither a
    customer nor tracked. Ranking runs over eligible rows of *all* files; the file's config must
    be present (filter after ranking). The e-mail anti joins drop whole e-mail groups, so they
    commute with the per-e-mail window and run after it, on one row per e-mail, sharing the
    window's partitioning by e-mail. The per-lead anti join (J-3) changes which row ranks first,
    so it runs before the window.
    """
    email = F.col("email_address")
    eligible = leads.where(email.isNotNull() & (F.col("company_country") == US))
    if blank_as_null:
        eligible = eligible.where(email != "")
    sent = tracking.where(F.col("lead_uuid").isNotNull()).select(F.col("lead_uuid").alias("_sent"))
    eligible = anti(eligible, sent, F.col("uuid") == F.col("_sent"))
    top = latest_per_key(eligible, "email_address")
    top = anti(top, blocked_emails(customers, tracking), email == F.col("_blocked"))
    cat = catalog.where(F.col("config_file_uuid").isNotNull()).select(
        F.col("uuid").alias("_file_uuid"), F.col("name").alias("file_name"), F.col("id").alias("file_id"),
        "zi_search", "hubspot_owner")
    out = top.join(cat, top["drive_metadata_uuid"] == cat["_file_uuid"], "inner")
    return out.select(*[
        F.coalesce(F.col("mobile_phone"), F.col("direct_phone_number")).alias("phone_number")
        if c == "phone_number" else F.col(c) for c in FRESH_COLUMNS])


def output_frame(fresh: DataFrame) -> DataFrame:
    """P-9 + P-10: sheet rows. ``main_contact_linkedin`` is renamed, missing columns become NULL,
    the phone is text-escaped, headings in fixed order; ``file_id`` kept for partitioned output."""
    df = fresh
    if "main_contact_linkedin" in df.columns:
        df = df.withColumnRenamed("main_contact_linkedin", "linkedin_contact_profile_url")
    missing = {src: F.lit(None).cast("string") for _, src in SHEET_COLUMNS if src not in df.columns}
    if missing:
        df = df.withColumns(missing)
    cols = [(text_escape(F.col(src)) if src == "phone_number" else F.col(src)).alias(head)
            for head, src in SHEET_COLUMNS]
    keep = [F.col(c) for c in ("file_id", "file_name") if c in df.columns]
    return df.select(*cols, *keep)


def track_posted(leads: DataFrame, tracking: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    """T-1: new tracking snapshot = old rows + one 'posted' row for every lead with an e-mail and
    no tracking row (``lead_uuid`` match with ``city_search_lead_uuid IS NULL``, J-5). All leads
    of the given files count, not only exported ones. Lead keys are unique (X-14), so no row repeats."""
    seen = tracking.where(F.col("city_search_lead_uuid").isNull() & F.col("lead_uuid").isNotNull()) \
                   .select(F.col("lead_uuid").alias("_seen"))
    new = anti(leads.where(F.col("email_address").isNotNull()), seen, F.col("uuid") == F.col("_seen"))
    new_rows = new.select(
        det_uuid(F.lit("posted"), F.col("uuid")).alias("uuid"),
        F.col("uuid").alias("lead_uuid"),
        F.lit(None).cast(leads.schema["uuid"].dataType).alias("city_search_lead_uuid"),
        F.lit("posted").alias("status"),
        F.col("email_address"),
        ntz(batch_ts).alias("created_at"),
    )
    return tracking.select(*TRACKING_COLUMNS).unionByName(new_rows)


TRACKING_COLUMNS = ["uuid", "lead_uuid", "city_search_lead_uuid", "status", "email_address", "created_at"]


def track_customers(leads: DataFrame, customers: DataFrame, tracking: DataFrame, batch_ts: dt.datetime,
                    lead_key: str = "lead_uuid", email_expr=None) -> DataFrame:
    """U-4 (and U-5 with ``lead_key='city_search_lead_uuid'``): leads whose e-mail is a customer
    and whose tracking row is absent or 'posted' become 'shopify_customer' with a new
    ``created_at``; other statuses stay. Customer e-mails are made distinct first (Q13), so a
    lead matches at most once. Absent tracking rows are inserted with a generated key.

    Written as a left join of the tracking snapshot with the change set by key, plus the inserts.
    """
    email = email_expr if email_expr is not None else F.col("email_address")
    cust = customers.select(F.col("email").alias("_cust")).distinct()
    hit = leads.select(F.col("uuid").alias("_lead"), email.alias("_email")) \
               .join(cust, F.col("_email") == F.col("_cust"), "left_semi")
    t = tracking.select(*TRACKING_COLUMNS)
    # leads with a tracking row: update the 'posted' ones
    hit_keys = hit.select(F.col("_lead").alias("_hk")).distinct()      # one change per lead, whatever its rows
    flagged = t.join(hit_keys, t[lead_key] == hit_keys["_hk"], "left")
    is_update = F.col("_hk").isNotNull() & (F.col("status") == "posted")
    updated = flagged.select(
        "uuid", "lead_uuid", "city_search_lead_uuid",
        F.when(is_update, F.lit("shopify_customer")).otherwise(F.col("status")).alias("status"),
        "email_address",
        F.when(is_update, ntz(batch_ts)).otherwise(F.col("created_at")).alias("created_at"))
    # leads without any tracking row: insert
    untracked = anti(hit.dropDuplicates(["_lead"]), t.where(F.col(lead_key).isNotNull()).select(F.col(lead_key).alias("_tk")),
                     F.col("_lead") == F.col("_tk"))
    key_type = t.schema[lead_key].dataType
    inserted = untracked.select(
        det_uuid(F.lit("shopify_customer"), F.col("_lead")).alias("uuid"),
        (F.col("_lead") if lead_key == "lead_uuid" else F.lit(None)).cast(key_type).alias("lead_uuid"),
        (F.col("_lead") if lead_key == "city_search_lead_uuid" else F.lit(None)).cast(
            t.schema["city_search_lead_uuid"].dataType).alias("city_search_lead_uuid"),
        F.lit("shopify_customer").alias("status"),
        F.col("_email").alias("email_address"),
        ntz(batch_ts).alias("created_at"))
    return updated.unionByName(inserted)


def status_metrics(tracking: DataFrame, leads: DataFrame, catalog: DataFrame, lead_key: str = "lead_uuid") -> DataFrame:
    """A-1 / A-2: per file, count of 'shopify_customer' and 'posted' tracking rows of its leads.

    Grouped by file uuid as well as name and created_at, so two files with one name stay apart
    (Q10). Tracking is pre-aggregated per lead before the join, so the join and the shuffle
    carry one row per tracked lead. Lead keys are unique (X-14).
    """
    per_lead = (tracking.where(F.col(lead_key).isNotNull())
                .groupBy(F.col(lead_key).alias("_lead"))
                .agg(F.sum(F.when(F.col("status") == "shopify_customer", 1).otherwise(0)).alias("_c"),
                     F.sum(F.when(F.col("status") == "posted", 1).otherwise(0)).alias("_p")))
    l = leads.select(F.col("uuid").alias("_lead"), F.col("drive_metadata_uuid").alias("_file"))
    per_file = per_lead.join(l, "_lead").groupBy("_file").agg(F.sum("_c").alias("_c"), F.sum("_p").alias("_p"))
    d = catalog.select(F.col("uuid").alias("_file"), "name", "created_at")
    return per_file.join(d, "_file", "left").select(
        F.col("_file").alias("drive_metadata_uuid"), "name",
        F.col("_c").cast("bigint").alias("number_of_shopify_customers"),
        F.col("_p").cast("bigint").alias("number_of_posted_leads"),
        "created_at")
