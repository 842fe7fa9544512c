"""The pipeline's tables, derived from the driver's parquet tables with DataFrame operations.

Every view covers its whole source table, so the work of each query grows with the data:
``leads`` and ``city_search_enriched`` are all of ``orders``, ``drive_metadata`` and the
listings are all of ``supplier``, ``city_search`` is all of ``pages``. Modulo arithmetic only
derives values (nulls, file assignment, statuses); rows are kept or dropped only by predicates
on data (market segment, order date, domain).

The same views as DuckDB text live in ``fixture_sql.py``; both must stay in step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture design.
LEADS_PER_FILE = 150          # orders o_orderkey // 150 -> file f<k>; equals orders per supplier
CITY_FILES = 10               # pages page_id % 10 -> file f<k>
TRACKED_BEFORE = dt.datetime(1995, 3, 1)    # leads ordered before: already posted (lead pipeline)
TRACKED_FROM = dt.datetime(2001, 6, 1)      # enriched contacts ordered from: already posted (city)
LISTING_EPOCH = dt.datetime(2024, 1, 1)     # listing created/modified times count days from here
NOW = dt.datetime(2024, 1, 29, 12, 0, 0)    # "now" of all listing queries
BATCH_TS = dt.datetime(2024, 1, 29, 12, 0, 0)  # batch stamp of loads and merges
FRANCHISE_DOMAIN_SUFFIX = ".example.org"    # listing hosts under this domain are franchise chains
CONFIG_ACCTBAL_BELOW = 3000.0               # suppliers below this balance appear in the config sheet
UNMATCHED_CONFIG_BELOW = 500.0              # ... of which these carry a name no file has
NULL_DATAID_FILE = 1                        # not_in_nulls: NULL dataids only in this city file


_SCANS: dict[tuple, DataFrame] = {}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table, read once per session (file listing and footer reads are not
    repeated for every query; the DataFrame is immutable, so sharing it is safe)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _SCANS[key]


def _s(*parts) -> Column:
    """String concatenation of literals and columns (SQL ``||``)."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _ts(value: dt.datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _plus_days(base: dt.datetime, days: Column) -> Column:
    return F.timestamp_add("DAY", days, _ts(base))


def _ext(key: Column) -> Column:
    return F.when(key % 3 == 0, F.lit(".xlsx")).otherwise(F.lit(".csv"))


def host_of(url: Column) -> Column:
    """Fixture host rule: text after the scheme up to '/', 'www.' removed."""
    has_scheme = url.like("%http://%") | url.like("%https://%")
    return F.replace(F.when(has_scheme, F.regexp_extract(url, r"https?://([^/]*)", 1)).otherwise(url),
                     F.lit("www."), F.lit(""))


def drive_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _t(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    has_cfg = k % 5 != 0
    return s.select(
        _s("f", k).alias("uuid"),
        _s("id", k).alias("id"),
        _s(F.col("s_name"), _ext(k)).alias("name"),
        F.when(k % 4 == 0, F.lit("city_search")).when(k % 4 == 3, F.lit(None).cast("string"))
         .otherwise(F.lit("zi_search")).alias("file_type"),
        F.when(has_cfg, _s("cfg", k)).alias("config_file_uuid"),
        F.when(has_cfg, _s("owner", k % 3)).alias("hubspot_owner"),
        F.when(has_cfg, _s("search", k)).alias("zi_search"),
        F.when(k % 10 == 0, F.lit(True)).alias("has_posted_on_slack"),
        F.when(k % 7 == 0, F.lit(True)).when(k % 7 == 1, F.lit(False)).alias("has_been_processed"),
        _s("n", F.col("s_nationkey")).alias("parent"),
        _s("['n", F.col("s_nationkey"), "']").alias("parents"),
        _s("user", k % 4).alias("lastmodifyinguser_displayname"),
        _plus_days(LISTING_EPOCH, k % 28).alias("created_at"),
    )


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        k.alias("uuid"),
        _s("f", F.floor(k / LEADS_PER_FILE)).alias("drive_metadata_uuid"),
        _s("F", c).alias("first_name"),
        _s("L", c).alias("last_name"),
        F.substring(F.col("o_orderpriority"), 3, 20).alias("job_title"),
        F.col("o_orderstatus").alias("job_function"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).when(k % 23 == 0, F.lit(""))
         .otherwise(_s("c", c, "@x.com")).alias("email_address"),
        _s("https://linkedin.example/in/c", c).alias("linkedin_contact_profile_url"),
        _s("Co", c % 97).alias("company_name"),
        F.when(k % 2 != 0, _s("555", k)).alias("mobile_phone"),
        F.when(k % 3 != 0, _s("777", k)).alias("direct_phone_number"),
        F.when(F.col("o_orderpriority").like("1%"), F.lit("Canada"))
         .otherwise(F.lit("United States")).alias("company_country"),
        F.col("o_orderdate").alias("created_at"),
    )


def sales_customer_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.where(F.col("c_mktsegment") == "BUILDING").select(_s("c", F.col("c_custkey"), "@x.com").alias("email"))


def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    early, late = d < _ts(TRACKED_BEFORE), d >= _ts(TRACKED_FROM)
    return o.where(early | late).select(
        _s("t", k).alias("uuid"),
        F.when(early, k).alias("lead_uuid"),
        F.when(late, k).alias("city_search_lead_uuid"),
        F.when(k % 3 == 0, F.lit("emailed")).otherwise(F.lit("posted")).alias("status"),
        _s("c", F.col("o_custkey"), "@x.com").alias("email_address"),
        d.alias("created_at"),
    )


def city_search(spark: SparkSession, sf_dir: str, with_null_dataids: bool = False) -> DataFrame:
    p = _t(spark, sf_dir, "pages")
    k = F.col("page_id")
    dataid = F.when(k % 6 == 0, _s("d", k % 37)).otherwise(_s("u", k))
    if with_null_dataids:
        dataid = F.when((k % CITY_FILES == NULL_DATAID_FILE) & (k % 3 == 0), F.lit(None).cast("string")).otherwise(dataid)
    return p.select(
        k.alias("uuid"),
        _s("f", k % CITY_FILES).alias("drive_metadata_uuid"),
        F.when(k % 4 == 0, F.lit("chain")).otherwise(F.lit("local")).alias("type"),
        F.when(k % 5 != 0, _s("+1-303-", k)).alias("phone"),
        _s("Biz ", k).alias("title"),
        dataid.alias("dataid"),
        F.when(k % 13 != 0, F.col("url")).alias("website"),
        _s("addr ", k).alias("address"),
        F.when(k % 2 == 0, _s("hello", k, "@biz.com")).alias("emails_0"),
        _s("", k % 20 + 1).alias("position"),
        F.when(k % 3 != 0, _s("4.", k % 10)).alias("rating"),
        F.when(k % 3 != 0, _s("", k % 300)).alias("reviews"),
        F.when(k % 4 == 0, _s("sales", k, "@biz.com")).alias("emails_1"),
        F.when(k % 8 == 0, _s("info", k, "@biz.com")).alias("emails_2"),
        F.when(k % 16 == 0, _s("desk", k, "@biz.com")).alias("emails_3"),
    )


def city_search_franchises(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir, "pages").select("page_id", host_of(F.col("url")).alias("host"))
    g = p.where(F.col("host").endswith(FRANCHISE_DOMAIN_SUFFIX)).groupBy("host").agg(F.min("page_id").alias("m"))
    return g.select(
        _s("fr", F.col("m")).alias("uuid"),
        _s("Franchise ", F.col("m")).alias("franchise_name"),
        F.when(F.col("m") % 2 == 0, _s("https://www.", F.col("host"), "/store")).otherwise(F.col("host")).alias("domain_name"),
        _ts(LISTING_EPOCH).alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def franchise_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Franchise master list as a sheet: one row per franchise listing page, in page order
    (``row_no``); a domain repeats once per page, so keep-first de-duplication has work to do."""
    p = _t(spark, sf_dir, "pages").select("page_id", host_of(F.col("url")).alias("host"))
    return p.where(F.col("host").endswith(FRANCHISE_DOMAIN_SUFFIX)).select(
        F.col("page_id").alias("row_no"), _s("Franchise ", F.col("page_id")).alias("Franchise Name"),
        F.col("host").alias("Domain Name"))


def city_search_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        k.alias("uuid"),
        _s("f", F.floor(k / LEADS_PER_FILE)).alias("drive_metadata_uuid"),
        F.when(k % 5 != 0, _s("F", c)).alias("first_name"),
        F.when(~(k % 5).isin(0, 1), _s("L", c)).alias("last_name"),
        F.when(k % 3 != 0, _s("c", c, "@x.com")).alias("main_point_of_contact_email"),
        _s("https://linkedin.example/in/c", c).alias("main_contact_linkedin"),
        F.when(k % 4 != 0, _s("info", c % 200, "@y.com")).alias("generic_contact_email"),
        _s("Co", c % 97).alias("company_name"),
        F.when(k % 7 != 0, _s("777", k)).alias("phone"),
        F.when(k % 9 != 0, F.col("o_orderdate")).alias("created_at"),
    )


def new_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _t(spark, sf_dir, "supplier")
    return s.select(_s("id", F.col("s_suppkey") + 5).alias("id"), F.col("s_name").alias("name"))


def config_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _t(spark, sf_dir, "supplier").where(F.col("s_acctbal") < CONFIG_ACCTBAL_BELOW)
    k = F.col("s_suppkey")
    return s.select(
        F.when(F.col("s_acctbal") < UNMATCHED_CONFIG_BELOW, _s("no such file ", k))
         .otherwise(_s(F.col("s_name"), _ext(k))).alias("filename"),
        _s("owner", k % 3).alias("hubspot_owner"),
        _s("search", k).alias("zi_search"),
    )


def folder_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _t(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return n.select(_s("n", k).alias("id"), _folder_type_name(k).alias("name"))


def _folder_type_name(k: Column) -> Column:
    return (F.when(k % 5 == 0, F.lit("ZI Search")).when(k % 5 == 1, F.lit(" City Search "))
            .when(k % 5 == 2, F.lit("Data Drop")).when(k % 5 == 3, F.lit("city_search"))
            .otherwise(F.lit("Archive Box")))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drive listing as one edge table: region roots -> nation folders (named by lead type) ->
    an optional 'Processed' folder -> supplier files. Times as timestamps."""
    r, n, s = _t(spark, sf_dir, "region"), _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "supplier")
    folder_t = _ts(LISTING_EPOCH)
    roots = r.select(_s("r", F.col("r_regionkey")).alias("id"), F.lit(None).cast("string").alias("parent"),
                     F.col("r_name").alias("name"), F.lit("folder").alias("kind"), F.lit(False).alias("trashed"),
                     folder_t.alias("created_time"), folder_t.alias("modified_time"),
                     F.lit(None).cast("string").alias("file_extension"))
    nk = F.col("n_nationkey")
    folders = n.select(_s("n", nk).alias("id"), _s("r", F.col("n_regionkey")).alias("parent"),
                       _folder_type_name(nk).alias("name"), F.lit("folder").alias("kind"), F.lit(False).alias("trashed"),
                       folder_t.alias("created_time"), folder_t.alias("modified_time"),
                       F.lit(None).cast("string").alias("file_extension"))
    processed = n.where(nk % 3 == 0).select(
        _s("p", nk).alias("id"), _s("n", nk).alias("parent"), F.lit("Processed").alias("name"),
        F.lit("folder").alias("kind"), F.lit(False).alias("trashed"),
        folder_t.alias("created_time"), folder_t.alias("modified_time"), F.lit(None).cast("string").alias("file_extension"))
    k, nat = F.col("s_suppkey"), F.col("s_nationkey")
    created = _plus_days(LISTING_EPOCH, k % 28)
    files = s.select(
        _s("id", k).alias("id"),
        F.when((k % 6 == 5) & (nat % 3 == 0), _s("p", nat)).otherwise(_s("n", nat)).alias("parent"),
        _s(F.col("s_name"), _ext(k)).alias("name"), F.lit("file").alias("kind"), (k % 11 == 10).alias("trashed"),
        created.alias("created_time"), F.timestamp_add("DAY", k % 5, created).alias("modified_time"),
        F.substring(_ext(k), 2, 4).alias("file_extension"))
    return roots.unionByName(folders).unionByName(processed).unionByName(files)


def listing_records(spark: SparkSession, sf_dir: str, id_shift: int = 0) -> DataFrame:
    """Drive listing records as the API returns them: arrays for parents/owners and one nested
    struct for the last modifying user (input of the one-level flatten). ``id_shift`` moves the
    ids (as ``new_listing`` does) so some records are new to the catalog."""
    s = _t(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        _s("id", k + id_shift).alias("id"),
        _s(F.col("s_name"), _ext(k)).alias("name"),
        F.array(_s("n", F.col("s_nationkey"))).alias("parents"),
        F.array(_s("owner", k % 3, "@corp.com")).alias("owners"),
        F.struct(_s("user", k % 4).alias("displayName"), F.lit("drive#user").alias("kind"),
                 (k % 2 == 0).alias("me"), _s("perm", k).alias("permissionId"),
                 F.when(k % 6 != 0, _s("user", k % 4, "@corp.com")).alias("emailAddress")).alias("lastModifyingUser"),
        F.substring(_ext(k), 2, 4).alias("fileExtension"),
    )


FILES_PER_PAGE = 100
PAGE_SCHEMA = ("nextPageToken string, files array<struct<id: string, name: string, parents: array<string>, "
               "owners: array<struct<displayName: string, me: boolean, emailAddress: string>>, "
               "lastModifyingUser: struct<displayName: string, photo: struct<link: string, size: int>>, size: bigint>>")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing as the API's answers: JSON text of at most ``FILES_PER_PAGE`` files each. Files may have two parents, no
    last user, and owners as a list of objects."""
    s = _t(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    owner = F.struct(_s("user", k % 4).alias("displayName"), (k % 2 == 0).alias("me"),
                     F.when(k % 6 != 0, _s("o'user", k % 4, "@corp.com")).alias("emailAddress"))
    file = F.struct(
        _s("id", k).alias("id"), _s(F.col("s_name"), _ext(k)).alias("name"),
        F.when(k % 4 == 1, F.array(_s("n", F.col("s_nationkey")), F.lit("shared"))).otherwise(F.array(_s("n", F.col("s_nationkey")))).alias("parents"),
        F.array(owner).alias("owners"),
        F.when(k % 5 != 0, F.struct(_s("user", k % 4).alias("displayName"),
                                    F.struct(_s("p/", k).alias("link"), (k % 9).cast("int").alias("size")).alias("photo"))).alias("lastModifyingUser"),
        F.when(k % 8 != 0, k * 1000).alias("size"))
    page = F.floor(k / FILES_PER_PAGE)
    return s.groupBy(page.alias("_page")).agg(F.collect_list(file).alias("files")).select(
        F.to_json(F.struct(_s("t", F.col("_page")).alias("nextPageToken"), "files")).alias("page"))


# ---- vendor lead files (CSV) derived from the leads view -------------------------------------

VENDOR_LAYOUTS = 3   # file number % 3 picks the header layout of a lead file


def vendor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead rows as a vendor sends them: vendor values (missing markers like 'N/A', zip codes
    with leading zeros, quotes, commas, line breaks) plus the file's id and layout number."""
    ld = leads(spark, sf_dir)
    k = F.col("uuid")
    fno = F.floor(k / LEADS_PER_FILE)
    return ld.select(
        _s("id", fno).alias("file_id"),
        (fno % VENDOR_LAYOUTS).cast("int").alias("layout"),
        k.cast("string").alias("zoominfo_contact_id"),
        "first_name", "last_name",
        F.when(k % 19 == 0, F.lit("N/A")).otherwise(F.col("job_title")).alias("job_title"),
        "job_function", "email_address", "linkedin_contact_profile_url",
        F.when(k % 31 == 0, _s(F.col("company_name"), ' "The Best"'))
         .when(k % 29 == 0, _s(F.col("company_name"), ", Inc")).otherwise(F.col("company_name")).alias("company_name"),
        "mobile_phone", "direct_phone_number",
        F.lpad((k % 100000).cast("string"), 5, "0").alias("person_zip_code"),
        (F.col("uuid") % 1000).cast("string").alias("revenue_in_000s_usd"),
        "company_country",
        F.when(k % 11 == 0, F.lit("line one\nline two")).otherwise(F.lit("nan")).alias("notes"),
    )


# Headings per layout, in file order: (heading, source column). Layout 1 lacks the mobile phone
# and carries a stray drive_metadata_uuid and an extra Notes column; layout 2 lacks the direct
# phone and revenue and uses other letter case.
VENDOR_HEADINGS = {
    0: [("ZoomInfo Contact ID", "zoominfo_contact_id"), ("First Name", "first_name"), ("Last Name", "last_name"),
        ("Job Title", "job_title"), ("Job Function", "job_function"), ("Email Address", "email_address"),
        ("LinkedIn Contact Profile URL", "linkedin_contact_profile_url"), ("Company Name", "company_name"),
        ("Mobile phone", "mobile_phone"), ("Direct Phone Number", "direct_phone_number"),
        ("Person Zip Code", "person_zip_code"), ("Revenue (in 000s USD)", "revenue_in_000s_usd"),
        ("Company Country", "company_country")],
    1: [("Email Address", "email_address"), ("ZoomInfo Contact ID", "zoominfo_contact_id"),
        ("drive_metadata_uuid", "_stray"), ("Company  Country ", "company_country"), ("Last Name", "last_name"),
        ("First Name", "first_name"), ("Job Title", "job_title"), ("Job Function", "job_function"),
        ("Direct Phone Number", "direct_phone_number"), ("Company Name", "company_name"),
        ("LinkedIn Contact Profile URL", "linkedin_contact_profile_url"), ("Person Zip Code", "person_zip_code"),
        ("Revenue (in 000s USD)", "revenue_in_000s_usd"), ("Notes", "notes")],
    2: [("ZOOMINFO CONTACT ID", "zoominfo_contact_id"), ("FIRST NAME", "first_name"), ("last name", "last_name"),
        ("Job-Title", "job_title"), ("Job.Function", "job_function"), ("Email Address", "email_address"),
        ("LinkedIn Contact Profile URL", "linkedin_contact_profile_url"), ("Company Name", "company_name"),
        ("Mobile Phone", "mobile_phone"), ("Person Zip Code", "person_zip_code"), ("Company Country", "company_country")],
}


def _files_named(spark: SparkSession, sf_dir: str, ext: str) -> DataFrame:
    return drive_metadata(spark, sf_dir).where(F.col("name").endswith(ext)).select(F.col("id").alias("_id"))


def write_vendor_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the ``.csv``-named lead files as CSV below ``root/file_id=<id>/`` (one header per
    part file), one write per layout; returns ``root``."""
    from ..sinks.writers import write_partitioned_csv
    rows = vendor_rows(spark, sf_dir).join(_files_named(spark, sf_dir, ".csv"), F.col("file_id") == F.col("_id"),
                                           "left_semi").withColumn("_stray", F.lit("WRONG"))
    for layout, heads in VENDOR_HEADINGS.items():
        part = rows.where(F.col("layout") == layout).select(
            "file_id", *[F.col(src).alias(head) for head, src in heads])
        write_partitioned_csv(part, root, ["file_id"], mode="append")
    return root


def write_damaged_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    """All lead rows as CSV lines under ``root/file_id=<id>/``, with faults: records with one cell more or one less than the
    header, files whose id no catalog knows (``new<k>``), and files that hold a blank line only. Returns ``root``."""
    from ..sinks.writers import write_partitioned_lines
    k = F.col("uuid")
    fno = F.floor(k / LEADS_PER_FILE)
    file_id = F.concat(F.when(fno % 7 == 3, "new").otherwise("id"), fno.cast("string")).alias("file_id")
    cells = [F.coalesce("email_address", F.lit("")), k.cast("string")]
    title = F.concat(F.lit('"'), F.coalesce("job_title", F.lit("")), F.lit(', line"'))
    line = F.when(k % 17 == 0, F.concat_ws(",", *cells)).when(k % 13 == 0, F.concat_ws(",", *cells, title, F.lit("one more"))) \
        .otherwise(F.concat_ws(",", *cells, title))
    rows = leads(spark, sf_dir)
    write_partitioned_lines(rows.select(file_id, line.alias("_line")), root, ["file_id"], "txt", "Email Address,ZoomInfo Contact ID,Job Title", "append")
    blank = rows.where(fno % 5 == 2).select(file_id).distinct().select("file_id", F.lit("").alias("_line"))
    write_partitioned_lines(blank, f"{root}/blank", ["file_id"], "txt", None, "append")
    return root


def write_vendor_workbooks(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the ``.xlsx``-named lead files as workbooks below ``root/file_id=<id>/`` (S-8
    input); each file is split into bounded workbooks. Returns ``root``."""
    from .xlsx import write_workbooks
    rows = vendor_rows(spark, sf_dir).join(_files_named(spark, sf_dir, ".xlsx"), F.col("file_id") == F.col("_id"),
                                           "left_semi")
    heads = VENDOR_HEADINGS[0]
    write_workbooks(rows.select("file_id", *[F.col(src).alias(h) for h, src in heads]), root).count()
    return root


TYPED_KINDS = {"Ordered": "date", "Called": "time", "Talked": "elapsed", "Subscribed": "boolean", "Score": "error", "Price": "number"}
SERIAL_EPOCH = {False: "1899-12-30", True: "1904-01-01"}     # day 0 of the two date systems of workbooks


def write_typed_workbooks(spark: SparkSession, sf_dir: str, root: str) -> str:
    """All orders as workbooks ``root/<system>/file_id=<id>/`` with typed cells: date and time serials, elapsed times,
    booleans, errors, numbers; files with an odd number count their days from 1904. Returns ``root``."""
    from .xlsx import write_workbooks
    o = _t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    fno = F.floor(k / LEADS_PER_FILE)
    for date1904, epoch in SERIAL_EPOCH.items():
        days = F.datediff(F.col("o_orderdate"), F.lit(epoch).cast("date"))
        second = k % 86400 / F.lit(86400.0)
        rows = o.where(fno % 2 == int(date1904)).select(
            _s("id", fno).alias("file_id"), k.cast("string").alias("ZoomInfo Contact ID"),
            F.when(k % 9 != 0, (days + second).cast("string")).alias("Ordered"), second.cast("string").alias("Called"),
            (k % 100 / F.lit(24.0)).cast("string").alias("Talked"), (k % 2).cast("string").alias("Subscribed"),
            F.when(k % 3 == 0, F.lit("#DIV/0!")).alias("Score"), (k % 1000 / F.lit(4.0)).cast("string").alias("Price"))
        write_workbooks(rows, f"{root}/{'1904' if date1904 else '1900'}", kinds=TYPED_KINDS, date1904=date1904).count()
    return root


# City-search listings and enriched contacts as vendor files. Headings as the scraping and
# enrichment tools export them; they clean (P-1) to the stored table's names.
CITY_HEADINGS = [("type", "type"), ("phone", "phone"), ("title", "title"), ("dataId", "dataid"),
                 ("website", "website"), ("address", "address"), ("emails.0", "emails_0"),
                 ("emails.1", "emails_1"), ("emails.2", "emails_2"), ("emails.3", "emails_3"), ("position", "position"),
                 ("rating", "rating"), ("reviews", "reviews"), ("keyword", "_keyword")]
ENRICHED_HEADINGS = [("First Name", "first_name"), ("Last Name", "last_name"),
                     ("Main Point of Contact Email", "main_point_of_contact_email"),
                     ("Main Contact Linkedin", "main_contact_linkedin"), ("Generic Contact Email", "generic_contact_email"),
                     ("Company Name", "company_name"), ("Website", "_website"), ("Phone", "phone")]


def write_city_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    from ..sinks.writers import write_partitioned_csv
    c = city_search(spark, sf_dir).withColumn("file_id", F.regexp_replace("drive_metadata_uuid", "^f", "id")) \
                                  .withColumn("_keyword", F.lit("plumber"))
    write_partitioned_csv(c.select("file_id", *[F.col(s).alias(h) for h, s in CITY_HEADINGS]), root, ["file_id"])
    return root


def write_enriched_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    from ..sinks.writers import write_partitioned_csv
    e = city_search_enriched(spark, sf_dir).withColumn("file_id", F.regexp_replace("drive_metadata_uuid", "^f", "id")) \
                                            .withColumn("_website", F.lit(None).cast("string"))
    write_partitioned_csv(e.select("file_id", *[F.col(s).alias(h) for h, s in ENRICHED_HEADINGS]), root, ["file_id"])
    return root
