"""Semantic units on hand-made frames: the reference's three-valued logic, ties, '' vs NULL,
duplicate keys, empty inputs, header and domain rules, and each quirk decision (Q1 … Q15)."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from leadmill.functions import scalar as X
from leadmill.functions.headers import HeaderCollision, clean_name, clean_names
from leadmill.operators import catalog as cat
from leadmill.operators import city as cy
from leadmill.operators import franchises as fr
from leadmill.operators import leads as ld
from leadmill.operators.joins import not_in

TS = dt.datetime(2024, 1, 29, 12)
D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---- headers (P-1, Q14) -----------------------------------------------------------------------

@pytest.mark.parametrize("raw,clean", [
    ("Revenue (in 000s USD)", "revenue_in_000s_usd"),
    ("a___b", "a__b"),
    ("A/B", "a/b"),
    ("x|/y", "x_y"),
    (" Email Address ", "email_address"),
    ("Job-Title.", "job_title"),
    ("Cost $", "cost_$"),
])
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


def test_header_collision_raises():
    with pytest.raises(HeaderCollision):
        clean_names(["Email Address", "email-address"])


# ---- scalar functions --------------------------------------------------------------------------

def test_domain_key_rules(spark):
    df = spark.createDataFrame([("https://www.a.com/x",), ("http:///x",), ("a.com:8080",), ("http://a.com:8080/p",),
                                ("shop.www.b.com",), ("",), (None,), ("HTTPS://Up.com",)], "u string")
    got = [r[0] for r in df.select(X.domain_key("u")).collect()]
    # port and case kept; '' stays ''; NULL stays NULL; no scheme match -> whole text
    assert got == ["a.com", "", "a.com:8080", "a.com:8080", "shop.b.com", "", None, "HTTPS://Up.com"]


def test_file_type_alias_and_faithful_noop(spark):
    df = spark.createDataFrame([("Data Drop",), (" City Search ",)], "n string")
    assert [r[0] for r in df.select(X.file_type_from_folder("n")).collect()] == ["zi_search", "city_search"]
    assert [r[0] for r in df.select(X.file_type_from_folder("n", apply_alias=False)).collect()] == ["data_drop", "city_search"]


def test_landing_folder_order_differs_for_padded_names(spark):
    df = spark.createDataFrame([(" City Search ",)], "n string")
    assert df.select(X.landing_folder("n")).first()[0] == "_city_search_"


def test_parent_text_and_escape(spark):
    df = spark.createDataFrame([("['abc']", None), ("[]", "123")], "p string, ph string")
    got = df.select(X.parent_from_text("p"), X.text_escape("ph")).collect()
    assert [tuple(r) for r in got] == [("abc", '=""'), ("", '="123"')]


# ---- NOT IN (J-12, Q2) ------------------------------------------------------------------------

@pytest.mark.parametrize("left,right,expect,expect_safe", [
    ([1, 2, None], [], [1, 2, None], [1, 2, None]),          # empty set: all pass, NULL key too
    ([1, 2, None], [2], [1], [1]),                             # NULL key never passes a non-empty set
    ([1, 2, None], [2, None], [], [1]),                        # NULL in set: nothing passes
    ([1, None], [None], [], [1, None]),                        # only NULLs: set of non-nulls is empty
])
def test_not_in_three_valued(spark, left, right, expect, expect_safe):
    l_df = spark.createDataFrame([(v,) for v in left], "k int")
    r_df = spark.createDataFrame([(v,) for v in right], "v int")
    got = sorted((r.k for r in not_in(l_df, "k", r_df, "v").collect()), key=lambda x: (x is None, x))
    assert got == sorted(expect, key=lambda x: (x is None, x))
    got = sorted((r.k for r in not_in(l_df, "k", r_df, "v", null_safe=True).collect()), key=lambda x: (x is None, x))
    assert got == sorted(expect_safe, key=lambda x: (x is None, x))


def test_unseen_elsewhere_null_rules(spark):
    catalog = spark.createDataFrame([("fa", "A"), ("fb", "B")], "uuid string, id string")
    city = spark.createDataFrame([(1, "fa", "x"), (2, "fa", "y"), (3, "fb", "y"), (4, "fb", None)],
                                 "uuid int, drive_metadata_uuid string, dataid string")
    got = rows(cy.unseen_elsewhere(city, catalog), "uuid")
    # A: NULL in other file B -> nothing; B: x only in A, own NULL fails, y shared -> nothing
    assert got == []
    got = rows(cy.unseen_elsewhere(city, catalog, null_safe=True), "uuid")
    assert got == [(1,)]
    only = city.where("drive_metadata_uuid = 'fb'")
    assert rows(cy.unseen_elsewhere(only, catalog), "uuid") == [(3,), (4,)]   # nothing elsewhere: all pass


# ---- latest per e-mail (W-1, Q3, Q4) -----------------------------------------------------------

def _leads(spark, data):
    return spark.createDataFrame(data, "uuid string, drive_metadata_uuid string, email_address string, "
                                       "created_at timestamp_ntz, company_country string, mobile_phone string, "
                                       "direct_phone_number string, first_name string, last_name string, job_title string, "
                                       "job_function string, linkedin_contact_profile_url string, company_name string")


def _catalog(spark, cfg=("c1", "c2")):
    return spark.createDataFrame([("f1", "id1", "one.csv", cfg[0], "o", "s"), ("f2", "id2", "two.csv", cfg[1], "o", "s")],
                                 "uuid string, id string, name string, config_file_uuid string, hubspot_owner string, "
                                 "zi_search string")


EMPTY_T = "uuid string, lead_uuid string, city_search_lead_uuid string, status string, email_address string, created_at timestamp_ntz"


def test_fresh_leads_ties_nulls_and_blank(spark):
    us = "United States"
    data = [("b", "f1", "e@x", D1, us, None, "7", *[None] * 6),
            ("a", "f2", "e@x", D1, us, "5", None, *[None] * 6),       # tie on created_at: uuid 'a' wins
            ("c", "f1", "", D1, us, None, None, *[None] * 6),         # '' passes IS NOT NULL (Q4)
            ("d", "f1", None, D2, us, None, None, *[None] * 6),       # NULL e-mail never
            ("e", "f1", "z@x", D2, "Canada", None, None, *[None] * 6)]
    cust = spark.createDataFrame([], "email string")
    track = spark.createDataFrame([], EMPTY_T)
    out = ld.fresh_leads(_leads(spark, data), cust, track, _catalog(spark))
    assert rows(out, "uuid", "phone_number") == [("a", "5"), ("c", None)]
    out = ld.fresh_leads(_leads(spark, data), cust, track, _catalog(spark), blank_as_null=True)
    assert rows(out, "uuid") == [("a",)]


def test_fresh_leads_newest_copy_in_unconfigured_file_hides_older(spark):
    us = "United States"
    data = [("a", "f1", "e@x", D1, us, *[None] * 8), ("b", "f2", "e@x", D2, us, *[None] * 8)]
    out = ld.fresh_leads(_leads(spark, data), spark.createDataFrame([], "email string"),
                         spark.createDataFrame([], EMPTY_T), _catalog(spark, cfg=("c1", None)))
    assert out.count() == 0    # F-5 after ranking: newest copy is in f2 (no config)


def test_fresh_leads_tracked_uuid_changes_ranking(spark):
    us = "United States"
    data = [("a", "f1", "e@x", D1, us, *[None] * 8), ("b", "f1", "e@x", D2, us, *[None] * 8)]
    track = spark.createDataFrame([("t", "b", None, "posted", "other@x", D1)], EMPTY_T)
    out = ld.fresh_leads(_leads(spark, data), spark.createDataFrame([], "email string"), track, _catalog(spark))
    assert rows(out, "uuid") == [("a",)]


# ---- tracking (T-1, U-4, Q1, Q13) --------------------------------------------------------------

def test_track_customers_updates_posted_inserts_missing_and_dedupes(spark):
    lead = spark.createDataFrame([("l1", "c@x"), ("l2", "c@x"), ("l3", "n@x")], "uuid string, email_address string")
    cust = spark.createDataFrame([("c@x",), ("c@x",)], "email string")          # duplicate customer (Q13)
    track = spark.createDataFrame([("t1", "l1", None, "posted", "c@x", D1), ("t2", "l1", None, "emailed", "c@x", D1)],
                                  EMPTY_T)
    out = ld.track_customers(lead, cust, track, TS)
    got = rows(out, "lead_uuid", "status")
    assert got == [("l1", "emailed"), ("l1", "shopify_customer"), ("l2", "shopify_customer")]
    assert out.select("uuid").distinct().count() == 3


def test_city_track_posted_skip_and_repeat(spark):
    e = spark.createDataFrame([("c1", "a@x", None), ("c2", None, "g@x"), ("c3", None, None)],
                              "uuid string, main_point_of_contact_email string, generic_contact_email string")
    track = spark.createDataFrame([("t1", None, "c1", "posted", "a@x", D1), ("t2", None, "c1", "emailed", "a@x", D1)], EMPTY_T)
    skip = cy.city_track_posted(e, track, TS)
    assert skip.count() == 3        # 2 old + c2
    repeat = cy.city_track_posted(e, track, TS, on_seen="repeat")
    assert repeat.count() == 5      # 2 old + c1 twice (one per existing row) + c2


# ---- catalog (F-1, D-1, U-1, V-2, Q5, Q8, Q11) ---------------------------------------------------

def _cat(spark):
    return spark.createDataFrame([
        ("u1", "id1", "a.csv", None, None, "zi_search"),
        ("u2", "id2", "b.csv", None, None, None),           # NULL type: not reported (3-valued NOT IN)
        ("u3", "id3", "c.csv", None, None, "city_search"),
        ("u4", "id4", "d.csv", None, True, "zi_search"),
        ("u5", "id5", "e.csv", "cfg", None, "zi_search")],
        "uuid string, id string, name string, config_file_uuid string, has_posted_on_slack boolean, file_type string")


def test_missing_config_and_wider_mark(spark):
    c = _cat(spark)
    assert rows(cat.missing_config(c), "uuid") == [("u1",)]
    marked = rows(cat.mark_posted(c), "uuid", "has_posted_on_slack")
    assert marked == [("u1", True), ("u2", True), ("u3", True), ("u4", True), ("u5", None)]   # Q8


def test_apply_config_duplicates_and_empty(spark):
    c = _cat(spark).withColumn("hubspot_owner", F.lit(None).cast("string")).withColumn("zi_search", F.lit(None).cast("string"))
    cfg = spark.createDataFrame([("a.csv", "o", "s"), ("e.csv", "o2", "s2")], "a string, b string, c string")
    out = cat.apply_config(c, cfg, TS)
    got = {r.uuid: (r.config_file_uuid is not None, r.hubspot_owner) for r in out.collect()}
    assert got["u1"] == (True, "o") and got["u5"] == (True, None) and got["u2"] == (False, None)
    dup = spark.createDataFrame([("a.csv", "o", "s"), ("a.csv", "p", "t")], "a string, b string, c string")
    with pytest.raises(Exception, match="config names a file twice"):
        cat.apply_config(c, dup, TS).collect()
    first = cat.apply_config(c, dup, TS, on_duplicate="first")
    assert [r.hubspot_owner for r in first.where("uuid = 'u1'").collect()] == ["o"]
    # a repeated name that matches an already configured file changes nothing and repeats nothing
    dup_cfgd = spark.createDataFrame([("e.csv", "o", "s"), ("e.csv", "p", "t")], "a string, b string, c string")
    same = cat.apply_config(c, dup_cfgd, TS)
    assert same.count() == c.count()
    assert rows(same, "uuid", "config_file_uuid") == rows(c, "uuid", "config_file_uuid")
    empty = spark.createDataFrame([], "a string, b string, c string")
    assert rows(cat.apply_config(c, empty, TS), "uuid", "config_file_uuid") == rows(c, "uuid", "config_file_uuid")


def test_enum_quarantine_and_hard_check(spark):
    d = spark.createDataFrame([("u1", "zi_search"), ("u2", "archive_box")], "uuid string, file_type string")
    ok, bad = cat.split_enum(d, "file_type", X.FILE_TYPE_VALUES)
    assert rows(ok, "uuid") == [("u1",)] and rows(bad, "uuid") == [("u2",)]
    with pytest.raises(Exception, match="invalid file_type"):
        cat.enforce_enum(d, "file_type", X.FILE_TYPE_VALUES).collect()


def test_ready_files_scopes(spark):
    c = spark.createDataFrame([("u1", "id1", "cfg", "zi_search", True), ("u2", "id2", None, "city_search", None),
                               ("u3", "id3", None, "zi_search", None), ("u4", "id4", "cfg", None, False)],
                              "uuid string, id string, config_file_uuid string, file_type string, has_been_processed boolean")
    ids = spark.createDataFrame([("id1",), ("id3",)], "id string")
    assert rows(cat.ready_files(c, ids), "id") == [("id1",)]                  # scope='new'
    assert rows(cat.ready_files(c), "id") == [("id2",), ("id4",)]             # scope='pending' (Q7)


# ---- franchises (A-4, U-3, J-14) ----------------------------------------------------------------

def test_franchise_upsert_null_keys_insert_again(spark):
    tgt = spark.createDataFrame([("u1", "A", "a.com", D1, None), ("u2", None, "n.com", D1, None)],
                                "uuid string, franchise_name string, domain_name string, created_at timestamp_ntz, "
                                "updated_at timestamp_ntz")
    src = spark.createDataFrame([(2, "A", "a.com"), (1, "A2", "a.com"), (3, None, "n.com")],
                                "row_no int, n string, d string").select("n", "d", "row_no")
    out = fr.upsert_franchises(tgt, src, TS)
    # keep-first by row: (A2, a.com) wins over (A, a.com); so u1 is not matched and A2 is inserted;
    # the NULL-name row never matches and is inserted again
    assert out.count() == 4
    inserted = out.where(F.col("created_at") == F.lit(TS).cast("timestamp_ntz"))
    assert sorted((r.franchise_name or "", r.domain_name) for r in inserted.collect()) == [("", "n.com"), ("A2", "a.com")]
    assert out.where(F.col("updated_at").isNotNull()).count() == 0
    same = spark.createDataFrame([(1, "A", "a.com")], "row_no int, n string, d string").select("n", "d", "row_no")
    upd = fr.upsert_franchises(tgt, same, TS)
    assert upd.count() == 2 and rows(upd.where("updated_at IS NOT NULL"), "uuid") == [("u1",)]


# ---- splits (F-9, Q9) ---------------------------------------------------------------------------

def test_split_drops_one_name_rows(spark):
    f = spark.createDataFrame([("A", "B"), (None, None), ("A", None)], "`First Name` string, `Last Name` string")
    assert cy.split_personal(f).count() == 1 and cy.split_generic(f).count() == 1 and cy.split_residual(f).count() == 1


# ---- listing bounds (S-1 text comparison vs S-3 API comparison) ---------------------------------

def test_listing_bounds(spark):
    from leadmill.operators import listing as ls
    now = dt.datetime(2024, 1, 29, 12)
    bound = dt.datetime(2024, 1, 22)
    nodes = spark.createDataFrame([
        ("r", None, "root", "folder", False, D1, D1),
        ("p", "r", "Processed", "folder", False, D1, D1),
        ("a", "r", "at_bound.csv", "file", False, D1, bound),
        ("b", "r", "after.csv", "file", False, D1, bound + dt.timedelta(seconds=1)),
        ("c", "p", "archived.csv", "file", False, D1, bound + dt.timedelta(days=1)),
        ("d", "r", "trashed.csv", "file", True, D1, bound + dt.timedelta(days=1)),
    ], "id string, parent string, name string, kind string, trashed boolean, created_time timestamp_ntz, "
       "modified_time timestamp_ntz").withColumn("file_extension", F.lit("csv"))
    roots = nodes.where("parent IS NULL")
    rec = rows(ls.recent_files_recursive(nodes, roots, now, 7), "id")
    assert rec == [("a",), ("b",)]            # '…T00:00:00.000Z' > '…T00:00:00' as text; Processed never entered
    flat = rows(ls.recent_files_flat(nodes, now, 7), "id")
    assert flat == [("b",), ("c",)]           # the API compares strictly; folders and trash excluded


@pytest.mark.parametrize("nulls", [False, True])
def test_unseen_elsewhere_restricted_to_files_equals_filtered_full(spark, sf_small, nulls):
    from leadmill.sources.tables import Tables
    t = Tables(spark, sf_small)
    city = t.city_search_nulls if nulls else t.city_search
    ids = spark.createDataFrame([("id1",), ("id2",), ("id6",)], "file_id string")
    full = cy.unseen_elsewhere(city, t.drive_metadata).where(F.col("file_id").isin("id1", "id2", "id6"))
    part = cy.unseen_elsewhere(city, t.drive_metadata, file_ids=ids)
    assert rows(part, "uuid", "file_id") == rows(full, "uuid", "file_id")


def test_keys_tell_separators_nulls_and_repeats_apart(spark):
    from leadmill.functions.scalar import det_uuid
    from leadmill.operators.align import row_uuid
    rows = spark.createDataFrame([("f", "a|b", "c"), ("f", "a", "b|c"), ("f", None, "x"), ("f", "", "x"), ("f", "r", "r"), ("f", "r", "r")],
                                 "file string, p string, q string")
    assert rows.select(det_uuid("file", "p", "q").alias("u")).distinct().count() == 5
    assert row_uuid(rows, "file", ["p", "q"]).select("uuid").distinct().count() == 6


def test_repeated_rows_are_tracked_once_each(spark):
    import datetime as dt
    from leadmill.operators import leads as ld
    from leadmill.operators.align import row_uuid
    ts = dt.datetime(2024, 2, 1)
    raw = spark.createDataFrame([("f1", "a@x.com"), ("f1", "a@x.com")], "drive_metadata_uuid string, email_address string")
    leads = row_uuid(raw, "drive_metadata_uuid", ["email_address"])
    tracking = spark.createDataFrame([], "uuid string, lead_uuid string, city_search_lead_uuid string, status string, "
                                         "email_address string, created_at timestamp_ntz")
    customers = spark.createDataFrame([("a@x.com",), ("a@x.com",)], "email string")
    catalog = spark.createDataFrame([("f1", "n", ts)], "uuid string, name string, created_at timestamp_ntz")
    out = ld.track_customers(leads, customers, ld.track_posted(leads, tracking, ts), ts)
    assert out.count() == 2 and out.select("uuid").distinct().count() == 2
    assert ld.status_metrics(out, leads, catalog).first()["number_of_shopify_customers"] == 2


def test_blank_first_line_does_not_hide_a_file(spark, tmp_path):
    from leadmill.sources import files as fl
    folder = tmp_path / "file_id=id7"
    folder.mkdir()
    (folder / "a.csv").write_text('\n  \nFirst Name,"Last\nName"\nx,y\n')
    rows = [r for g in fl.read_header_groups(spark, fl.list_files(spark, str(tmp_path))) for r in g.drop("path").collect()]
    assert [tuple(r) for r in rows] == [("x", "y", "id7")]


def test_sheets_of_files_with_one_name_stay_apart(spark, tmp_path):
    from leadmill.sinks import writers as wr
    from leadmill.sources import files as fl
    for i in ("id1", "id2"):
        wr.sheet_output(spark.createDataFrame([("b", "s", i, "x" + i)], "book string, sheet string, file_id string, c string"), str(tmp_path / "s"))
    assert sorted((r["file_id"], r["c"]) for r in fl.read_sheets(spark, str(tmp_path / "s")).collect()) == [("id1", "xid1"), ("id2", "xid2")]


def test_files_without_fresh_leads_are_not_tracked(spark, sf_small):
    from pyspark.sql import functions as F
    from leadmill.plans import jobs as pl
    rows = spark.createDataFrame([("f1", "a"), ("f2", "b")], "drive_metadata_uuid string, email_address string")
    assert [r["email_address"] for r in pl._sent_files(rows, rows.where(F.col("email_address") == "a")).collect()] == ["a"]


def test_reader_reports_what_it_refuses(spark, tmp_path):
    """S-6: ragged records, files without a header and line breaks in quotes; short records are filled."""
    files = {"a": 'x,y\n1,2\n3,4,5\n6\n"q,1","a ""b"""\n', "b": "", "c": "\n \n", "d": 'x,y\n"two\nlines",1\n7,8,"9\n9"\n'}
    for name, text in files.items():
        (tmp_path / f"file_id={name}").mkdir()
        (tmp_path / f"file_id={name}" / "part.csv").write_text(text)
    from leadmill.sources import files as fl
    listed = fl.list_files(spark, str(tmp_path))
    paths = {r.path for r in listed.collect()}
    assert {p.split("file_id=")[1][0] for p in fl.quoted_newline_files(spark, sorted(paths))} == {"d"}
    groups, bad = fl.read_checked(spark, listed)
    rows = {(r.file_id, r.x, r.y) for g in groups for r in g.collect()}
    assert rows == {("a", "1", "2"), ("a", "6", None), ("a", "q,1", 'a "b"'), ("d", "two\nlines", "1")}
    assert {(r.file_id, r.reason, r.record) for r in bad.collect()} == {
        ("a", "more cells than the header", "3,4,5"), ("c", "file without a header", None),
        ("d", "more cells than the header", '7,8,"9\n9"')}
    assert [r.file_id for r in fl.empty_files(spark, str(tmp_path)).collect()] == ["b"]
