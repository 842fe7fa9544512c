"""Properties (hypothesis): merges are idempotent, fresh leads are one per e-mail and never
customers or tracked, NOT IN equals SQL's on random sets with NULLs."""

import datetime as dt

import duckdb
from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from leadmill.operators import catalog as cat
from leadmill.operators import franchises as fr
from leadmill.operators import leads as ld
from leadmill.operators.joins import not_in

TS = dt.datetime(2024, 1, 29, 12)
FAST = settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate])
emails = st.sampled_from(["a@x", "b@x", "c@x", "", None])
keys = st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=6)


def _rows(df):
    cols = sorted(df.columns)
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


@FAST
@given(st.lists(st.tuples(emails, st.integers(0, 3), st.booleans()), min_size=1, max_size=8),
       st.lists(st.sampled_from(["a@x", "b@x"]), max_size=2), st.lists(st.integers(0, 7), max_size=3, unique=True))
def test_fresh_leads_properties(spark, leads, customers, tracked_rows):
    data = [(f"u{i}", f"f{i % 2}", e, dt.datetime(2024, 1, 1 + d), "United States" if us else "Canada",
             None, None, None, None, None, None, None, None) for i, (e, d, us) in enumerate(leads)]
    lf = spark.createDataFrame(data, "uuid string, drive_metadata_uuid string, email_address string, created_at timestamp_ntz, "
                                     "company_country string, mobile_phone string, direct_phone_number string, first_name string, "
                                     "last_name string, job_title string, job_function string, "
                                     "linkedin_contact_profile_url string, company_name string")
    cf = spark.createDataFrame([(c,) for c in customers], "email string")
    tr = spark.createDataFrame([(f"t{i}", f"u{i}", None, "posted", "z@x", TS) for i in tracked_rows],
                               "uuid string, lead_uuid string, city_search_lead_uuid string, status string, "
                               "email_address string, created_at timestamp_ntz")
    catalog = spark.createDataFrame([("f0", "id0", "a.csv", "c", "o", "s"), ("f1", "id1", "b.csv", "c", "o", "s")],
                                    "uuid string, id string, name string, config_file_uuid string, hubspot_owner string, zi_search string")
    out = ld.fresh_leads(lf, cf, tr, catalog).collect()
    got = [r.email_address for r in out]
    assert len(got) == len(set(got))                                  # one row per e-mail
    assert not set(got) & set(customers)                              # never a customer
    assert not {r.uuid for r in out} & {f"u{i}" for i in tracked_rows}   # never a tracked lead
    assert None not in got


@FAST
@given(st.lists(st.tuples(st.sampled_from(["a.csv", "b.csv", "c.csv", "d.csv"]), st.booleans()), min_size=1, max_size=5,
                unique_by=lambda t: t[0]),
       st.lists(st.sampled_from(["a.csv", "b.csv", "x.csv"]), unique=True, max_size=3))
def test_apply_config_is_idempotent(spark, files, names):
    c = spark.createDataFrame([(f"u{i}", n, "cfg" if has else None, None, None) for i, (n, has) in enumerate(files)],
                              "uuid string, name string, config_file_uuid string, hubspot_owner string, zi_search string")
    cfg = spark.createDataFrame([(n, "o", "s") for n in names], "filename string, hubspot_owner string, zi_search string")
    once = cat.apply_config(c, cfg, TS)
    assert _rows(cat.apply_config(once, cfg, TS)) == _rows(once)


@FAST
@given(st.lists(st.tuples(emails, st.booleans()), min_size=1, max_size=6), st.lists(st.integers(0, 5), max_size=3, unique=True))
def test_tracking_merges_are_idempotent(spark, leads, tracked):
    lf = spark.createDataFrame([(f"u{i}", e) for i, (e, _) in enumerate(leads)], "uuid string, email_address string")
    cust = spark.createDataFrame([(e,) for e, is_c in leads if is_c and e], "email string")
    tr = spark.createDataFrame([(f"t{i}", f"u{i}", None, "posted", "z@x", TS) for i in tracked],
                               "uuid string, lead_uuid string, city_search_lead_uuid string, status string, "
                               "email_address string, created_at timestamp_ntz")
    t1 = ld.track_posted(lf, tr, TS)
    assert _rows(ld.track_posted(lf, t1, TS)) == _rows(t1)
    t2 = ld.track_customers(lf, cust, t1, TS)
    assert _rows(ld.track_customers(lf, cust, t2, TS)) == _rows(t2)
    uuids = [r.uuid for r in t2.collect()]
    assert len(uuids) == len(set(uuids))                              # tracking keys stay unique


@FAST
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(["a.com", "b.com", "c.com"])), min_size=1, max_size=5))
def test_franchise_upsert_is_idempotent_for_non_null_keys(spark, src):
    tgt = spark.createDataFrame([("u1", "A", "a.com", TS, None)], "uuid string, franchise_name string, domain_name string, "
                                                                  "created_at timestamp_ntz, updated_at timestamp_ntz")
    s = spark.createDataFrame([(n, d, i) for i, (n, d) in enumerate(src)], "n string, d string, row_no int")
    once = fr.upsert_franchises(tgt, s, TS)
    twice = fr.upsert_franchises(once, s, TS)
    # a rerun inserts nothing and keeps every key; it only stamps updated_at on matched rows
    assert _rows(twice.drop("updated_at")) == _rows(once.drop("updated_at"))


@FAST
@given(keys, keys)
def test_not_in_equals_sql(spark, left, right):
    l_df = spark.createDataFrame([(v,) for v in left], "k int")
    r_df = spark.createDataFrame([(v,) for v in right], "v int")
    got = sorted((r.k for r in not_in(l_df, "k", r_df, "v").collect()), key=lambda x: (x is None, x))
    con = duckdb.connect()
    con.execute("CREATE TABLE l(k INTEGER)")
    con.execute("CREATE TABLE r(v INTEGER)")
    if left:
        con.executemany("INSERT INTO l VALUES (?)", [(v,) for v in left])
    if right:
        con.executemany("INSERT INTO r VALUES (?)", [(v,) for v in right])
    want = sorted((x[0] for x in con.execute("SELECT k FROM l WHERE k NOT IN (SELECT v FROM r)").fetchall()),
                  key=lambda x: (x is None, x))
    assert got == want
