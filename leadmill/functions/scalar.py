"""Column expressions for the reference's scalar functions (X-1 ... X-18).

All are built-in Spark expressions, so they stay inside whole-stage codegen; none is a UDF.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's):
# enum values of tracking.status
STATUS_VALUES = ("posted", "emailed", "shopify_customer", "duplicate_entry")
# enum values of drive_metadata.file_type (the later 'city_search_enriched' migration adds nothing)
FILE_TYPE_VALUES = ("city_search", "zi_search")
# folder-name mapping intended by the reference: 'data drop' means a lead-vendor drop
FILE_TYPE_ALIASES = {"data_drop": "zi_search"}
# host pattern of the domain key
URL_HOST_PATTERN = r"https?://([^/]*)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_host(url) -> Column:
    """X-3: ``substring(url from 'https?://([^/]*)')`` — the captured host, NULL when no match.

    ``regexp_extract`` returns '' on no match, so the match test comes first.
    """
    u = _c(url)
    return F.when(u.rlike(URL_HOST_PATTERN), F.regexp_extract(u, URL_HOST_PATTERN, 1))


def domain_key(url) -> Column:
    """X-3 + X-1 + X-4: ``replace(coalesce(host(url), url), 'www.', '')``.

    Case and port are kept; every 'www.' is removed; NULL stays NULL; '' stays ''.
    """
    u = _c(url)
    return F.replace(F.coalesce(url_host(u), u), F.lit("www."), F.lit(""))


def parent_from_text(parents) -> Column:
    """X-5: ``replace(trim(both '[]' from parents), '''', '')`` — text list "['id']" to the id."""
    return F.replace(F.btrim(_c(parents), F.lit("[]")), F.lit("'"), F.lit(""))


def file_type_from_folder(name, apply_alias: bool = True) -> Column:
    """X-6: strip, lower, spaces to '_' (reference order); then the intended alias map.

    With ``apply_alias=False`` the reference's no-op map is reproduced (its map runs on
    'data drop' after spaces became '_', so it never fires).
    """
    v = F.replace(F.lower(F.trim(_c(name))), F.lit(" "), F.lit("_"))
    if apply_alias:
        for src, dst in FILE_TYPE_ALIASES.items():
            v = F.when(v == src, F.lit(dst)).otherwise(v)
    return v


def landing_folder(name) -> Column:
    """X-7: replace ' ' by '_', then lower, then strip — in this order."""
    return F.trim(F.lower(F.replace(_c(name), F.lit(" "), F.lit("_"))))


def text_escape(c) -> Column:
    """X-8 + X-17: ``'="' + fillna('') + '"'`` so sheets keep phone numbers as text."""
    return F.concat(F.lit('="'), F.coalesce(_c(c), F.lit("")), F.lit('"'))


def sheet_name(name, suffix: str) -> Column:
    """X-9: first 30 characters + suffix."""
    return F.concat(F.substring(_c(name), 1, 30), F.lit(suffix))


def xlsx_to_csv(name) -> Column:
    """X-10 / D-3: every 'xlsx' in the name becomes 'csv'."""
    return F.replace(_c(name), F.lit("xlsx"), F.lit("csv"))


def last_path_segment(path) -> Column:
    """X-11: last '/'-separated segment."""
    return F.element_at(F.split(_c(path), "/"), -1)


def strip_container(path, container: str) -> Column:
    """X-11: remove the container prefix."""
    return F.replace(_c(path), F.lit(f"{container}/"), F.lit(""))


def week_label(d) -> Column:
    """X-12: 'Week <ISO week number>'."""
    return F.concat(F.lit("Week "), F.weekofyear(_c(d)).cast("string"))


def ntz(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (wall-clock, independent of the session time zone)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def day_floor_minus(now: dt.datetime, days: int) -> Column:
    """X-13: today − n days at 00:00:00 (day mode of the listing); ``now`` is a parameter."""
    return ntz(dt.datetime(now.year, now.month, now.day) - dt.timedelta(days=days))


def seconds_before(now: dt.datetime, seconds: int) -> Column:
    """X-13: now − n seconds (sensor mode of the listing)."""
    return ntz(now - dt.timedelta(seconds=seconds))


def det_uuid(*parts) -> Column:
    """X-14: deterministic uuid text from md5 over the parts, each with its length before it (``3:abc``); a
    NULL part is ``n``. So no value can be taken for a separator, and NULL differs from ''."""
    coded = []
    for p in parts:
        s = _c(p).cast("string")
        coded.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("n")))
    h = F.md5(F.concat(*coded))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def in_enum(c, values) -> Column:
    return _c(c).isin(*values)
