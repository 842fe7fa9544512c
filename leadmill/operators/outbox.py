"""K-8 / A-6: notification texts as rows of an outbox DataFrame (sending is not built)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the reference's): message templates, line by line.
MISSING_CONFIG_LINES = [
    "Missing Config File: %s",
    "Created At: %s",
    "Last Modified By: %s",
    "file_type: %s",
    "Please update this file so an output file can be created.",
]
METRICS_LINES = [
    "%s:",
    "Number of Leads: %s",
    "Number of Shopify Customers: %s",
]
SPREADSHEET_LINE = "Spreadsheet: <%s|%s>"
SHEET_READY = "Hi <@%s>, <%s|City Search - %s is ready to be dispersed.>"


def _text(c):
    """Python ``str()`` form of a value inside an f-string: NULL prints as 'None'."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def missing_config_messages(missing: DataFrame, link: str = "") -> DataFrame:
    """One message per missing-config row (F-1 output)."""
    lines = "\n" + "\n".join(MISSING_CONFIG_LINES + ([link] if link else [])) + "\n"
    ts = F.date_format(F.col("created_at"), "yyyy-MM-dd HH:mm:ss")
    return missing.select("uuid", F.format_string(lines, _text(F.col("name")), _text(ts),
                                                  _text(F.col("lastmodifyinguser_displayname")),
                                                  _text(F.col("file_type"))).alias("text"))


def metrics_messages(metrics: DataFrame, sheet_name: Column | None = None, sheet_url: Column | None = None,
                     by_file: bool = True) -> DataFrame:
    """A-6 + K-8: the first metrics row per name (by ``created_at``, NULL names dropped, as
    pandas ``groupby`` does). ``by_file=True`` groups by file uuid too, so two files with one
    name get two messages (Q10). ``sheet_name`` and ``sheet_url`` (over ``name``) add the spreadsheet's line."""
    keys = ["name", "drive_metadata_uuid"] if by_file else ["name"]
    first = metrics.where(F.col("name").isNotNull()).groupBy(*keys).agg(
        F.min_by(F.struct("number_of_posted_leads", "number_of_shopify_customers"), F.col("created_at")).alias("_m"))
    body = F.format_string("\n" + "\n".join(METRICS_LINES) + "\n", F.col("name"), _text(F.col("_m.number_of_posted_leads")),
                           _text(F.col("_m.number_of_shopify_customers")))
    if sheet_name is not None:
        body = F.concat(body, F.format_string("\n" + SPREADSHEET_LINE, sheet_url, sheet_name))
    return first.select(*keys, body.alias("text"))


def sheet_ready_messages(sheets: DataFrame, owner: str, link_col: str = "link", name_col: str = "sheet_name") -> DataFrame:
    """City-search notice: one message per written spreadsheet."""
    return sheets.select("*", F.format_string(SHEET_READY, F.lit(owner), F.col(link_col), F.col(name_col)).alias("text"))
