"""Stored table schemas (final state of the reference's migrations) as Spark types.

Fixed values (must equal the reference's): table and column names, in table order.
"""

from __future__ import annotations

from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampNTZType

LEADS_DATA_COLUMNS = [
    "zoominfo_contact_id", "last_name", "first_name", "middle_name", "salutation", "suffix", "job_title",
    "job_function", "management_level", "company_division_name", "direct_phone_number", "email_address",
    "email_domain", "department", "mobile_phone", "contact_accuracy_score", "contact_accuracy_grade",
    "zoominfo_contact_profile_url", "linkedin_contact_profile_url", "notice_provided_date", "person_street",
    "person_city", "person_state", "person_zip_code", "country", "zoominfo_company_id", "company_name", "website",
    "founded_year", "company_hq_phone", "fax", "ticker", "revenue_in_000s_usd", "revenue_range_in_usd", "employees",
    "employee_range", "sic_code_1", "sic_code_2", "sic_codes", "naics_code_1", "naics_code_2", "naics_codes",
    "primary_industry", "primary_sub_industry", "all_industries", "all_sub_industries",
    "industry_hierarchical_category", "secondary_industry_hierarchical_category", "alexa_rank",
    "zoominfo_company_profile_url", "linkedin_company_profile_url", "facebook_company_profile_url",
    "twitter_company_profile_url", "ownership_type", "business_model", "certified_active_company",
    "certification_date", "total_funding_amount_in_000s_usd", "recent_funding_amount_in_000s_usd",
    "recent_funding_round", "recent_funding_date", "recent_investors", "all_investors", "company_street_address",
    "company_city", "company_state", "company_zip_code", "company_country", "full_address", "number_of_locations",
    "query_name",
]
# table order: uuid, drive_metadata_uuid, the data columns, created_at
LEADS_COLUMNS = ["uuid", "drive_metadata_uuid", *LEADS_DATA_COLUMNS, "created_at"]

CITY_SEARCH_DATA_COLUMNS = [
    "type", "phone", "title", "dataid", "rating", "placeid", "reviews", "website", "position", "thumbnail",
    "address", "keyword_ll", "keyword_keyword", "gpscoordinates_latitude", "gpscoordinates_longitude",
    "serviceoptions_0", "emails_0", "serviceoptions_1", "emails_1", "emails_2", "serviceoptions_2", "emails_3",
    "serviceoptions_3", "serviceoptions_4",
]
CITY_SEARCH_COLUMNS = ["uuid", "drive_metadata_uuid", *CITY_SEARCH_DATA_COLUMNS, "created_at", "updated_at"]

ENRICHED_DATA_COLUMNS = ["first_name", "last_name", "main_point_of_contact_email", "main_contact_linkedin",
                         "generic_contact_email", "company_name", "website", "phone"]
ENRICHED_COLUMNS = ["uuid", "drive_metadata_uuid", *ENRICHED_DATA_COLUMNS, "created_at"]

DRIVE_METADATA_COLUMNS = [
    "uuid", "fileextension", "parents", "owners", "id", "name", "createdtime", "modifiedtime",
    "lastmodifyinguser_displayname", "lastmodifyinguser_kind", "lastmodifyinguser_me",
    "lastmodifyinguser_permissionid", "lastmodifyinguser_emailaddress", "lastmodifyinguser_photolink",
    "created_at", "config_file_uuid", "hubspot_owner", "zi_search", "updated_at", "has_posted_on_slack",
    "file_type", "has_been_processed",
]

TRACKING_COLUMNS = ["uuid", "lead_uuid", "status", "email_address", "created_at", "city_search_lead_uuid"]

FRANCHISE_COLUMNS = ["uuid", "franchise_name", "domain_name", "created_at", "updated_at"]

# the catalog columns that are NULL when a file is first listed
CATALOG_NULL_ON_INSERT = ["config_file_uuid", "hubspot_owner", "zi_search", "has_posted_on_slack",
                          "file_type", "has_been_processed"]

_TIMESTAMPS = {"created_at", "updated_at"}
_BOOLEANS = {"has_posted_on_slack", "has_been_processed"}


def struct_of(columns: list[str]) -> StructType:
    """All-text schema with timestamp/boolean columns typed as in the migrations."""
    def t(c):
        if c in _TIMESTAMPS:
            return TimestampNTZType()
        if c in _BOOLEANS:
            return BooleanType()
        return StringType()
    return StructType([StructField(c, t(c), True) for c in columns])


TABLES = {
    "leads": LEADS_COLUMNS,
    "city_search": CITY_SEARCH_COLUMNS,
    "city_search_enriched": ENRICHED_COLUMNS,
    "drive_metadata": DRIVE_METADATA_COLUMNS,
    "tracking": TRACKING_COLUMNS,
    "city_search_franchises": FRANCHISE_COLUMNS,
}


def insert_columns(table: str) -> list[str]:
    """S-13: the table's columns except ``uuid`` and ``updated_at`` (the append target)."""
    return [c for c in TABLES[table] if c not in ("uuid", "updated_at")]
