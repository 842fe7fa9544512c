"""Imports every query module so that each registers its keys."""

from . import q_city, q_ingest, q_leads, q_listing, q_stream  # noqa: F401
