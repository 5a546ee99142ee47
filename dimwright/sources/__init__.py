"""Readers for the driver tables and the source views derived from them."""

from dimwright.sources.tables import TABLES, read_table
from dimwright.sources.listing import country_lookup, listings_raw
from dimwright.sources.oltp import Oltp

__all__ = ["TABLES", "read_table", "country_lookup", "listings_raw", "Oltp"]
