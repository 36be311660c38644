"""Input tables: explicit schemas, schema-conforming readers and the test fixture."""

from segmint.sources.readers import conform, read_rates_current, read_rates_legacy, read_transactions, read_users
from segmint.sources.schemas import RATES_CURRENT, RATES_LEGACY, TRANSACTIONS, USERS

__all__ = [
    "RATES_CURRENT",
    "RATES_LEGACY",
    "TRANSACTIONS",
    "USERS",
    "conform",
    "read_rates_current",
    "read_rates_legacy",
    "read_transactions",
    "read_users",
]
