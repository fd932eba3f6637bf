"""Column expressions used across the layers."""

from tidemark.functions.keys import archive_key, key_captured_at, key_source
from tidemark.functions.text import config_fallback, strict_cast, strip_suffix
from tidemark.functions.time import MONTH, duration_seconds, every_nth, month_of, parse_utc, utc_date

__all__ = [
    "MONTH",
    "archive_key",
    "config_fallback",
    "duration_seconds",
    "key_captured_at",
    "key_source",
    "every_nth",
    "month_of",
    "parse_utc",
    "strict_cast",
    "strip_suffix",
    "utc_date",
]
