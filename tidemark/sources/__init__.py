"""Readers, parsers and writers of the raw and bronze layers, and the source registry."""

from tidemark.sources.bronze import append_bronze, read_bronze
from tidemark.sources.landing import read_archive, read_landing, write_archive
from tidemark.sources.payloads import PARSERS, Parsed, parse_crypto, parse_fx, parse_weather, stamp
from tidemark.sources.registry import (
    active_sources,
    apply_defaults,
    config_list,
    default_sources,
    register_sources,
    route,
)
from tidemark.sources.tables import database_name, materialize

__all__ = [
    "PARSERS",
    "Parsed",
    "active_sources",
    "append_bronze",
    "apply_defaults",
    "config_list",
    "database_name",
    "default_sources",
    "materialize",
    "parse_crypto",
    "parse_fx",
    "parse_weather",
    "read_archive",
    "read_bronze",
    "read_landing",
    "register_sources",
    "route",
    "stamp",
    "write_archive",
]
