"""Data contracts: declared checks, one result row each, and the gate built on them."""

from tidemark.quality.checks import (
    Check,
    accepted_values,
    between,
    duplicate_groups,
    duplicate_keys,
    freshness,
    future_dates,
    not_after,
    not_null,
    orphan_keys,
    relationships,
    unique,
    unique_combination,
    violations,
)
from tidemark.quality.suite import ContractViolation, gate, run_suite, violating_samples

__all__ = [
    "Check",
    "ContractViolation",
    "accepted_values",
    "between",
    "duplicate_groups",
    "duplicate_keys",
    "freshness",
    "future_dates",
    "gate",
    "not_after",
    "not_null",
    "orphan_keys",
    "relationships",
    "run_suite",
    "unique",
    "unique_combination",
    "violating_samples",
    "violations",
]
