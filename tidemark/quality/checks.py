"""Checks as data, and operators that list violations.

A row check is a condition that is TRUE on a violating row; NULL is not a violation
unless the check says so. A suite reads each model once, and all its checks share one
shuffle of pre-aggregated keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW, UNIQUE, RELATIONSHIP = "row", "unique", "relationship"


@dataclass(frozen=True)
class Check:
    """One declared check of a model."""

    name: str
    model: str
    columns: tuple[str, ...]
    kind: str
    violates: Column | None = field(default=None, compare=False)
    ignore_nulls: bool = False
    to_model: str | None = None
    to_column: str | None = None
    #: Name under which checks of several models count as one.
    reported_as: str | None = None

    @property
    def column(self) -> str:
        return ", ".join(self.columns)


def not_null(model: str, column: str) -> Check:
    """Fails on NULL."""
    return Check("not_null", model, (column,), ROW, F.col(column).isNull())


def accepted_values(model: str, column: str, values: Sequence) -> Check:
    """Fails on a value outside the list; NULL passes."""
    return Check("accepted_values", model, (column,), ROW, ~F.col(column).isin(*values))


def between(
    model: str,
    column: str,
    minimum=None,
    maximum=None,
    strictly: bool = False,
    row_condition: Column | None = None,
    reject_nan: bool = False,
) -> Check:
    """Fails outside the bounds; NULL passes, and so do rows outside ``row_condition``.

    Spark orders NaN above every number, so NaN passes a lower bound; ``reject_nan`` fails it.
    """
    value = F.col(column)
    inside = F.lit(True)
    if minimum is not None:
        inside = inside & (value > minimum if strictly else value >= minimum)
    if maximum is not None:
        inside = inside & (value < maximum if strictly else value <= maximum)
    outside = ~inside
    if reject_nan:
        outside = outside | F.isnan(value)
    if row_condition is not None:
        outside = row_condition & outside
    return Check("between", model, (column,), ROW, outside)


def not_after(model: str, column: str, day: dt.date, reported_as: str | None = None) -> Check:
    """Fails on a later day; NULL passes."""
    return Check("no_future_dates", model, (column,), ROW, F.col(column) > F.lit(day), reported_as=reported_as)


def unique(model: str, column: str) -> Check:
    """Fails on repeated values; NULLs are ignored."""
    return Check("unique", model, (column,), UNIQUE, ignore_nulls=True)


def unique_combination(model: str, columns: Sequence[str]) -> Check:
    """Fails on repeated tuples; tuples holding NULL are compared like any other."""
    return Check("unique_combination", model, tuple(columns), UNIQUE)


def relationships(model: str, column: str, to_model: str, to_column: str) -> Check:
    """Fails on a non-NULL value missing from the parent column."""
    return Check("relationships", model, (column,), RELATIONSHIP, to_model=to_model, to_column=to_column)


def violations(df: DataFrame, check: Check) -> DataFrame:
    """The violating rows of a row check."""
    return df.where(F.coalesce(check.violates, F.lit(False)))


def duplicate_groups(df: DataFrame, keys: Sequence[str], ignore_nulls: bool = False, count_as: str = "n_records") -> DataFrame:
    """Key tuples found more than once, with their row count."""
    rows = df
    if ignore_nulls:
        for key in keys:
            rows = rows.where(F.col(key).isNotNull())
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).where(F.col(count_as) > 1)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Values of one column found more than once; NULLs are ignored."""
    return duplicate_groups(df, [key], ignore_nulls=True)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, to_column: str, count_as: str = "n_records") -> DataFrame:
    """Non-NULL child keys missing from the parent, with the number of child rows behind each.

    Child rows are counted per key before the join, so a key holding a third of the
    child reaches the join as one row. No broadcast hint: Spark decides by size.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count_as))
    known = parent.select(F.col(to_column).alias(column)).distinct()
    return keys.join(known, column, "left_anti")


def future_dates(models: Mapping[str, tuple[DataFrame, str]], as_of: dt.date, day_as: str = "extracted_date") -> DataFrame:
    """Rows of any model dated after ``as_of``, labelled with the model."""
    found = None
    for name, (df, day) in models.items():
        late = df.where(F.col(day) > F.lit(as_of)).select(F.lit(name).alias("source_table"), F.col(day).alias(day_as))
        found = late if found is None else found.unionAll(late)
    return found


def freshness(
    df: DataFrame,
    name: str,
    captured_at: str,
    as_of: dt.datetime,
    warn_after: dt.timedelta | None,
    error_after: dt.timedelta | None,
) -> DataFrame:
    """One row: newest capture and 'pass', 'warn' or 'error'. A source without rows is an error."""
    newest = df.agg(F.max(captured_at).alias("max_loaded_at"))
    as_of_time = F.lit(as_of).cast("timestamp")
    age = F.unix_micros(as_of_time) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))
    status = F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
    if error_after is not None:
        status = status.when(age > F.lit(error_after // dt.timedelta(microseconds=1)), F.lit("error"))
    if warn_after is not None:
        status = status.when(age > F.lit(warn_after // dt.timedelta(microseconds=1)), F.lit("warn"))
    return newest.select(F.lit(name).alias("source_table"), "max_loaded_at", status.otherwise(F.lit("pass")).alias("status"))
