"""Grouped measures and the narrow-to-wide pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_averages(
    df: DataFrame,
    day: str,
    averages: Mapping[str, str | Column],
    entity: str | None = None,
    entities_as: str = "entities_reported",
    approximate: bool = False,
) -> DataFrame:
    """Averages per day, and the number of distinct entities behind them.

    One distinct column beside plain averages plans as two exchanges, the first on
    (day, entity) after a partial aggregate, so even a day holding most rows is cut
    to one row per entity before the second. ``approximate`` trades the exact number for
    a sketch of fixed size and a single exchange.
    """
    measures = [F.avg(source).alias(name) for name, source in averages.items()]
    if entity is not None:
        count = F.approx_count_distinct(entity) if approximate else F.countDistinct(entity)
        measures.append(count.alias(entities_as))
    return df.groupBy(day).agg(*measures)


def pivot_max(
    df: DataFrame,
    keys: Sequence[str | Column],
    label: str,
    value: str,
    columns: Mapping[str, str],
) -> DataFrame:
    """One column per listed label holding ``max(value)``; ``columns`` maps label to output name.

    The labels are given, so there is no extra job to find them, and labels not
    listed are ignored. A label absent from a group gives NULL.
    """
    wide = [F.max(F.when(F.col(label) == F.lit(text), F.col(value))).alias(name) for text, name in columns.items()]
    return df.groupBy(*keys).agg(*wide)


def group_totals(df: DataFrame, keys: Sequence[str | Column], rows_as: str, sums: Mapping[str, str]) -> DataFrame:
    """Row count and sums per group; a group whose values are all NULL sums to 0."""
    totals = [F.coalesce(F.sum(source), F.lit(0)).cast("bigint").alias(name) for name, source in sums.items()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(rows_as), *totals)
