"""Newest row per group: daily state of an entity, closing value, last attempt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def latest_per_group(
    df: DataFrame,
    keys: Sequence[str | Column],
    newest_by: str | Column,
    tie_breakers: Sequence[str | Column],
    nulls_first: bool = True,
) -> DataFrame:
    """The whole row with the greatest ``newest_by`` in each group of ``keys``.

    ``tie_breakers`` decide between equal times, greatest first, and are required:
    without them two runs could keep different rows. A NULL time counts as newest
    by default, as a descending sort does in the warehouse this replaces.

    ``row_number() = 1`` over the window lets Spark put a WindowGroupLimit before the
    exchange, so a map task sends at most one row per group. A group holding a third
    of the table therefore reaches its reducer as one row per map task.
    """
    if not tie_breakers:
        raise ValueError("latest_per_group needs tie_breakers, or equal times give unstable results")
    column = newest_by if isinstance(newest_by, Column) else F.col(newest_by)
    order = column.desc_nulls_first() if nulls_first else column.desc_nulls_last()
    ties = [(c if isinstance(c, Column) else F.col(c)).desc_nulls_last() for c in tie_breakers]
    window = Window.partitionBy(*keys).orderBy(order, *ties)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_per_day(
    df: DataFrame,
    entity: Sequence[str],
    day: str,
    captured_at: str,
    tie_breakers: Sequence[str | Column],
) -> DataFrame:
    """One row per entity and day: the last capture. The ``DISTINCT ON`` closing value is the same thing."""
    return latest_per_group(df, [day, *entity], captured_at, tie_breakers)
