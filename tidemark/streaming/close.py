"""Closing value per entity and day, as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import utc_date


def daily_close(
    stream: DataFrame,
    entity: Sequence[str],
    captured_at: str,
    value: str,
    tie_breakers: Sequence[str],
    delay: str,
    day_as: str = "extracted_date",
    close_as: str = "close_value",
) -> DataFrame:
    """Last ``value`` per entity and UTC day, emitted once the watermark has passed the day.

    Row numbers are not defined on a stream; the greatest (time, tie, value) is, and it
    is combined on the map side, so a heavy entity sends one row per task.
    """
    newest = F.max(F.struct(captured_at, *tie_breakers, F.col(value).alias("__value"))).alias("newest")
    days = stream.withWatermark(captured_at, delay).groupBy(F.window(captured_at, "1 day"), *entity).agg(newest)
    return days.select(
        utc_date(F.col("window.start")).alias(day_as), *entity, F.col("newest.__value").alias(close_as)
    )
