"""Guard against polls that were captured twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"


def drop_repeats(stream: DataFrame, keys: Sequence[str], captured_at: str, delay: str, salts: int = 8) -> DataFrame:
    """The first row per key; repeats whose times are within ``delay`` of each other are dropped.

    State is kept only until the watermark passes, so it does not grow with the stream.
    ``captured_at`` must be TIMESTAMP.

    Streaming deduplication has no map-side step, so a key repeated in a third of the
    rows would send them all to one task. The rows of a key are therefore first spread
    over ``salts`` buckets and deduplicated there, then once more by key alone, which
    sees at most ``salts`` rows per key. That costs a second state of the same size;
    pass 0 where no key can be heavy.
    """
    marked = stream.withWatermark(captured_at, delay)
    if salts > 1:
        # The input partition is stable when a task is rerun, and any bucket gives the same result.
        spread = marked.withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(salts)))
        marked = spread.dropDuplicatesWithinWatermark([*keys, _SALT]).drop(_SALT)
    return marked.dropDuplicatesWithinWatermark(list(keys))
