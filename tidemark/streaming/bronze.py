"""Landing files to bronze, exactly once.

The parquet file sink commits a batch through its own log, so a restart from the
checkpoint neither repeats nor loses rows. Run one query per checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.sources.landing import ARCHIVE, from_objects
from tidemark.sources.registry import route

# Fixed value: the poll interval of the feed.
POLL_INTERVAL = "5 minutes"


def stream_landing(spark: SparkSession, root: str, packed: bool = True, max_files: int | None = None) -> DataFrame:
    """Polls as they arrive below ``root``; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if packed:
        return reader.schema(ARCHIVE).parquet(root)
    # wholetext must be an argument: as an option of readStream.text it is ignored.
    return from_objects(reader.option("recursiveFileLookup", "true").text(root, wholetext=True))


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``every`` keeps the query running at that interval; None takes what is there and stops."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def write_bronze(
    landing: DataFrame,
    source_name: str,
    path: str,
    checkpoint: str,
    config: dict | None = None,
    every: str | None = POLL_INTERVAL,
    mode: str = "raise",
    day_tasks: int | None = None,
) -> StreamingQuery:
    """Parse one source's polls and append them to its bronze table.

    The first rejected poll stops the query. With ``mode='quarantine'`` rejected polls are
    left out here, as a whole: start ``write_rejected`` beside it, or they are lost.

    The packed archive holds a day in each file, so its rows are written as they are read.
    Files of single polls are read in any order, and every task would write a file for
    nearly each of its polls: pass ``day_tasks``, the tasks that share the rows a
    batch has of one day.
    """
    rows = route(landing, source_name, config, mode).rows
    if day_tasks is not None:
        # By day and hash: a heavy day is shared by several tasks, and the others still make few files.
        rows = rows.repartition(F.col("extracted_date"), F.pmod(F.xxhash64("object_key"), F.lit(day_tasks)))
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy("extracted_date")
    return _triggered(writer.option("path", path).option("checkpointLocation", checkpoint), every).start()


def write_rejected(
    landing: DataFrame,
    source_name: str,
    path: str,
    checkpoint: str,
    config: dict | None = None,
    every: str | None = POLL_INTERVAL,
) -> StreamingQuery:
    """Append one source's rejected polls, payload and reason, to a table of their own."""
    rejected = route(landing, source_name, config, "quarantine").rejected
    writer = rejected.select("*", F.current_timestamp().alias("rejected_at")).writeStream.format("parquet").outputMode("append")
    return _triggered(writer.option("path", path).option("checkpointLocation", checkpoint), every).start()
