"""Bronze arrivals to the incremental table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.incremental import IncrementalTable


def upsert_stream(
    stream: DataFrame, table: IncrementalTable, checkpoint: str, every: str | None = None, append: bool = False
) -> StreamingQuery:
    """Replace by key and insert each micro-batch; ``every=None`` is the daily pick-up of what has arrived.

    A batch replayed after a failure finds its own rows by key and replaces them, so it
    counts once. Each batch rewrites the days it touches: prefer few large batches. With
    ``append``, for streams whose keys are never stored yet, a batch adds files of its own
    and rewrites none; a batch replayed after a failure is known by its number.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        table.append(batch, f"{checkpoint}#{batch_id}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Several passes read the batch; without this each pass would read the source again.
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            table.upsert(batch)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(add if append else apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()
