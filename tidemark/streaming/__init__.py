"""Structured Streaming forms of the five-minute feed and the daily pick-up.

Late data, by operator:

* ``write_bronze`` keeps every file that arrives, however late.
* ``upsert_stream`` keeps every row of every batch; ``IncrementalTable.load`` with its
  strict watermark misses rows at or before it unless ``lookback`` reaches them.
* ``drop_repeats`` and ``daily_close`` drop rows later than their watermark delay.
"""

from tidemark.streaming.bronze import stream_landing, write_bronze, write_rejected
from tidemark.streaming.close import daily_close
from tidemark.streaming.repeats import drop_repeats
from tidemark.streaming.upsert import upsert_stream

__all__ = ["daily_close", "drop_repeats", "stream_landing", "upsert_stream", "write_bronze", "write_rejected"]
