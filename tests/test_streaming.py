from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import shared_path
from tidemark.operators import IncrementalTable, latest_per_day
from tidemark.schemas import RAW_CRYPTO, RAW_FX
from tidemark.sources import parse_fx, read_archive, read_bronze, write_archive
from tidemark.streaming import daily_close, drop_repeats, stream_landing, upsert_stream, write_bronze, write_rejected

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def polls(spark, source, payloads, first_minute=0):
    rows = [(source, START + dt.timedelta(minutes=first_minute + n), json.dumps(p)) for n, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "source_name string, captured_at timestamp, payload string")


def fx(*numbers):
    return [{"rates": {"GBP": n}} for n in numbers]


def finish(query):
    query.awaitTermination()


def test_stream_equals_batch_and_survives_restarts(spark):
    archive, bronze = shared_path(spark, "archive"), shared_path(spark, "bronze")
    for first in (0, 40, 80):
        write_archive(polls(spark, "fx", fx(*range(first, first + 40)), first), archive)
        stream = stream_landing(spark, archive, max_files=1)
        finish(write_bronze(stream, "fx", bronze, f"{bronze}__checkpoint", every=None))
        # Nothing new has arrived: a restart adds nothing.
        finish(write_bronze(stream_landing(spark, archive), "fx", bronze, f"{bronze}__checkpoint", every=None))
    streamed = read_bronze(spark, bronze, RAW_FX)
    batch = parse_fx(read_archive(spark, archive)).rows
    assert streamed.count() == 120
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_rejected_polls_leave_the_stream_whole(spark):
    archive, bronze, rejected = (shared_path(spark, n) for n in ("archive", "bronze", "rejected"))
    write_archive(polls(spark, "fx", [*fx(1, 2), "oops"]), archive)
    with pytest.raises(Exception, match="poll rejected"):
        finish(write_bronze(stream_landing(spark, archive), "fx", f"{bronze}-strict", f"{bronze}-strict__checkpoint", every=None))
    finish(write_bronze(stream_landing(spark, archive), "fx", bronze, f"{bronze}__checkpoint", every=None, mode="quarantine"))
    finish(write_rejected(stream_landing(spark, archive), "fx", rejected, f"{rejected}__checkpoint", every=None))
    assert read_bronze(spark, bronze, RAW_FX).count() == 2
    assert [r["reason"] for r in spark.read.parquet(rejected).collect()] == ["not a rates object"]


def test_objects_are_streamed_whole(spark, tmp_path):
    folder = tmp_path / "landing" / "crypto"
    folder.mkdir(parents=True)
    ticker = [{"symbol": "BTCUSDT", "lastPrice": "1", "priceChangePercent": "2"}]
    (folder / "20240101T000000000001Z.json").write_text(json.dumps(ticker, indent=4))
    bronze = shared_path(spark, "bronze")
    stream = stream_landing(spark, str(tmp_path / "landing"), packed=False)
    finish(write_bronze(stream, "crypto", bronze, f"{bronze}__checkpoint", every=None))
    row = read_bronze(spark, bronze, RAW_CRYPTO).first()
    assert (row["coin_id"], row["object_key"]) == ("BTC", "crypto/20240101T000000000001Z.json")


def test_days_of_streamed_objects_are_written_by_few_tasks(spark, tmp_path):
    folder = tmp_path / "landing" / "crypto"
    folder.mkdir(parents=True)
    for minute in range(60):
        poll = [{"symbol": "BTCUSDT", "lastPrice": str(minute + 1), "priceChangePercent": "0"}]
        (folder / f"202401{minute % 3 + 1:02d}T00{minute:02d}00000000Z.json").write_text(json.dumps(poll))
    bronze = shared_path(spark, "bronze")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a file a task
    try:
        stream = stream_landing(spark, str(tmp_path / "landing"), packed=False)
        finish(write_bronze(stream, "crypto", bronze, f"{bronze}__checkpoint", every=None, day_tasks=2))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = read_bronze(spark, bronze, RAW_CRYPTO)
    assert sorted(int(r["price"]) for r in rows.collect()) == list(range(1, 61))
    assert 3 <= len(list(Path(bronze.removeprefix("file:")).glob("*/*.parquet"))) <= 6


def ticks(spark, data):
    """(id, coin, hour, value) rows with their capture time and day."""
    data = [(n, coin, float(hour), value) for n, coin, hour, value in data]
    df = spark.createDataFrame(data, "id int, coin string, hour double, value double")
    at = F.timestamp_micros((F.col("hour") * 3_600_000_000).cast("bigint") + F.lit(int(START.timestamp()) * 1_000_000))
    return df.select("id", "coin", at.alias("captured_at"), "value", F.to_date(at).alias("extracted_date"))


class Feed:
    """A folder that a stream reads, fed batch by batch."""

    def __init__(self, spark, name):
        self.spark, self.path, self.schema = spark, shared_path(spark, name), None

    def add(self, df):
        self.schema = df.schema
        df.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)

    def run(self, transform, out):
        writer = transform(self.stream()).writeStream.format("parquet").option("path", out)
        finish(writer.option("checkpointLocation", f"{out}__checkpoint").trigger(availableNow=True).start())


def test_upsert_replays_count_once(spark, monkeypatch):
    feed = Feed(spark, "feed")
    table = IncrementalTable(shared_path(spark, "ticks"), ("coin", "captured_at"), "captured_at")
    feed.add(ticks(spark, [(1, "BTC", 1, 1.0), (2, "BTC", 30, 2.0)]))
    finish(upsert_stream(feed.stream(), table, f"{table.path}__checkpoint"))
    feed.add(ticks(spark, [(3, "BTC", 30, 3.0), (4, "ETH", 2, 4.0)]))

    whole = IncrementalTable._swap

    def lost_after_the_swap(self, *args):
        whole(self, *args)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(IncrementalTable, "_swap", lost_after_the_swap)
        with pytest.raises(Exception, match="driver lost"):
            finish(upsert_stream(feed.stream(), table, f"{table.path}__checkpoint"))
    finish(upsert_stream(feed.stream(), table, f"{table.path}__checkpoint"))
    stored = table.read(spark, feed.schema)
    assert sorted((r["coin"], r["id"]) for r in stored.collect()) == [("BTC", 1), ("BTC", 3), ("ETH", 4)]


@pytest.mark.parametrize("salts", [0, 4])
def test_repeats_are_dropped_across_batches(spark, salts):
    feed, out = Feed(spark, "feed"), shared_path(spark, "kept")

    def once(s):
        return drop_repeats(s, ["id"], "captured_at", "2 days", salts)

    feed.add(ticks(spark, [(1, "BTC", 1, 1.0), (1, "BTC", 1.5, 1.0), (2, "BTC", 2, 1.0)]))
    feed.run(once, out)
    feed.add(ticks(spark, [(1, "BTC", 3, 1.0), (3, "BTC", 4, 1.0)]))
    feed.run(once, out)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_salted_repeats_of_a_hot_key(spark):
    feed, out = Feed(spark, "feed"), shared_path(spark, "kept")
    rows = [(0 if n % 3 == 0 else n, "BTC", n / 1000, 1.0) for n in range(900)]
    feed.schema = ticks(spark, rows[:1]).schema
    ticks(spark, rows).repartition(6).write.parquet(feed.path)
    feed.run(lambda s: drop_repeats(s, ["id"], "captured_at", "2 days", salts=4), out)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, *(n for n in range(900) if n % 3)]


def test_daily_close_emits_closed_days_once(spark):
    feed, out = Feed(spark, "feed"), shared_path(spark, "closes")
    first = [(1, "BTC", 1, 10.0), (2, "BTC", 23, 11.0), (3, "BTC", 23, 12.0), (4, "ETH", 5, None), (5, "BTC", 25, 20.0)]
    late_then_next = [(6, "BTC", 23.5, 13.0), (7, "BTC", 60, 30.0), (8, "BTC", 80, 40.0)]

    def close(s):
        return daily_close(s, ["coin"], "captured_at", "value", ["id"], "12 hours")

    for batch in (first, late_then_next):
        feed.add(ticks(spark, batch))
        feed.run(close, out)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    expected = latest_per_day(ticks(spark, first + late_then_next), ["coin"], "extracted_date", "captured_at", ["id"])
    closed = expected.where(F.col("extracted_date") < F.lit(dt.date(2024, 1, 3))).select("extracted_date", "coin", "value")
    assert got == sorted(tuple(r) for r in closed.collect())
    assert got[0] == (dt.date(2024, 1, 1), "BTC", 13.0)
