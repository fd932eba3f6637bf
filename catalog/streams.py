"""Streaming operators, each run to the end of its input and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.frames import CRYPTO_POLLS_SQL, OBJECTS_SQL, crypto_polls, events, out, shifted, write_objects
from tidemark import shared_path
from tidemark.operators import IncrementalTable
from tidemark.schemas import RAW_CRYPTO
from tidemark.sources import read_bronze, write_archive
from tidemark.streaming import daily_close, drop_repeats, stream_landing, upsert_stream, write_bronze


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a stream of the files it is written to."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def _collected(stream: DataFrame, name: str) -> DataFrame:
    """Everything the stream emits until its input ends."""
    spark = stream.sparkSession
    path = shared_path(spark, name)
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    query = writer.option("checkpointLocation", f"{path}__checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def stream_landing_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of polls, one query restarted from its checkpoint between them."""
    archive, bronze = shared_path(spark, "archive"), shared_path(spark, "raw_crypto")
    polls = crypto_polls(spark, sf_dir)
    first = polls.where(F.col("payload").contains("BTC"))
    for arrival in (first, polls.where(~F.col("payload").contains("BTC"))):
        write_archive(arrival, archive)
        write_bronze(stream_landing(spark, archive), "crypto", bronze, f"{bronze}__checkpoint", every=None).awaitTermination()
    rows = read_bronze(spark, bronze, RAW_CRYPTO).drop("object_key", "market_cap")
    return out(rows, ("price", "price_change_24h_pct"), ("captured_at",))


def stream_landing_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of files, one for each poll; the query is restarted from its checkpoint between them."""
    root, bronze = shared_path(spark, "objects"), shared_path(spark, "raw_crypto")
    for suppliers in (F.col("s_suppkey") % 3 == 0, F.col("s_suppkey") % 3 != 0):
        write_objects(spark, sf_dir, root, suppliers)
        landing = stream_landing(spark, root, packed=False)
        write_bronze(landing, "crypto", bronze, f"{bronze}__checkpoint", every=None, day_tasks=4).awaitTermination()
    return out(read_bronze(spark, bronze, RAW_CRYPTO).drop("market_cap"), ("price", "price_change_24h_pct"), ("captured_at",))


def stream_incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose keys are new, in two arrivals; each batch adds files of its own."""
    ticks = events(spark, sf_dir).select("event_id", "event_type", "ts", "value", "extracted_date")
    table = IncrementalTable(shared_path(spark, "ticks"), ("event_id", "event_type", "ts"), "ts")
    path = shared_path(spark, "arrivals")
    for arrival in (F.col("event_type") == "click", F.col("event_type") != "click"):
        ticks.where(arrival).write.mode("append").parquet(path)
        stream = spark.readStream.schema(ticks.schema).parquet(path)
        upsert_stream(stream, table, f"{table.path}__checkpoint", append=True).awaitTermination()
    return out(table.read(spark, ticks.schema).drop("extracted_date"), times=("ts",))


def stream_incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of placeholders for every second kind of event, then the stream of real values."""
    ticks = events(spark, sf_dir).select("event_id", "event_type", "ts", "value", "extracted_date")
    table = IncrementalTable(shared_path(spark, "ticks"), ("event_id", "event_type", "ts"), "ts")
    table.load(ticks.where(F.col("event_type").isin("click", "error")).withColumn("value", F.lit(-1.0)))
    stream = _written(ticks.where(F.col("event_type") != "error"), "arrivals")
    upsert_stream(stream, table, f"{table.path}__checkpoint").awaitTermination()
    return out(table.read(spark, ticks.schema).drop("extracted_date"), times=("ts",))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events were polled twice, a minute apart."""
    once = events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")
    again = once.where(F.col("event_type") == "error").withColumn("ts", shifted(F.col("ts"), F.lit(60_000_000)))
    stream = _written(once.unionByName(again), "polls")
    kept = drop_repeats(stream, ["event_id"], "ts", "1 day", salts=4)
    return _collected(kept, "kept").select("event_id", "user_id", "event_type")


def stream_daily_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _written(events(spark, sf_dir).select("event_id", "event_type", "ts", "value"), "ticks")
    return _collected(daily_close(stream, ["event_type"], "ts", "value", ["event_id"], "1 day"), "closes")


QUERIES = {
    "stream_landing_append": stream_landing_append,
    "stream_landing_objects": stream_landing_objects,
    "stream_incremental_append": stream_incremental_append,
    "stream_incremental_upsert": stream_incremental_upsert,
    "stream_dedup": stream_dedup,
    "stream_daily_close": stream_daily_close,
}

ORACLES = {
    "stream_landing_append": f"select * from ({CRYPTO_POLLS_SQL}) r",
    "stream_incremental_upsert": """
select event_id, event_type, ts, case when event_type = 'error' then cast(-1 as double) else value end as value from events
""",
    "stream_dedup": "select event_id, user_id, event_type from events",
    "stream_daily_close": """
select d as extracted_date, event_type, value as close_value from (
  select cast(ts as date) as d, event_type, value,
         row_number() over (partition by cast(ts as date), event_type order by ts desc, event_id desc) as rn
  from events) c
where rn = 1 and cast(d + 1 as timestamp) <= (select max(ts) - interval 1 day from events)
""",
}
ORACLES["stream_landing_objects"] = OBJECTS_SQL
ORACLES["stream_incremental_append"] = "select event_id, event_type, ts, value from events"
