"""The test tables, in the roles the operators expect.

``events`` are price ticks, ``lineitem`` city readings and ``orders`` currency rates.
Every frame uses its whole table. Events are moved back 9,131 days so that all
three fall on common days.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import archive_key, utc_date
from tidemark.schemas import AMOUNT, COORDINATE

SHIFT_DAYS = 9131
MICROS_PER_DAY = 86_400_000_000
#: 2024-01-01, from when on polls of suppliers are captured, one a minute.
OBJECT_MICROS = 1_704_067_200_000_000
#: Tasks a core that write the files of polls.
OBJECT_TASKS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant(column: str) -> Column:
    """A zone-less test timestamp as the UTC instant it stands for."""
    return F.col(column).cast("timestamp")


def shifted(timestamp: Column, micros: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(timestamp) + micros)


def out(df: DataFrame, doubles: tuple[str, ...] = (), times: tuple[str, ...] = ()) -> DataFrame:
    """Amounts as double and instants without zone, as the SQL side has them."""
    casts = {c: F.col(c).cast("double") for c in doubles} | {c: F.col(c).cast("timestamp_ntz") for c in times}
    return df.withColumns(casts) if casts else df


def average(column: str) -> Column:
    """A decimal average rounded half up to six places, as double."""
    return F.round(column, 6).cast("double")


def average_sql(column: str) -> str:
    """The same in whole millionths, since a quotient of doubles rounds differently. Needs two-decimal, non-negative input."""
    hundredths = f"sum(cast(round({column} * 100) as bigint))"
    return f"cast((2 * {hundredths} * 10000 + count({column})) // (2 * count({column})) as double) / cast(1000000 as double)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant and the UTC day as ``extracted_date``."""
    df = table(spark, sf_dir, "events").withColumn("ts", instant("ts"))
    return df.withColumn("extracted_date", utc_date(F.col("ts")))


def raw_crypto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks: three listed coins, two unlisted; errors are quoted in another currency."""
    kind = F.col("event_type")
    coin = F.when(kind == "click", "BTC").when(kind == "view", "ETH").when(kind == "purchase", "SOL").otherwise(F.upper(kind))
    df = table(spark, sf_dir, "events")
    captured = shifted(instant("ts"), F.lit(-SHIFT_DAYS * MICROS_PER_DAY))
    return df.select(
        coin.alias("coin_id"),
        F.when(kind == "error", "eur").otherwise("usdt").alias("vs_currency"),
        F.col("value").cast(AMOUNT).alias("price"),
        F.lit(None).cast(AMOUNT).alias("market_cap"),
        F.lit(None).cast(AMOUNT).alias("price_change_24h_pct"),
        captured.alias("captured_at"),
        utc_date(captured).alias("extracted_date"),
        F.format_string("crypto/%d", "event_id").alias("object_key"),
    )


RAW_CRYPTO_SQL = """
select case event_type when 'click' then 'BTC' when 'view' then 'ETH' when 'purchase' then 'SOL' else upper(event_type) end as coin_id,
       case when event_type = 'error' then 'eur' else 'usdt' end as vs_currency, value as price,
       cast(null as double) as market_cap, cast(null as double) as price_change_24h_pct,
       ts - interval 9131 day as captured_at, cast(ts - interval 9131 day as date) as extracted_date,
       'crypto/' || event_id as object_key
from events
"""


def _weather(spark: SparkSession, sf_dir: str, day_micros: Column) -> DataFrame:
    captured = F.timestamp_micros(day_micros + F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select(
        F.format_string("city-%d", "l_suppkey").alias("city"),
        F.col("l_tax").cast(COORDINATE).alias("latitude"),
        F.col("l_discount").cast(COORDINATE).alias("longitude"),
        F.col("l_quantity").cast(AMOUNT).alias("temperature_c"),
        F.col("l_discount").cast(AMOUNT).alias("windspeed_kmh"),
        F.when(F.col("l_linestatus") != "F", F.col("l_linenumber").cast("int")).alias("weather_code"),
        instant("l_shipdate").alias("observed_at"),
        captured.alias("captured_at"),
        utc_date(captured).alias("extracted_date"),
        F.format_string("weather/%d", "l_partkey").alias("object_key"),
    )


def _weather_sql(day: str) -> str:
    captured = f"{day} + to_microseconds(l_orderkey * 10 + l_linenumber)"
    return f"""
select 'city-' || l_suppkey as city, l_tax as latitude, l_discount as longitude, l_quantity as temperature_c,
       l_discount as windspeed_kmh, case when l_linestatus <> 'F' then l_linenumber end as weather_code,
       l_shipdate as observed_at, {captured} as captured_at, cast({captured} as date) as extracted_date,
       'weather/' || l_partkey as object_key
from lineitem
"""


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings: a supplier is a city, a ship date its day; the code is missing where the line is final."""
    return _weather(spark, sf_dir, F.unix_micros(instant("l_shipdate")))


RAW_WEATHER_SQL = _weather_sql("l_shipdate")


def raw_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates: the priority names the quote currency and the status the base."""
    quote = F.col("o_orderpriority")
    currency = (
        F.when(quote == "1-URGENT", "GBP").when(quote == "2-HIGH", "EUR").when(quote == "3-MEDIUM", "JPY").otherwise("CHF")
    )
    captured = shifted(instant("o_orderdate"), F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "EUR").otherwise("USD").alias("base_currency"),
        currency.alias("quote_currency"),
        F.col("o_totalprice").cast(AMOUNT).alias("rate"),
        captured.alias("captured_at"),
        utc_date(captured).alias("extracted_date"),
        F.format_string("fx/%d", "o_orderkey").alias("object_key"),
    )


RAW_FX_SQL = """
select case when o_orderstatus = 'P' then 'EUR' else 'USD' end as base_currency,
       case o_orderpriority when '1-URGENT' then 'GBP' when '2-HIGH' then 'EUR' when '3-MEDIUM' then 'JPY' else 'CHF' end as quote_currency,
       o_totalprice as rate, o_orderdate + to_microseconds(o_orderkey) as captured_at,
       cast(o_orderdate + to_microseconds(o_orderkey) as date) as extracted_date, 'fx/' || o_orderkey as object_key
from orders
"""


def crypto_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticker poll per event, all of listed coins."""
    kind = F.col("event_type")
    symbol = F.when(kind.isin("click", "signup"), "BTCUSDT").when(kind.isin("view", "error"), "ETHUSDT").otherwise("SOLUSDT")
    ticker = F.struct(
        symbol.alias("symbol"),
        F.greatest(F.col("value"), F.lit(0.01)).cast("string").alias("lastPrice"),
        F.col("user_id").cast("string").alias("priceChangePercent"),
    )
    return table(spark, sf_dir, "events").select(
        F.lit("crypto").alias("source_name"),
        shifted(instant("ts"), F.lit(-SHIFT_DAYS * MICROS_PER_DAY)).alias("captured_at"),
        F.to_json(F.array(ticker)).alias("payload"),
    )


CRYPTO_POLLS_SQL = """
select case when event_type in ('click', 'signup') then 'BTC' when event_type in ('view', 'error') then 'ETH' else 'SOL' end as coin_id,
       'usdt' as vs_currency, greatest(value, 0.01) as price, cast(user_id as double) as price_change_24h_pct,
       ts - interval 9131 day as captured_at, cast(ts - interval 9131 day as date) as extracted_date
from events
"""


def weather_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One single-city poll per line item, captured on its ship date."""
    bronze = _weather(spark, sf_dir, F.unix_micros(instant("l_shipdate")))
    reading = F.struct(
        F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.col("temperature_c").cast("double").alias("temperature_2m"),
        F.col("windspeed_kmh").cast("double").alias("wind_speed_10m"),
        "weather_code",
    )
    entry = F.struct(
        "city",
        F.col("latitude").cast("double").alias("lat"),
        F.col("longitude").cast("double").alias("lon"),
        F.struct(reading.alias("current")).alias("payload"),
    )
    return bronze.select(F.lit("weather").alias("source_name"), "captured_at", F.to_json(F.array(entry)).alias("payload"))


WEATHER_POLLS_SQL = RAW_WEATHER_SQL


def fx_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One poll of three rates per order, captured on its date; the base is absent from open orders' polls."""
    status = F.col("o_orderstatus")
    base = F.when(status == "F", "USD").when(status == "P", "EUR")
    price = F.col("o_totalprice")
    rates = F.create_map(F.lit("GBP"), price, F.lit("EUR"), price / 2, F.lit("JPY"), price * 2)
    return table(spark, sf_dir, "orders").select(
        F.lit("fx").alias("source_name"),
        shifted(instant("o_orderdate"), F.col("o_orderkey")).alias("captured_at"),
        F.to_json(F.struct(base.alias("base"), F.to_date("o_orderdate").cast("string").alias("date"), rates.alias("rates"))).alias(
            "payload"
        ),
    )


FX_POLLS_SQL = f"""
select base_currency, quote_currency, o_totalprice * factor as rate, captured_at, cast(captured_at as date) as extracted_date
from (select case when o_orderstatus = 'P' then 'EUR' else 'USD' end as base_currency, o_totalprice,
             o_orderdate + to_microseconds(o_orderkey) as captured_at from orders) p
cross join (values ('GBP', 1.0::double), ('EUR', 0.5::double), ('JPY', 2.0::double)) q(quote_currency, factor)
"""


def write_objects(spark: SparkSession, sf_dir: str, root: str, suppliers: Column) -> None:
    """What an outside poller leaves: a file for each poll, here of one supplier's balance as a price, below its source. Tasks write them."""
    at = F.timestamp_micros(F.lit(OBJECT_MICROS) + F.col("s_suppkey") * 60_000_000)
    ticker = F.struct(
        F.concat("s_name", F.lit("USDT")).alias("symbol"), F.abs("s_acctbal").cast("string").alias("lastPrice"), F.col("s_nationkey").cast("string").alias("priceChangePercent")
    )
    polls = table(spark, sf_dir, "supplier").where(suppliers).select(archive_key(F.lit("crypto"), at).alias("object_key"), F.to_json(F.array(ticker)).alias("payload"))
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(path(root)).toUri().toString()
    try:
        FileSystem.from_uri(uri)
    except (OSError, ValueError):
        # A file system that only Hadoop's classes open, which tasks in Python do not have.
        for object_key, payload in polls.toLocalIterator():
            out_ = system.create(path(f"{root}/{object_key}"))
            out_.write(bytearray(payload.encode()))
            out_.close()
        return

    def write(rows: Iterator[Row]) -> None:
        store, base = FileSystem.from_uri(uri)
        made = set()
        for object_key, payload in rows:
            folder, _, name = f"{base}/{object_key}".rpartition("/")
            if folder not in made:
                store.create_dir(folder)
                made.add(folder)
            # Readers skip names with a dot in front, so they never see half a file, not even of a task that runs twice.
            hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(hidden) as out_:
                out_.write(payload.encode())
            store.move(hidden, f"{folder}/{name}")

    polls.repartition(OBJECT_TASKS * spark.sparkContext.defaultParallelism).foreachPartition(write)


OBJECTS_SQL = """
select s_name as coin_id, 'usdt' as vs_currency, abs(s_acctbal) as price, cast(s_nationkey as double) as price_change_24h_pct,
       timestamp '2024-01-01 00:00:00' + to_microseconds(s_suppkey * 60000000) as captured_at,
       cast(timestamp '2024-01-01 00:00:00' + to_microseconds(s_suppkey * 60000000) as date) as extracted_date,
       'crypto/' || strftime(timestamp '2024-01-01 00:00:00' + to_microseconds(s_suppkey * 60000000), '%Y%m%dT%H%M%S') || '000000Z.json' as object_key
from supplier
"""


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts: a day is a run, a user a source; errors are failed attempts."""
    failed = F.col("event_type") == "error"
    started = F.col("ts")
    return events(spark, sf_dir).select(
        F.col("extracted_date").cast("string").alias("dag_run_id"),
        F.col("event_type").alias("task_id"),
        F.col("user_id").cast("int").alias("source_id"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(~failed, F.col("event_id")).alias("rows_loaded"),
        started.alias("started_at"),
        shifted(started, F.round(F.col("value") * 1e6).cast("bigint")).alias("ended_at"),
        "event_id",
    )


RUN_LOG_SQL = """
select cast(cast(ts as date) as varchar) as dag_run_id, event_type as task_id, cast(user_id as integer) as source_id,
       case when event_type = 'error' then 'failed' else 'success' end as status,
       case when event_type <> 'error' then event_id end as rows_loaded, ts as started_at,
       ts + to_microseconds(cast(round(value * 1e6) as bigint)) as ended_at, event_id
from events
"""


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures: the error events."""
    return events(spark, sf_dir).where(F.col("event_type") == "error").select(
        F.col("extracted_date").cast("string").alias("dag_run_id"),
        F.col("event_type").alias("task_id"),
        F.col("user_id").cast("int").alias("source_id"),
        F.col("props").alias("error_message"),
        F.lit(None).cast("string").alias("error_traceback"),
        F.col("ts").alias("occurred_at"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources: suppliers in credit are active; some load types are not accepted values."""
    credit = F.col("s_acctbal")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("source_id"),
        F.col("s_name").alias("source_name"),
        F.lit("landing").alias("base_url"),
        F.format_string("nation-%d", "s_nationkey").alias("endpoint_path"),
        F.lit("GET").alias("http_method"),
        F.when(credit < 0, "token").otherwise("none").alias("auth_type"),
        F.lit(None).cast("string").alias("auth_conn_id"),
        F.lit("{}").alias("query_params"),
        F.lit("bronze.raw_fx").alias("target_bronze_table"),
        F.when(credit > 5000, "incremental").when(credit > 1000, "full").otherwise("delta").alias("load_type"),
        F.lit(None).cast("string").alias("watermark_column"),
        (credit > 0).alias("is_active"),
        F.when(F.col("s_nationkey") < 12, "daily_pipeline").otherwise("crypto_realtime_pipeline").alias("owning_dag"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
    )


REGISTRY_SQL = """
select cast(s_suppkey as integer) as source_id, s_name as source_name, 'landing' as base_url, 'nation-' || s_nationkey as endpoint_path,
       'GET' as http_method, case when s_acctbal < 0 then 'token' else 'none' end as auth_type, cast(null as varchar) as auth_conn_id,
       '{}' as query_params, 'bronze.raw_fx' as target_bronze_table,
       case when s_acctbal > 5000 then 'incremental' when s_acctbal > 1000 then 'full' else 'delta' end as load_type,
       cast(null as varchar) as watermark_column, s_acctbal > 0 as is_active,
       case when s_nationkey < 12 then 'daily_pipeline' else 'crypto_realtime_pipeline' end as owning_dag
from supplier
"""
