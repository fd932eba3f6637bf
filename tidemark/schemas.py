"""Table and payload schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

AMOUNT = DecimalType(38, 18)
COORDINATE = DecimalType(9, 6)


def _struct(*fields: tuple) -> StructType:
    """Fields as (name, type) for required and (name, type, True) for nullable columns."""
    return StructType([StructField(f[0], f[1], len(f) > 2 and f[2]) for f in fields])


LANDING = _struct(
    ("object_key", StringType()),
    ("source_name", StringType()),
    ("captured_at", TimestampType()),
    ("payload", StringType(), True),
)

RAW_WEATHER = _struct(
    ("city", StringType()),
    ("latitude", COORDINATE),
    ("longitude", COORDINATE),
    ("temperature_c", AMOUNT),
    ("windspeed_kmh", AMOUNT),
    ("weather_code", IntegerType(), True),
    ("observed_at", TimestampType()),
    ("captured_at", TimestampType()),
    ("extracted_date", DateType()),
    ("object_key", StringType(), True),
)

RAW_CRYPTO = _struct(
    ("coin_id", StringType()),
    ("vs_currency", StringType()),
    ("price", AMOUNT),
    ("market_cap", AMOUNT, True),
    ("price_change_24h_pct", AMOUNT, True),
    ("captured_at", TimestampType()),
    ("extracted_date", DateType()),
    ("object_key", StringType(), True),
)

RAW_FX = _struct(
    ("base_currency", StringType()),
    ("quote_currency", StringType()),
    ("rate", AMOUNT),
    ("captured_at", TimestampType()),
    ("extracted_date", DateType()),
    ("object_key", StringType(), True),
)

API_SOURCES = _struct(
    ("source_id", IntegerType()),
    ("source_name", StringType()),
    ("base_url", StringType()),
    ("endpoint_path", StringType()),
    ("http_method", StringType()),
    ("auth_type", StringType()),
    ("auth_conn_id", StringType(), True),
    ("query_params", StringType()),
    ("target_bronze_table", StringType()),
    ("load_type", StringType()),
    ("watermark_column", StringType(), True),
    ("last_extracted_at", TimestampType(), True),
    ("is_active", BooleanType()),
    ("schedule_cron", StringType(), True),
    ("owning_dag", StringType()),
    ("created_at", TimestampType()),
)

RUN_LOG = _struct(
    ("dag_run_id", StringType()),
    ("task_id", StringType()),
    ("source_id", IntegerType(), True),
    ("status", StringType()),
    ("rows_loaded", LongType(), True),
    ("started_at", TimestampType()),
    ("ended_at", TimestampType()),
    ("duration_seconds", DoubleType(), True),
)

ERROR_LOG = _struct(
    ("dag_run_id", StringType()),
    ("task_id", StringType()),
    ("source_id", IntegerType(), True),
    ("error_message", StringType()),
    ("error_traceback", StringType(), True),
    ("occurred_at", TimestampType()),
)

# Payload shapes, as the three feeds send them.
WEATHER_PAYLOAD = ArrayType(
    StructType()
    .add("city", StringType())
    .add("lat", AMOUNT)
    .add("lon", AMOUNT)
    .add(
        "payload",
        StructType().add(
            "current",
            StructType()
            .add("time", StringType())
            .add("temperature_2m", AMOUNT)
            .add("wind_speed_10m", AMOUNT)
            .add("weather_code", IntegerType()),
        ),
    )
)

# The feed sends numbers as strings.
CRYPTO_PAYLOAD = ArrayType(
    StructType().add("symbol", StringType()).add("lastPrice", StringType()).add("priceChangePercent", StringType())
)

FX_PAYLOAD = (
    StructType()
    .add("base", StringType())
    .add("date", StringType())
    .add("rates", MapType(StringType(), AMOUNT))
    .add("_corrupt_record", StringType())
)

CITIES_CONFIG = StructType().add(
    "cities", ArrayType(StructType().add("name", StringType()).add("lat", DoubleType()).add("lon", DoubleType()))
)
SYMBOLS_CONFIG = StructType().add("base", StringType()).add("symbols", ArrayType(StringType()))
