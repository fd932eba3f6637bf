"""The source registry: which sources exist, who runs them, and with what settings."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.incremental import insert_if_absent
from tidemark.schemas import API_SOURCES
from tidemark.sources.payloads import PARSERS, Parsed

# Defaults of the registry columns. created_at is a parameter.
REGISTRY_DEFAULTS = {
    "http_method": "GET",
    "auth_type": "none",
    "query_params": "{}",
    "load_type": "full",
    "is_active": True,
    "owning_dag": "daily_pipeline",
}
# What the registry and the logs accept.
AUTH_TYPES = ("none", "api_key", "bearer")
LOAD_TYPES = ("full", "incremental")
OWNERS = ("daily_pipeline", "crypto_realtime_pipeline")
STATUSES = ("success", "failed")

ACTIVE_COLUMNS = (
    "source_id", "source_name", "base_url", "endpoint_path", "http_method", "auth_type", "auth_conn_id",
    "query_params", "target_bronze_table", "load_type", "watermark_column",
)


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULLs, and add absent columns, with the given defaults."""
    filled: dict[str, Column] = {}
    for name, value in defaults.items():
        default = value if isinstance(value, Column) else F.lit(value)
        filled[name] = F.coalesce(F.col(name), default) if name in df.columns else default
    return df.withColumns(filled)


def active_sources(registry: DataFrame, owner: str, columns: Sequence[str] = ACTIVE_COLUMNS) -> DataFrame:
    """Active sources of one owner, in id order."""
    chosen = registry.where(F.col("is_active") & (F.col("owning_dag") == owner))
    return chosen.select(*columns).orderBy("source_id")


def config_list(registry: DataFrame, schema: StructType, path: str, alias: str) -> DataFrame:
    """One row per element of a list in the JSON settings, e.g. the cities or symbols of a source."""
    parsed = registry.withColumn("__config", F.from_json("query_params", schema))
    kept = [c for c in registry.columns if c != "query_params"]
    return parsed.select(*kept, F.explode(f"__config.{path}").alias(alias))


def register_sources(existing: DataFrame, new: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Rows to append for ``new`` sources whose name is not registered; the first of a name wins."""
    defaults = dict(REGISTRY_DEFAULTS)
    if created_at is not None:
        defaults["created_at"] = created_at
    return insert_if_absent(apply_defaults(new, defaults), existing, ["source_name"], [F.col("source_id").asc()])


def default_sources(spark: SparkSession, created_at) -> DataFrame:
    """The three feeds this package ships parsers for."""
    # Cities with coordinates, symbols, base and quote currencies, owners.
    rows = [
        (
            1, "weather", "landing", "weather",
            '{"cities": [{"name": "London", "lat": 51.5074, "lon": -0.1278},'
            ' {"name": "New York", "lat": 40.7128, "lon": -74.0060},'
            ' {"name": "Tokyo", "lat": 35.6895, "lon": 139.6917}]}',
            "bronze.raw_weather", "@daily", "daily_pipeline",
        ),
        (
            2, "crypto", "landing", "crypto",
            '{"symbols": ["BTCUSDT", "ETHUSDT", "SOLUSDT"]}',
            "bronze.raw_crypto", "*/5 * * * *", "crypto_realtime_pipeline",
        ),
        (
            3, "fx", "landing", "fx",
            '{"base": "USD", "symbols": ["GBP", "EUR", "JPY"]}',
            "bronze.raw_fx", "@daily", "daily_pipeline",
        ),
    ]
    named = "source_id int, source_name string, base_url string, endpoint_path string, query_params string, "
    named += "target_bronze_table string, schedule_cron string, owning_dag string"
    seeded = apply_defaults(spark.createDataFrame(rows, named), {**REGISTRY_DEFAULTS, "created_at": F.lit(created_at)})
    return seeded.select(
        *[
            (F.col(f.name) if f.name in seeded.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in API_SOURCES.fields
        ]
    )


def route(
    landing: DataFrame,
    source_name: str,
    config: dict | None = None,
    mode: str = "raise",
    parsers: Mapping[str, Callable[..., Parsed]] = PARSERS,
) -> Parsed:
    """Rows and rejects of the polls of one source. An unknown feed fails here, before anything is planned."""
    if source_name not in parsers:
        raise ValueError(f"feed {source_name!r} cannot be parsed; known feeds: {', '.join(sorted(parsers))}")
    own = landing.where(F.col("source_name") == source_name)
    return parsers[source_name](own, config, mode)
