"""Payload parsing, the archive, bronze appends, and the whole chain, over polls made from the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.frames import (
    CRYPTO_POLLS_SQL,
    FX_POLLS_SQL,
    OBJECTS_SQL,
    WEATHER_POLLS_SQL,
    crypto_polls,
    events,
    fx_polls,
    instant,
    out,
    shifted,
    table,
    weather_polls,
    write_objects,
)
from catalog.models import fact_sql, measures, snapshot_sql
from tidemark import shared_path
from tidemark.functions import archive_key, config_fallback, utc_date
from tidemark.plans.ingest import Warehouse, ingest_run
from tidemark.plans.build import GREATEST, Target, build_market
from tidemark.plans.daily import daily_run
from tidemark.schemas import RAW_CRYPTO, RAW_FX, RAW_WEATHER
from tidemark.session import input_bytes
from tidemark.sources import (
    append_bronze,
    config_list,
    database_name,
    default_sources,
    materialize,
    parse_crypto,
    parse_fx,
    parse_weather,
    read_archive,
    read_bronze,
    read_landing,
    route,
    write_archive,
)
from tidemark.sources.landing import stamp_polls

AS_OF = dt.date(2024, 2, 1)
#: Bounds of the slices that are ingested and built one after the other.
SLICES = (dt.datetime(1998, 6, 1, tzinfo=dt.timezone.utc), dt.datetime(1999, 1, 11, tzinfo=dt.timezone.utc))
CREATED_AT = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
#: The tables may quote a coin several times at one instant; as in the SQL, the greatest price counts.
REPEATED = {"repeated_ticks": GREATEST}
#: Bytes of tables whose polls are moved at once to be archived, and in how many parts at most, each of which reads the tables.
PART_BYTES, MOST_PARTS = 128 * 1024 * 1024, 8


def raw_archive_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", archive_key(F.col("event_type"), F.col("ts")).alias("object_key"))


def stamp_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return events(spark, sf_dir).select("event_id", utc_date(ts).alias("extracted_date"), archive_key(F.lit("events"), ts).alias("object_key"))


def landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every poll, then read the archive back."""
    root = shared_path(spark, "archive")
    write_archive(crypto_polls(spark, sf_dir), root)
    return out(read_archive(spark, root).drop("extracted_date"), times=("captured_at",))


def landing_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each poll, read and parsed."""
    root = shared_path(spark, "objects")
    write_objects(spark, sf_dir, root, F.lit(True))
    return out(parse_crypto(read_landing(spark, root)).rows.drop("market_cap"), ("price", "price_change_24h_pct"), ("captured_at",))


def payload_array_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line item is a poll of three tickers, one without the suffix."""
    def ticker(symbol: str, amount: str):
        return F.struct(
            F.lit(symbol).alias("symbol"), F.col(amount).cast("string").alias("lastPrice"), F.col("l_tax").cast("string").alias("priceChangePercent")
        )

    payload = F.to_json(F.array(ticker("QTYUSDT", "l_quantity"), ticker("PRICEUSDT", "l_extendedprice"), ticker("RATEEUR", "l_discount")))
    polls = table(spark, sf_dir, "lineitem").select(
        F.lit("crypto").alias("source_name"),
        shifted(instant("l_shipdate"), F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("captured_at"),
        payload.alias("payload"),
    )
    rows = parse_crypto(stamp_polls(polls)).rows
    return out(rows.drop("object_key"), ("price", "market_cap", "price_change_24h_pct"), ("captured_at",))


def payload_map_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse_fx(stamp_polls(fx_polls(spark, sf_dir)), {"base": "USD"}).rows
    return out(rows.drop("object_key"), ("rate",), ("captured_at",))


def config_fallback_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    configured = F.when(status == "P", F.lit("CHF"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", config_fallback(F.when(status == "F", F.lit("EUR")), configured, "USD").alias("base_currency")
    )


def payload_nested_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse_weather(stamp_polls(weather_polls(spark, sf_dir))).rows
    doubles = ("latitude", "longitude", "temperature_c", "windspeed_kmh")
    return out(rows.drop("object_key"), doubles, ("observed_at", "captured_at"))


def required_fields_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls of two tickers; a bad second one rejects both. Reports what was kept and why the rest was not."""
    kind = F.col("event_type")
    good = F.struct(
        F.lit("BTCUSDT").alias("symbol"), F.col("value").cast("string").alias("lastPrice"), F.lit("0.5").alias("priceChangePercent")
    )
    other = F.struct(
        F.when(kind != "signup", "ETHUSDT").alias("symbol"),
        F.when(kind == "error", "n/a").otherwise(F.col("value").cast("string")).alias("lastPrice"),
        F.lit("0.5").alias("priceChangePercent"),
    )
    broken = F.when(kind == "purchase", F.lit("{not json")).otherwise(F.to_json(F.array(good, other)))
    polls = events(spark, sf_dir).select(
        F.lit("crypto").alias("source_name"), F.col("ts").alias("captured_at"), broken.alias("payload")
    )
    parsed = parse_crypto(stamp_polls(polls), mode="quarantine")
    kept = parsed.rows.select("captured_at", F.col("coin_id").alias("outcome"))
    rejected = parsed.rejected.select("captured_at", F.col("reason").alias("outcome"))
    return out(kept.unionByName(rejected), times=("captured_at",))


def route_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feeds in one landing frame, each through its own parser."""
    landing = stamp_polls(
        crypto_polls(spark, sf_dir).unionByName(fx_polls(spark, sf_dir)).unionByName(weather_polls(spark, sf_dir))
    )
    counts = None
    for name, entity in (("crypto", "coin_id"), ("fx", "quote_currency"), ("weather", "city")):
        rows = route(landing, name).rows
        found = rows.groupBy(F.lit(name).alias("source_name"), F.col(entity).alias("entity")).agg(
            F.count(F.lit(1)).alias("row_count"), F.min("extracted_date").alias("first_day"), F.max("extracted_date").alias("last_day")
        )
        counts = found if counts is None else counts.unionByName(found)
    return counts


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends; each poll's rows are in the table once, and the counts say so."""
    path = shared_path(spark, "raw_crypto")
    rows = parse_crypto(stamp_polls(crypto_polls(spark, sf_dir))).rows
    first = F.col("coin_id") == "BTC"
    written = [append_bronze(rows.where(first), path), append_bronze(rows.where(~first), path)]
    stored = read_bronze(spark, path, RAW_CRYPTO)
    per_day = stored.groupBy("extracted_date", "coin_id").agg(F.count(F.lit(1)).alias("row_count"), F.sum("price").alias("total"))
    return out(per_day.withColumn("rows_written", F.lit(sum(written)).cast("bigint")), ("total",))


def materialize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuild a stored model twice, the second time from its own contents."""
    path = shared_path(spark, "warehouse")
    database = database_name(f"trial_{path.rsplit('-', 1)[-1]}", "silver", production=False)
    orders = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    name = materialize(orders, database, "orders_daily", path)
    materialize(spark.table(name).withColumn("n", F.col("n") * 2), database, "orders_daily", path)
    return spark.table(name)


def _archived(polls: DataFrame, archive: str) -> None:
    """Archive polls, in parts where they are made from large tables."""
    write_archive(polls, archive, monthly=True, parts=max(1, min(MOST_PARTS, -(-input_bytes(polls) // PART_BYTES))))


def _ingested(spark: SparkSession, warehouse: Warehouse, polls: DataFrame, run: str) -> None:
    """Archive polls and load what the archive holds of them into bronze."""
    archive = warehouse.table(f"archive_{run}")
    _archived(polls, archive)
    registry = default_sources(spark, CREATED_AT)
    for owner in ("daily_pipeline", "crypto_realtime_pipeline"):
        failed = [r for r in ingest_run(spark, registry, owner, read_archive(spark, archive), warehouse, run, clustered=True) if r["status"] != "success"]
        if failed:
            raise RuntimeError(str(failed))


def _market(spark: SparkSession) -> tuple[Warehouse, Callable[[], dict[str, DataFrame]]]:
    """A warehouse for years of few readings and rates a day, and its bronze frames as they are when asked for."""
    warehouse = Warehouse(shared_path(spark, "market"), monthly=frozenset({"bronze.raw_weather", "bronze.raw_fx"}))
    schemas = {"raw_weather": RAW_WEATHER, "raw_crypto": RAW_CRYPTO, "raw_fx": RAW_FX}
    return warehouse, lambda: {name: read_bronze(spark, warehouse.table(f"bronze.{name}"), schema) for name, schema in schemas.items()}


def _polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crypto_polls(spark, sf_dir).unionByName(fx_polls(spark, sf_dir)).unionByName(weather_polls(spark, sf_dir))


def market_snapshot_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls to archive to bronze to checked silver to checked gold."""
    warehouse, bronze = _market(spark)
    _ingested(spark, warehouse, _polls(spark, sf_dir), "run")
    return measures(build_market(spark, bronze, warehouse.root, AS_OF, cover_data=True, **REPEATED).fct_market_snapshot)


def market_incremental_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in three slices of time, built after each: no rates of the first slice, and no readings of some of its days, come until the last."""
    warehouse, bronze = _market(spark)
    polls, at = _polls(spark, sf_dir), F.col("captured_at")
    late = (at < F.lit(SLICES[0])) & ((F.col("source_name") == "fx") | (F.col("source_name") == "weather") & (F.dayofmonth(at) == 13))
    slices = [(at < F.lit(SLICES[0])) & ~late, (at >= F.lit(SLICES[0])) & (at < F.lit(SLICES[1])), (at >= F.lit(SLICES[1])) | late]
    for number, part in enumerate(slices):
        _ingested(spark, warehouse, polls.where(part), f"run{number}")
        built = build_market(spark, bronze, warehouse.root, AS_OF, cover_data=True, full=False, **REPEATED)
    return measures(built.fct_market_snapshot)


def market_daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's whole run over all polls: the published gold table, with what the run's verdict says."""
    warehouse, _ = _market(spark)
    archive, registry = warehouse.table("archive"), default_sources(spark, CREATED_AT)
    _archived(_polls(spark, sf_dir), archive)
    ticks = ingest_run(spark, registry, "crypto_realtime_pipeline", read_archive(spark, archive), warehouse, "ticks", clustered=True)
    target = Target(f"trial_{warehouse.root.rsplit('-', 1)[-1]}")
    as_of = dt.datetime.combine(AS_OF, dt.time(), dt.timezone.utc)
    done = daily_run(spark, registry, lambda: read_archive(spark, archive), warehouse, "daily", as_of, target=target, cover_data=True, clustered=True, **REPEATED)
    if done.violation or any(r["status"] != "success" for r in ticks):
        raise RuntimeError(done.violation or str(ticks))
    said = {"verdict": F.lit(done.verdict), "sources": F.lit(done.success).cast("bigint"), "rows_loaded": F.lit(done.rows_loaded).cast("bigint")}
    return measures(spark.table(f"{target.database('gold')}.fct_market_snapshot")).withColumns(said)


QUERIES = {
    "raw_archive_key": raw_archive_key,
    "stamp_rows": stamp_rows,
    "landing_scan": landing_scan,
    "landing_objects": landing_objects,
    "payload_array_inline": payload_array_inline,
    "payload_map_explode": payload_map_explode,
    "config_fallback": config_fallback_query,
    "payload_nested_project": payload_nested_project,
    "required_fields_split": required_fields_split,
    "route_by_source": route_by_source,
    "bronze_append": bronze_append,
    "materialize_table": materialize_table,
    "market_snapshot_e2e": market_snapshot_e2e,
    "market_incremental_e2e": market_incremental_e2e,
    "market_daily_run": market_daily_run,
}

_KEY = "strftime({ts}, '%Y%m%dT%H%M%S%fZ') || '.json'"
_WEATHER_ROWS = f"""
select city, latitude, longitude, temperature_c, windspeed_kmh, weather_code, observed_at, captured_at, extracted_date from ({WEATHER_POLLS_SQL}) r
"""
_STAGED_WEATHER = f"""
select * from (
  select *, row_number() over (partition by city, extracted_date order by captured_at desc nulls first, observed_at desc nulls last,
    temperature_c desc nulls last, windspeed_kmh desc nulls last, weather_code desc nulls last, latitude desc, longitude desc) as rn
  from ({_WEATHER_ROWS}) r) s where rn = 1
"""
_STAGED_FX = f"""
select * from (
  select *, row_number() over (partition by base_currency, quote_currency, extracted_date order by captured_at desc nulls first, rate desc) as rn
  from ({FX_POLLS_SQL}) r) s where rn = 1
"""
_E2E_SNAPSHOT = snapshot_sql(_STAGED_WEATHER, CRYPTO_POLLS_SQL, _STAGED_FX)


def _counted(name: str, entity: str, source: str) -> str:
    return f"""
select '{name}' as source_name, {entity} as entity, count(*) as row_count, min(extracted_date) as first_day, max(extracted_date) as last_day
from ({source}) r group by {entity}
"""


ORACLES = {
    "raw_archive_key": f"select event_id, event_type || '/' || {_KEY.format(ts='ts')} as object_key from events",
    "stamp_rows": f"select event_id, cast(ts as date) as extracted_date, 'events/' || {_KEY.format(ts='ts')} as object_key from events",
    "landing_scan": f"""
select 'crypto/' || {_KEY.format(ts='captured_at')} as object_key, 'crypto' as source_name, captured_at,
       '[{{"symbol":"' || coin_id || 'USDT","lastPrice":"' || cast(price as varchar) || '","priceChangePercent":"' ||
       cast(cast(price_change_24h_pct as bigint) as varchar) || '"}}]' as payload
from ({CRYPTO_POLLS_SQL}) p
""",
    "payload_array_inline": """
with p as (select l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate + to_microseconds(l_orderkey * 10 + l_linenumber) as captured_at from lineitem),
     r as (select 'QTY' as coin_id, l_quantity as price, l_tax, captured_at from p
           union all select 'PRICE', l_extendedprice, l_tax, captured_at from p
           union all select 'RATEEUR', l_discount, l_tax, captured_at from p)
select coin_id, 'usdt' as vs_currency, price, cast(null as double) as market_cap, l_tax as price_change_24h_pct, captured_at,
       cast(captured_at as date) as extracted_date from r
""",
    "payload_map_explode": FX_POLLS_SQL,
    "config_fallback": """
select o_orderkey, case o_orderstatus when 'F' then 'EUR' when 'P' then 'CHF' else 'USD' end as base_currency from orders
""",
    "payload_nested_project": _WEATHER_ROWS,
    "required_fields_split": """
select ts as captured_at, coin as outcome from events cross join (values ('BTC'), ('ETH')) c(coin) where event_type in ('click', 'view')
union all
select ts, case event_type when 'signup' then 'required field missing' when 'error' then 'number not readable' else 'not an array of tickers' end
from events where event_type not in ('click', 'view')
""",
    "route_by_source": _counted("crypto", "coin_id", CRYPTO_POLLS_SQL)
    + "union all"
    + _counted("fx", "quote_currency", FX_POLLS_SQL)
    + "union all"
    + _counted("weather", "city", _WEATHER_ROWS),
    "bronze_append": f"""
select extracted_date, coin_id, count(*) as row_count, cast(sum(cast(price as decimal(18,2))) as double) as total,
       (select count(*) from events) as rows_written
from ({CRYPTO_POLLS_SQL}) r group by extracted_date, coin_id
""",
    "materialize_table": "select cast(o_orderdate as date) as d, 2 * count(*) as n from orders group by 1",
    "market_snapshot_e2e": fact_sql(
        _E2E_SNAPSHOT, f"select min(snapshot_date) as lo, max(snapshot_date) as hi from ({_E2E_SNAPSHOT}) z"
    ),
}
ORACLES["market_incremental_e2e"] = ORACLES["market_snapshot_e2e"]
ORACLES["market_daily_run"] = f"""
select e.*, 'SUCCESS' as verdict, cast(2 as bigint) as sources, w.n + x.n as rows_loaded
from ({ORACLES["market_snapshot_e2e"]}) e, (select count(*) as n from ({_WEATHER_ROWS}) r) w, (select count(*) as n from ({FX_POLLS_SQL}) r) x
"""
ORACLES["landing_objects"] = OBJECTS_SQL
