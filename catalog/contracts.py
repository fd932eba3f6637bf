"""Checks over the test tables, with violations to find."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.frames import REGISTRY_SQL, RUN_LOG_SQL, error_log, events, out, raw_crypto, raw_fx, raw_weather, registry, run_log, table
from catalog.models import SNAPSHOT_SQL, STG_CRYPTO_SQL, STG_FX_SQL, STG_WEATHER_SQL
from tidemark import shared_path
from tidemark.operators import date_dim_for
from tidemark.plans import market
from tidemark.plans.contracts import control_checks, run_contracts
from tidemark.quality import (
    ContractViolation,
    accepted_values,
    between,
    duplicate_groups,
    duplicate_keys,
    freshness,
    future_dates,
    gate,
    not_null,
    orphan_keys,
    relationships,
    run_suite,
    unique,
    unique_combination,
    violating_samples,
    violations,
)

AS_OF = dt.date(1999, 1, 25)


def _failures(df: DataFrame, check) -> DataFrame:
    return run_suite({check.model: df}, [check]).select("column_name", "failures")


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return _failures(df, not_null("events", "event_type"))


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_key = F.when(F.col("l_linestatus") != "F", F.col("l_orderkey")).alias("k")
    return duplicate_keys(table(spark, sf_dir, "lineitem").select(open_key), "k")


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "events").select(F.nullif("event_type", F.lit("error")).alias("value_field"))
    bad = violations(kinds, accepted_values("events", "value_field", ["click", "view"]))
    return bad.groupBy("value_field").agg(F.count(F.lit(1)).alias("n_records"))


def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return _failures(df, between("events", "value", 10.0, 100.0))


def dq_strict_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(table(spark, sf_dir, "lineitem"), between("lineitem", "l_discount", 0, strictly=True))


def dq_row_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = F.col("event_type") != "error"
    return _failures(
        table(spark, sf_dir, "events"), between("events", "value", 10.0, strictly=True, row_condition=condition)
    )


def dq_unique_combo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return orphan_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", parent, "o_orderkey")


def dq_no_future_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = {
        "events": (raw_crypto(spark, sf_dir), "extracted_date"),
        "orders": (raw_fx(spark, sf_dir), "extracted_date"),
        "lineitem": (raw_weather(spark, sf_dir), "extracted_date"),
    }
    return future_dates(days, AS_OF, day_as="captured_date")


def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes, hours = (lambda n: dt.timedelta(minutes=n)), (lambda n: dt.timedelta(hours=n))
    as_of = dt.datetime(2024, 1, 31, 0, 15, tzinfo=dt.timezone.utc)
    ticks = freshness(events(spark, sf_dir), "events", "ts", as_of, minutes(15), minutes(30))
    orders = freshness(table(spark, sf_dir, "orders"), "orders", "o_orderdate", as_of, hours(26), hours(48))
    none = freshness(events(spark, sf_dir).where(F.col("ts") > F.lit(as_of)), "nothing", "ts", as_of, hours(26), hours(48))
    return out(ticks, times=("max_loaded_at",)).unionAll(orders).unionAll(out(none, times=("max_loaded_at",)))


def dq_ddl_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = {
        "api_sources": registry(spark, sf_dir),
        "pipeline_run_log": run_log(spark, sf_dir),
        "error_log": error_log(spark, sf_dir),
    }
    return run_suite(models, control_checks())


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 31 declared checks. Models that take a shuffle to build are stored once, not rebuilt per check."""

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = shared_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    weather = stored(market.stg_weather(raw_weather(spark, sf_dir)), "stg_weather")
    fx = stored(market.stg_fx_rates(raw_fx(spark, sf_dir)), "stg_fx_rates")
    crypto = market.stg_crypto_prices(raw_crypto(spark, sf_dir))
    dim = date_dim_for(raw_fx(spark, sf_dir), "extracted_date")
    fact = stored(market.fct_market_snapshot(market.snapshot_from_staging(weather, crypto, fx), dim), "fct_market_snapshot")
    ticks = market.tick_table(shared_path(spark, "fct_crypto_price_ticks"))
    ticks.load(crypto)
    models = {
        "stg_weather": weather,
        "stg_crypto_prices": crypto,
        "stg_fx_rates": fx,
        "dim_date": dim,
        "fct_market_snapshot": fact,
        "fct_crypto_price_ticks": ticks.read(spark, crypto.schema),
    }
    return run_contracts(models, AS_OF)


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate says of a layer whose suite has failures: the failed checks, and only those."""
    schema = "layer string, check_name string, model string, column_name string, failures long"
    try:
        gate(dq_suite(spark, sf_dir), "market")
    except ContractViolation as broken:
        return spark.createDataFrame([(broken.layer, *row) for row in broken.failed], schema)
    return spark.createDataFrame([], schema)


def dq_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first violations of each kind of check, over line items and orders."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    models = {"lineitem": lines.withColumn("flag", F.nullif("l_returnflag", F.lit("R"))), "orders": orders.where("o_orderkey % 10 <> 3")}
    checks = [
        not_null("lineitem", "flag"),
        between("lineitem", "l_linenumber", 1, 5),
        unique_combination("lineitem", ["l_orderkey", "l_linenumber"]),
        unique("orders", "o_custkey"),
        relationships("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ]
    samples = violating_samples(models, checks, {"lineitem": ["l_orderkey", "l_linenumber"]}, most=7)
    return samples.withColumn("sample", F.array_join("sample", "/", "null"))


QUERIES = {
    "dq_samples": dq_samples,
    "dq_gate": dq_gate,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_between": dq_between,
    "dq_strict_bound": dq_strict_bound,
    "dq_row_condition": dq_row_condition,
    "dq_unique_combo": dq_unique_combo,
    "dq_relationships": dq_relationships,
    "dq_no_future_dates": dq_no_future_dates,
    "source_freshness": source_freshness,
    "dq_ddl_constraints": dq_ddl_constraints,
    "dq_suite": dq_suite,
}


def _result(name: str, model: str, column: str, failures: str) -> str:
    return f"select '{name}' as check_name, '{model}' as model, '{column}' as column_name, cast(({failures}) as bigint) as failures"


def _where(name: str, model: str, source: str, column: str, condition: str) -> str:
    return _result(name, model, column, f"select count(*) from {source} where {condition}")


def _repeats(name: str, model: str, source: str, columns: str, where: str = "true") -> str:
    return _result(
        name, model, columns, f"select count(*) from (select 1 from {source} where {where} group by {columns} having count(*) > 1) g"
    )


def _suite_sql() -> str:
    w, c, f = ("stg_weather", "w"), ("stg_crypto_prices", "c"), ("stg_fx_rates", "f")
    d, s, t = ("dim_date", "d"), ("fct_market_snapshot", "s"), ("fct_crypto_price_ticks", "c")

    def null(model, column):
        return _where("not_null", *model, column, f"{column} is null")

    def bound(model, column, condition):
        return _where("between", *model, column, f"not ({condition})")

    parts = [
        null(w, "city"), null(w, "temperature_c"), bound(w, "temperature_c", "temperature_c >= -90 and temperature_c <= 60"),
        bound(w, "windspeed_kmh", "windspeed_kmh >= 0 and windspeed_kmh <= 500"), null(w, "extracted_date"),
        _repeats("unique_combination", *w, "city, extracted_date"),
        null(c, "coin_id"), _where("accepted_values", *c, "coin_id", "coin_id not in ('BTC', 'ETH', 'SOL')"), null(c, "price"),
        bound(c, "price", "price > 0"), null(c, "captured_at"), _repeats("unique_combination", *c, "coin_id, vs_currency, captured_at"),
        null(f, "base_currency"), null(f, "quote_currency"),
        _where("accepted_values", *f, "quote_currency", "quote_currency not in ('GBP', 'EUR', 'JPY')"),
        null(f, "rate"), bound(f, "rate", "rate > 0"), null(f, "extracted_date"),
        _repeats("unique_combination", *f, "base_currency, quote_currency, extracted_date"),
        null(d, "date_day"), _repeats("unique", *d, "date_day", "date_day is not null"),
        null(s, "snapshot_date"), _repeats("unique", *s, "snapshot_date", "snapshot_date is not null"),
        _where("relationships", *s, "snapshot_date", "snapshot_date is not null and snapshot_date not in (select date_day from d)"),
        _where("between", *s, "btc_price_usd", "btc_price_usd is not null and not (btc_price_usd > 0)"),
        null(t, "coin_id"), null(t, "captured_at"), null(t, "price"), bound(t, "price", "price > 0"),
        _repeats("unique_combination", *t, "coin_id, vs_currency, captured_at"),
        _result(
            "no_future_dates", "staging", "extracted_date",
            "select sum(n) from (" + " union all ".join(
                f"select count(*) as n from {name} where extracted_date > date '1999-01-25'" for name in "wcf"
            ) + ") u",
        ),
    ]
    frames = f"""
with w as ({STG_WEATHER_SQL}), c as ({STG_CRYPTO_SQL}), f as ({STG_FX_SQL}), s as ({SNAPSHOT_SQL}),
     d as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date_day
           from (select min(cast(o_orderdate + to_microseconds(o_orderkey) as date)) as lo,
                        max(cast(o_orderdate + to_microseconds(o_orderkey) as date)) as hi from orders) b)
"""
    return frames + " union all ".join(parts)


def _control_sql() -> str:
    sources, runs, errors = ("api_sources", "a"), ("pipeline_run_log", "r"), ("error_log", "e")
    required = {
        sources: "source_id source_name base_url endpoint_path http_method auth_type query_params target_bronze_table load_type is_active "
        "owning_dag created_at",
        runs: "dag_run_id task_id status started_at ended_at",
        errors: "dag_run_id task_id error_message occurred_at",
    }
    parts = [_where("not_null", *model, c, f"{c} is null") for model, names in required.items() for c in names.split()]
    parts += [
        _repeats("unique", *sources, "source_id", "source_id is not null"),
        _repeats("unique", *sources, "source_name", "source_name is not null"),
        _where("accepted_values", *sources, "auth_type", "auth_type not in ('none', 'api_key', 'bearer')"),
        _where("accepted_values", *sources, "load_type", "load_type not in ('full', 'incremental')"),
        _where("accepted_values", *sources, "owning_dag", "owning_dag not in ('daily_pipeline', 'crypto_realtime_pipeline')"),
        _where("accepted_values", *runs, "status", "status not in ('success', 'failed')"),
        _where("relationships", *runs, "source_id", "source_id is not null and source_id not in (select source_id from a)"),
        _where("relationships", *errors, "source_id", "source_id is not null and source_id not in (select source_id from a)"),
    ]
    frames = f"""
with a as (select *, timestamp '2024-01-01 00:00:00' as created_at from ({REGISTRY_SQL}) x), r as ({RUN_LOG_SQL}),
     e as (select dag_run_id, task_id, source_id, 'x' as error_message, started_at as occurred_at from r where status = 'failed')
"""
    return frames + " union all ".join(parts)


_SAMPLES_SQL = """
with lines as (select *, nullif(l_returnflag, 'R') as flag from lineitem), parents as (select * from orders where o_orderkey % 10 <> 3),
found as (
    select 'not_null' as check_name, 'lineitem' as model, 'flag' as column_name, [cast(l_orderkey as varchar), cast(l_linenumber as varchar), flag] as sample, 1 as n
    from lines where flag is null
    union all select 'between', 'lineitem', 'l_linenumber', [cast(l_orderkey as varchar), cast(l_linenumber as varchar)], 1 from lines where l_linenumber not between 1 and 5
    union all select 'unique_combination', 'lineitem', 'l_orderkey, l_linenumber', [cast(l_orderkey as varchar), cast(l_linenumber as varchar)], count(*)
    from lines group by l_orderkey, l_linenumber having count(*) > 1
    union all select 'unique', 'orders', 'o_custkey', [cast(o_custkey as varchar)], count(*) from parents where o_custkey is not null group by o_custkey having count(*) > 1
    union all select 'relationships', 'lineitem', 'l_orderkey', [cast(l_orderkey as varchar)], count(*)
    from lines where l_orderkey is not null and l_orderkey not in (select o_orderkey from parents) group by l_orderkey
),
placed as (select *, row_number() over (partition by check_name order by sample, n) as sample_no from found)
select check_name, model, column_name, cast(sample_no as integer) as sample_no,
       array_to_string(list_transform(sample, lambda v: coalesce(v, 'null')), '/') as sample, cast(n as bigint) as n_records
from placed where sample_no <= 7
"""

ORACLES = {
    "dq_samples": _SAMPLES_SQL,
    "dq_gate": f"select 'market' as layer, * from ({_suite_sql()}) suite where failures > 0",
    "dq_not_null": "select 'event_type' as column_name, count(*) as failures from events where nullif(event_type, 'error') is null",
    "dq_unique": """
select k, count(*) as n_records from (select case when l_linestatus <> 'F' then l_orderkey end as k from lineitem) t
where k is not null group by k having count(*) > 1
""",
    "dq_accepted_values": """
select k as value_field, count(*) as n_records from (select nullif(event_type, 'error') as k from events) t
where k not in ('click', 'view') group by k
""",
    "dq_between": """
select 'value' as column_name, count(*) as failures from (select case when event_type <> 'error' then value end as v from events) t
where not (v >= 10.0 and v <= 100.0)
""",
    "dq_strict_bound": "select 'l_discount' as column_name, count(*) as failures from lineitem where not (l_discount > 0)",
    "dq_row_condition": "select 'value' as column_name, count(*) as failures from events where event_type <> 'error' and not (value > 10.0)",
    "dq_unique_combo": "select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by l_orderkey, l_linenumber having count(*) > 1",
    "dq_relationships": """
select l_orderkey, count(*) as n_records from lineitem
left join (select o_orderkey from orders where o_orderstatus <> 'P') p on l_orderkey = o_orderkey
where l_orderkey is not null and o_orderkey is null group by l_orderkey
""",
    "dq_no_future_dates": """
select 'events' as source_table, cast(ts as date) - 9131 as captured_date from events where cast(ts as date) - 9131 > date '1999-01-25'
union all
select 'orders', cast(o_orderdate + to_microseconds(o_orderkey) as date) from orders
where cast(o_orderdate + to_microseconds(o_orderkey) as date) > date '1999-01-25'
union all
select 'lineitem', cast(l_shipdate + to_microseconds(l_orderkey * 10 + l_linenumber) as date) from lineitem
where cast(l_shipdate + to_microseconds(l_orderkey * 10 + l_linenumber) as date) > date '1999-01-25'
""",
    "source_freshness": """
select 'events' as source_table, max_loaded_at, case when age_s > 1800 then 'error' when age_s > 900 then 'warn' else 'pass' end as status
from (select max(ts) as max_loaded_at, epoch(timestamp '2024-01-31 00:15:00' - max(ts)) as age_s from events)
union all
select 'orders', max_loaded_at, case when age_s > 172800 then 'error' when age_s > 93600 then 'warn' else 'pass' end
from (select max(o_orderdate) as max_loaded_at, epoch(timestamp '2024-01-31 00:15:00' - max(o_orderdate)) as age_s from orders)
union all
select 'nothing', max(ts), 'error' from events where ts > timestamp '2024-01-31 00:15:00'
""",
    "dq_ddl_constraints": _control_sql(),
    "dq_suite": _suite_sql(),
}
