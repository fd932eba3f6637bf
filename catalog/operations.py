"""Registry, run bookkeeping and the late-data report over the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.frames import REGISTRY_SQL, RUN_LOG_SQL, error_log, events, out, registry, run_log, table
from tidemark import shared_path
from tidemark.operators import (
    error_count,
    late_data_report,
    run_log_rows,
    run_summary,
    run_summary_wide,
    run_verdict,
)
from tidemark.operators.runs import append_error_log, append_run_log
from tidemark.schemas import ERROR_LOG, RUN_LOG, SYMBOLS_CONFIG
from tidemark.sources import active_sources, apply_defaults, config_list

TIES = ["event_id"]
RUN = ["dag_run_id"]


def registry_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_sources(registry(spark, sf_dir), "daily_pipeline")


def config_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order carries a settings document listing two symbols."""
    settings = F.to_json(
        F.struct(F.lit("USD").alias("base"), F.array("o_orderpriority", "o_orderstatus").alias("symbols"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", settings.alias("query_params"))
    return config_list(orders, SYMBOLS_CONFIG, "symbols", "symbol")


def apply_defaults_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a method get the default; the owner is absent altogether."""
    df = table(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("http_method"), F.col("value").alias("load")
    )
    return apply_defaults(df, {"http_method": "GET", "owning_dag": "daily_pipeline"})


def run_log_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_log_rows(run_log(spark, sf_dir)).select("event_id", "source_id", "status", "duration_seconds")


def run_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts that failed are logged first, the others after; the log derives durations."""
    path, attempts = shared_path(spark, "run_log"), run_log(spark, sf_dir)
    for status in ("failed", "success"):
        append_run_log(spark, path, attempts.where(F.col("status") == status))
    logged = spark.read.schema(RUN_LOG).parquet(path)
    return out(logged, times=("started_at", "ended_at"))


def error_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The errors of two runs of days, logged one after the other."""
    path, errors = shared_path(spark, "error_log"), error_log(spark, sf_dir)
    early = F.col("dag_run_id") < "2024-01-16"
    for part in (early, ~early):
        append_error_log(spark, path, errors.where(part))
    return out(spark.read.schema(ERROR_LOG).parquet(path), times=("occurred_at",))


def run_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(run_log(spark, sf_dir), TIES, RUN)


def run_summary_wide_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary_wide(run_log(spark, sf_dir), TIES, RUN)


def error_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_count(error_log(spark, sf_dir), RUN)


def run_verdict_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A source per event type, so that some runs are clean and some are not.
    by_type = [F.col("dag_run_id"), F.col("task_id")]
    runs = run_log(spark, sf_dir).withColumn("dag_run_id", F.concat_ws("/", *by_type))
    errors = error_log(spark, sf_dir).withColumn("dag_run_id", F.concat_ws("/", *by_type))
    return run_verdict(run_summary_wide(runs, TIES, RUN), error_count(errors, RUN), RUN)


def late_data_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events arrive three days after they happened; the rest on their own day."""
    late = F.col("event_type") == "error"
    arrived = events(spark, sf_dir).withColumn(
        "arrival_day", F.when(late, F.date_add("extracted_date", 3)).otherwise(F.col("extracted_date"))
    )
    strict = late_data_report(arrived, "ts", "arrival_day").withColumn("policy", F.lit("strict"))
    reach = late_data_report(arrived, "ts", "arrival_day", dt.timedelta(days=2)).withColumn("policy", F.lit("lookback"))
    return strict.unionByName(reach)


QUERIES = {
    "registry_active": registry_active,
    "config_explode": config_explode,
    "apply_defaults": apply_defaults_query,
    "run_log_duration": run_log_duration,
    "run_log_append": run_log_append,
    "error_log_append": error_log_append,
    "run_summary": run_summary_query,
    "run_summary_wide": run_summary_wide_query,
    "error_count": error_count_query,
    "run_verdict": run_verdict_query,
    "late_data_policy": late_data_policy,
}


def _latest(run: str) -> str:
    return f"""
select run, status, rows_loaded from (
  select {run} as run, status, rows_loaded,
         row_number() over (partition by {run}, source_id order by ended_at desc nulls first, event_id desc) as rn
  from ({RUN_LOG_SQL}) l) a where rn = 1
"""


def _wide(run: str) -> str:
    return f"""
select run as dag_run_id, count(case when status = 'success' then 1 end) as success, count(case when status = 'failed' then 1 end) as failed,
       cast(coalesce(sum(case when status = 'success' then rows_loaded end), 0) as bigint) as rows_loaded
from ({_latest(run)}) b group by run
"""


def _late(policy: str, days: int) -> str:
    return f"""
select a.arrival_day, count(*) as arrived,
       count(case when ts > coalesce(low, timestamp '1970-01-01 00:00:00') - interval {days} day then 1 end) as picked_up,
       count(case when ts <= coalesce(low, timestamp '1970-01-01 00:00:00') - interval {days} day then 1 end) as missed,
       '{policy}' as policy
from arrivals a join marks m on a.arrival_day = m.arrival_day group by a.arrival_day
"""


ORACLES = {
    "registry_active": f"""
select source_id, source_name, base_url, endpoint_path, http_method, auth_type, auth_conn_id, query_params, target_bronze_table, load_type,
       watermark_column
from ({REGISTRY_SQL}) r where is_active and owning_dag = 'daily_pipeline'
""",
    "config_explode": """
select o_orderkey, o_orderpriority as symbol from orders union all select o_orderkey, o_orderstatus from orders
""",
    "apply_defaults": """
select event_id, coalesce(nullif(event_type, 'error'), 'GET') as http_method, value as load, 'daily_pipeline' as owning_dag from events
""",
    "run_log_duration": f"""
select event_id, source_id, status, (epoch_us(ended_at) - epoch_us(started_at)) / cast(1000000 as double) as duration_seconds
from ({RUN_LOG_SQL}) l
""",
    "run_log_append": f"""
select dag_run_id, task_id, source_id, status, rows_loaded, started_at, ended_at,
       (epoch_us(ended_at) - epoch_us(started_at)) / cast(1000000 as double) as duration_seconds
from ({RUN_LOG_SQL}) l
""",
    "error_log_append": """
select cast(cast(ts as date) as varchar) as dag_run_id, event_type as task_id, cast(user_id as integer) as source_id, props as error_message,
       cast(null as varchar) as error_traceback, ts as occurred_at
from events where event_type = 'error'
""",
    "run_summary": f"""
select run as dag_run_id, status, count(*) as task_count, cast(coalesce(sum(rows_loaded), 0) as bigint) as rows_loaded
from ({_latest("dag_run_id")}) b group by run, status
""",
    "run_summary_wide": _wide("dag_run_id"),
    "error_count": "select cast(cast(ts as date) as varchar) as dag_run_id, count(*) as error_count from events where event_type = 'error' group by 1",
    "run_verdict": f"""
select s.dag_run_id, success, failed, rows_loaded, coalesce(error_count, 0) as error_count,
       case when failed = 0 and coalesce(error_count, 0) = 0 then 'SUCCESS' else 'PARTIAL/TOTAL FAILURE' end as verdict, success >= 1 as proceed
from ({_wide("dag_run_id || '/' || task_id")}) s
left join (select cast(cast(ts as date) as varchar) || '/' || event_type as dag_run_id, count(*) as error_count
           from events where event_type = 'error' group by 1) e on s.dag_run_id = e.dag_run_id
""",
    "late_data_policy": f"""
with arrivals as (select ts, cast(ts as date) + case when event_type = 'error' then 3 else 0 end as arrival_day from events),
     marks as (select arrival_day, max(max(ts)) over (order by arrival_day rows between unbounded preceding and 1 preceding) as low
               from arrivals group by arrival_day)
{_late("strict", 0)} union all {_late("lookback", 2)}
""",
}
