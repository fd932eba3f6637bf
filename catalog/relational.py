"""Generic operators: newest row, averages, pivots, conforming, calendar, watermark, keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.frames import MICROS_PER_DAY, SHIFT_DAYS, average, average_sql, events, out, shifted, table
from tidemark import shared_path
from tidemark.functions import strict_cast, strip_suffix, utc_date
from tidemark.operators import (
    IncrementalTable,
    attach_calendar,
    conform,
    daily_averages,
    date_dim,
    date_dim_for,
    group_totals,
    insert_if_absent,
    latest_per_day,
    pivot_max,
    read_watermark,
    watermark_filter,
)
from tidemark.schemas import AMOUNT

CUT = dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc)
CUT_MICROS = int(CUT.timestamp()) * 1_000_000


def latest_per_entity_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_day(events(spark, sf_dir), ["user_id"], "extracted_date", "ts", ["event_id"])
    return out(newest.select("user_id", F.col("extracted_date").alias("captured_date"), "event_id", "ts", "value"), times=("ts",))


def latest_per_pair_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Order dates are midnights, so nearly every group is a tie.
    orders = table(spark, sf_dir, "orders").withColumn("captured_date", F.to_date("o_orderdate"))
    newest = latest_per_day(orders, ["o_orderstatus", "o_orderpriority"], "captured_date", "o_orderdate", ["o_orderkey"])
    return newest.select("o_orderstatus", "o_orderpriority", "captured_date", "o_orderkey", "o_totalprice")


def _closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = events(spark, sf_dir).select("extracted_date", "event_type", "value", "ts", "event_id")
    return latest_per_day(ticks, ["event_type"], "extracted_date", "ts", ["event_id"])


def daily_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    closes = _closes(spark, sf_dir).where(F.col("event_type") != "error")
    return closes.select(F.col("extracted_date").alias("d"), "event_type", F.col("value").alias("close_value"))


def daily_close_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"click": "click_close", "view": "view_close", "purchase": "purchase_close"}
    return pivot_max(_closes(spark, sf_dir), [F.col("extracted_date").alias("d")], "event_type", "value", columns)


def filtered_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    day = F.to_date("o_orderdate").alias("d")
    return pivot_max(orders, [day], "o_orderpriority", "o_totalprice", {"1-URGENT": "urgent", "2-HIGH": "high"})


def daily_avg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate"))
    averages = {"avg_qty": F.col("l_quantity").cast(AMOUNT), "avg_price": F.col("l_extendedprice").cast(AMOUNT)}
    return daily_averages(lines, "d", averages, entity="l_suppkey").withColumns({c: average(c) for c in averages})


def group_count_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("known_line", F.when(F.col("l_linestatus") != "F", F.col("l_linenumber")))
    return group_totals(lines, ["l_returnflag", "l_linestatus"], "line_count", {"known_lines": "known_line"})


def _daily_sides(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    readings = daily_averages(
        table(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate")), "d", {}, entity="l_suppkey"
    )
    ticks = events(spark, sf_dir).withColumn("d", F.date_sub("extracted_date", SHIFT_DAYS))
    rates = table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    return [
        readings,
        pivot_max(ticks, ["d"], "event_type", "value", {"click": "click_max"}),
        pivot_max(rates, ["d"], "o_orderpriority", "o_totalprice", {"1-URGENT": "urgent"}),
    ]


def conform_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_daily_sides(spark, sf_dir), "d", key_as="snapshot_date")


def conform_two_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both sides hold a NULL day, which must not match: returns without a day, errors without one.
    lines = table(spark, sf_dir, "lineitem").withColumn("d", F.when(F.col("l_returnflag") != "R", F.to_date("l_shipdate")))
    ticks = events(spark, sf_dir).withColumn("d", F.when(F.col("event_type") != "error", F.date_sub("extracted_date", SHIFT_DAYS)))
    readings = daily_averages(lines, "d", {}, entity="l_suppkey")
    return conform([readings, pivot_max(ticks, ["d"], "event_type", "value", {"click": "click_max"})], "d")


def date_dim_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = date_dim_for(table(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate")), "d")
    return dim.withColumns({c: F.col(c).cast("bigint") for c in ("year", "month", "day", "day_of_week")})


def fact_dim_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = group_totals(table(spark, sf_dir, "orders"), [F.to_date("o_orderdate").alias("d")], "n", {})
    dim = date_dim(spark, dt.date(1996, 1, 1), dt.date(2000, 1, 1))
    return attach_calendar(fact, dim, "d", ["is_weekend"])


def full_grain_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_type", "value", "ts")


def watermark_filter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = events(spark, sf_dir)
    loaded = read_watermark(source.where(F.col("ts") <= F.lit(CUT)), "ts")
    return out(watermark_filter(source, "ts", loaded).select("event_id", "event_type", "ts", "value"), times=("ts",))


def _tick_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "event_type", "ts", "value", "extracted_date")


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first build of placeholder values, then a load whose lookback replaces the last two days of them."""
    source = _tick_source(spark, sf_dir)
    ticks = IncrementalTable(
        shared_path(spark, "ticks"), ("event_id", "event_type", "ts"), "ts", lookback=dt.timedelta(days=2)
    )
    ticks.load(source.where(F.col("ts") <= F.lit(CUT)).withColumn("value", F.lit(-1.0)))
    ticks.load(source)
    return out(ticks.read(spark, source.schema).drop("extracted_date"), times=("ts",))


def incremental_upsert_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that do not tell the day: some events of a user turn out to have been two days later, others to be wrong."""
    source = _tick_source(spark, sf_dir)
    ticks = IncrementalTable(shared_path(spark, "ticks"), ("event_id",), "ts", day_filters=True)
    ticks.load(source)
    changed = source.where("event_id % 97 = 0")
    later = shifted(F.col("ts"), F.lit(2 * MICROS_PER_DAY))
    ticks.upsert(changed.where("event_id % 2 = 0").withColumns({"ts": later, "extracted_date": utc_date(later), "value": F.lit(-1.0)}))
    ticks.upsert(changed.where("event_id % 2 = 1").withColumn("value", F.lit(-2.0)))
    return out(ticks.read(spark, source.schema), times=("ts",))


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict watermark: three loads of a growing source give what one full build gives."""
    source = _tick_source(spark, sf_dir)
    ticks = IncrementalTable(shared_path(spark, "ticks"), ("event_id", "event_type", "ts"), "ts")
    ticks.load(source.where(F.col("ts") <= F.lit(CUT - dt.timedelta(days=10))))
    ticks.load(source.where(F.col("ts") <= F.lit(CUT)))
    ticks.load(source)
    return out(ticks.read(spark, source.schema).drop("extracted_date"), times=("ts",))


def insert_if_absent_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are registered; users of events register at their first event unless the id is taken."""
    registered = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_id"), F.col("s_name").alias("source_name"))
    batch = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("source_id"), F.col("event_type").alias("source_name"), "ts", "event_id"
    )
    added = insert_if_absent(batch, registered, ["source_id"], [F.col("ts").asc(), F.col("event_id").asc()])
    return registered.unionByName(added.select("source_id", "source_name"))


def strip_suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", strip_suffix(F.col("o_orderpriority"), "HIGH").alias("stem"))


def strict_cast_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a priced feed sends them: amounts as text.
    lines = table(spark, sf_dir, "lineitem").withColumn("as_text", F.col("l_extendedprice").cast("string"))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", strict_cast(F.col("as_text"), AMOUNT).cast("double").alias("price"))


QUERIES = {
    "latest_per_entity_day": latest_per_entity_day,
    "latest_per_pair_day": latest_per_pair_day,
    "daily_close": daily_close,
    "daily_close_pivot": daily_close_pivot,
    "filtered_pivot": filtered_pivot,
    "daily_avg_distinct": daily_avg_distinct,
    "group_count_sum": group_count_sum,
    "conform_full_outer": conform_full_outer,
    "conform_two_way": conform_two_way,
    "date_dim": date_dim_query,
    "fact_dim_left_join": fact_dim_left_join,
    "full_grain_project": full_grain_project,
    "watermark_filter": watermark_filter_query,
    "incremental_upsert": incremental_upsert,
    "incremental_append": incremental_append,
    "incremental_upsert_moved": incremental_upsert_moved,
    "insert_if_absent": insert_if_absent_query,
    "strip_suffix": strip_suffix_query,
    "strict_cast": strict_cast_query,
}

_CLOSE = """
select cast(ts as date) as d, event_type, value,
       row_number() over (partition by cast(ts as date), event_type order by ts desc nulls first, event_id desc) as rn
from events
"""

ORACLES = {
    "latest_per_entity_day": """
select user_id, captured_date, event_id, ts, value from (
  select user_id, cast(ts as date) as captured_date, event_id, ts, value,
         row_number() over (partition by user_id, cast(ts as date) order by ts desc nulls first, event_id desc) as rn
  from events) r where rn = 1
""",
    "latest_per_pair_day": """
select o_orderstatus, o_orderpriority, captured_date, o_orderkey, o_totalprice from (
  select o_orderstatus, o_orderpriority, o_orderkey, o_totalprice, cast(o_orderdate as date) as captured_date,
         row_number() over (partition by o_orderstatus, o_orderpriority, cast(o_orderdate as date)
                            order by o_orderdate desc nulls first, o_orderkey desc) as rn
  from orders) r where rn = 1
""",
    "daily_close": f"select d, event_type, value as close_value from ({_CLOSE}) r where rn = 1 and event_type <> 'error'",
    "daily_close_pivot": f"""
select d, max(case when event_type = 'click' then value end) as click_close,
          max(case when event_type = 'view' then value end) as view_close,
          max(case when event_type = 'purchase' then value end) as purchase_close
from ({_CLOSE}) r where rn = 1 group by d
""",
    "filtered_pivot": """
select cast(o_orderdate as date) as d,
       max(case when o_orderpriority = '1-URGENT' then o_totalprice end) as urgent,
       max(case when o_orderpriority = '2-HIGH' then o_totalprice end) as high
from orders where o_orderstatus = 'F' group by cast(o_orderdate as date)
""",
    "daily_avg_distinct": f"""
select cast(l_shipdate as date) as d, {average_sql("l_quantity")} as avg_qty, {average_sql("l_extendedprice")} as avg_price,
       count(distinct l_suppkey) as entities_reported
from lineitem group by cast(l_shipdate as date)
""",
    "group_count_sum": """
select l_returnflag, l_linestatus, count(*) as line_count,
       cast(coalesce(sum(case when l_linestatus <> 'F' then l_linenumber end), 0) as bigint) as known_lines
from lineitem group by l_returnflag, l_linestatus
""",
    "conform_full_outer": """
with w as (select cast(l_shipdate as date) as d, count(distinct l_suppkey) as entities_reported from lineitem group by 1),
     k as (select cast(ts as date) - 9131 as d, max(case when event_type = 'click' then value end) as click_max from events group by 1),
     f as (select cast(o_orderdate as date) as d, max(case when o_orderpriority = '1-URGENT' then o_totalprice end) as urgent
           from orders group by 1)
select coalesce(w.d, k.d, f.d) as snapshot_date, w.entities_reported, k.click_max, f.urgent
from w full outer join k on w.d = k.d full outer join f on coalesce(w.d, k.d) = f.d
""",
    "conform_two_way": """
with w as (select case when l_returnflag <> 'R' then cast(l_shipdate as date) end as d, count(distinct l_suppkey) as entities_reported
           from lineitem group by 1),
     k as (select case when event_type <> 'error' then cast(ts as date) - 9131 end as d,
                  max(case when event_type = 'click' then value end) as click_max from events group by 1)
select coalesce(w.d, k.d) as d, w.entities_reported, k.click_max from w full outer join k on w.d = k.d
""",
    "date_dim": """
select d as date_day, extract(year from d) as year, extract(month from d) as month, extract(day from d) as day,
       extract(dow from d) as day_of_week, dayname(d) as day_name, monthname(d) as month_name,
       extract(dow from d) in (0, 6) as is_weekend
from (select cast(unnest(generate_series(min(l_shipdate), max(l_shipdate), interval 1 day)) as date) as d from lineitem)
""",
    "fact_dim_left_join": """
select f.d, f.n, extract(dow from x.date_day) in (0, 6) as is_weekend
from (select cast(o_orderdate as date) as d, count(*) as n from orders group by 1) f
left join (select cast(unnest(generate_series(date '1996-01-01', date '1999-12-31', interval 1 day)) as date) as date_day) x on f.d = x.date_day
""",
    "full_grain_project": "select user_id, event_type, value, ts from events",
    "watermark_filter": """
select event_id, event_type, ts, value from events
where ts > (select coalesce(max(ts), timestamp '1970-01-01 00:00:00') from events where ts <= timestamp '2024-01-20 00:00:00')
""",
    "incremental_upsert": """
with target as (select event_id, event_type, ts, cast(-1 as double) as value from events where ts <= timestamp '2024-01-20 00:00:00'),
     delta as (select event_id, event_type, ts, value from events
               where ts > (select max(ts) - interval '2' day from target))
select event_id, event_type, ts, value from target t
where not exists (select 1 from delta x where x.event_id = t.event_id and x.event_type = t.event_type and x.ts = t.ts)
union all
select event_id, event_type, ts, value from delta
""",
    "incremental_upsert_moved": """
select event_id, event_type, case when moved then ts + interval 2 day else ts end as ts,
       case when moved then -1.0 when event_id % 97 = 0 then -2.0 else value end as value,
       cast(ts as date) + case when moved then 2 else 0 end as extracted_date
from (select *, event_id % 97 = 0 and event_id % 2 = 0 as moved from events) e
""",
    "incremental_append": "select event_id, event_type, ts, value from events",
    "insert_if_absent": """
select s_suppkey as source_id, s_name as source_name from supplier
union all
select source_id, source_name from (
  select user_id as source_id, event_type as source_name,
         row_number() over (partition by user_id order by ts, event_id) as rn
  from events) b
where rn = 1 and not exists (select 1 from supplier s where s.s_suppkey = b.source_id)
""",
    "strip_suffix": """
select o_orderkey, case when right(o_orderpriority, 4) = 'HIGH' then left(o_orderpriority, length(o_orderpriority) - 4)
                        else o_orderpriority end as stem
from orders
""",
    "strict_cast": "select l_orderkey, l_linenumber, l_partkey, l_extendedprice as price from lineitem",
}
