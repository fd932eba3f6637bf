from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark import shared_path
from tidemark.plans.build import Target
from tidemark.plans.daily import daily_run, verdict_of
from tidemark.plans.ingest import Warehouse, ingest_run
from tidemark.sources import default_sources

UTC = dt.timezone.utc
AS_OF = dt.datetime(2024, 1, 3, 12, tzinfo=UTC)
BROKEN = "{"


def at(day, hour):
    return dt.datetime(2024, 1, day, hour, tzinfo=UTC)


def weather(when, degrees):
    current = {"time": when.strftime("%Y-%m-%dT%H:%M"), "temperature_2m": degrees, "wind_speed_10m": 4}
    return ("weather", when, json.dumps([{"city": "London", "lat": 1, "lon": 2, "payload": {"current": current}}]))


def rates(when, gbp):
    return ("fx", when, json.dumps({"base": "USD", "rates": {"GBP": gbp}}))


def landing(spark, *polls):
    df = spark.createDataFrame(polls, "source_name string, captured_at timestamp, payload string")
    name = F.concat_ws("/", "source_name", F.date_format("captured_at", "yyyyMMddHH"))
    return df.withColumns({"object_key": name, "extracted_date": F.to_date("captured_at")})


@pytest.fixture
def day(spark):
    """Runs of one warehouse in an environment of its own."""
    warehouse = Warehouse(shared_path(spark, "daily"))
    target = Target(f"dev{uuid.uuid4().hex[:8]}")
    registry = default_sources(spark, at(1, 0))

    def run(run_id, polls, retries=0):
        return daily_run(spark, registry, polls, warehouse, run_id, AS_OF, target=target, retries=retries)

    run.warehouse, run.gold = warehouse, lambda: spark.table(f"{target.database('gold')}.fct_market_snapshot")
    return run


def stored(day):
    return [(r["snapshot_date"].day, r["avg_temperature_c"] and float(r["avg_temperature_c"])) for r in day.gold().orderBy("snapshot_date").collect()]


def test_a_clean_day_is_published(spark, day):
    ingest_run(spark, default_sources(spark, at(1, 0)), "crypto_realtime_pipeline", landing(spark), day.warehouse, "ticks")
    done = day("one", landing(spark, weather(at(3, 8), 5), rates(at(1, 9), 0.8)))
    assert (done.proceeded, done.verdict, done.success, done.failed, done.rows_loaded, done.error_count) == (True, "SUCCESS", 2, 0, 2, 0)
    assert done.freshness == {"raw_weather": "pass", "raw_fx": "error", "raw_crypto": "error"} and done.stale == ["raw_crypto", "raw_fx"]
    assert stored(day) == [(1, None), (3, 5.0)] and done.tables.fct_market_snapshot.count() == 2
    # Repeating a run stores nothing twice.
    again = day("one again", landing(spark, weather(at(3, 8), 5), rates(at(1, 9), 0.8)))
    assert (again.verdict, again.rows_loaded) == ("SUCCESS", 0) and stored(day) == [(1, None), (3, 5.0)]


def test_one_source_is_enough_and_none_stops_the_day(spark, day):
    lost = day("lost", landing(spark, ("weather", at(3, 8), BROKEN), ("fx", at(3, 8), BROKEN)))
    assert (lost.proceeded, lost.success, lost.failed, lost.error_count, lost.tables) == (False, 0, 2, 2, None)
    part = day("part", landing(spark, weather(at(2, 8), 4), ("fx", at(3, 8), BROKEN)), retries=1)
    assert (part.proceeded, part.verdict, part.success, part.failed, part.error_count) == (True, "PARTIAL/TOTAL FAILURE", 1, 1, 2)
    assert stored(day) == [(2, 4.0)]


def test_lost_sources_are_tried_again(spark, day):
    lists = iter([landing(spark, weather(at(2, 8), 4), ("fx", at(2, 9), BROKEN)), landing(spark, weather(at(2, 8), 4), rates(at(2, 9), 0.7))])
    done = day("retry", lambda: next(lists), retries=3)
    # The last attempt decides about a source, but its errors stay counted.
    assert (done.proceeded, done.success, done.failed, done.rows_loaded, done.error_count) == (True, 2, 0, 2, 1)
    assert done.tables.fct_market_snapshot.where("usd_to_gbp = 0.7").count() == 1


def test_a_broken_contract_leaves_published_tables_alone(spark, day):
    assert day("one", landing(spark, weather(at(1, 8), 5), rates(at(1, 9), 0.8))).violation is None
    done = day("two", landing(spark, weather(at(2, 8), 99)))
    assert done.proceeded and done.tables is None and "stg_weather.temperature_c" in done.violation
    assert verdict_of(spark, day.warehouse, "two")["verdict"] == "PARTIAL/TOTAL FAILURE" and done.error_count == 1
    assert stored(day) == [(1, 5.0)]


def test_a_run_without_sources_does_not_go_on(spark, day):
    none = default_sources(spark, at(1, 0)).withColumn("is_active", F.lit(False))
    done = daily_run(spark, none, landing(spark), day.warehouse, "none", AS_OF)
    assert (done.proceeded, done.success, done.failed, done.tables) == (False, 0, 0, None)
