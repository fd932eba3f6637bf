from __future__ import annotations

import datetime as dt
import json
import threading
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.frames import write_objects
from tidemark import shared_path
from tidemark.session import list_folder
from tidemark.sources.tables import write_build
from tidemark.plans.ingest import Warehouse, ingest_run, ingest_source, may_proceed, record_attempts
from tidemark.schemas import CITIES_CONFIG, LANDING, RAW_CRYPTO, RAW_FX, RAW_WEATHER, SYMBOLS_CONFIG
from tidemark.sources import (
    active_sources,
    append_bronze,
    apply_defaults,
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
    register_sources,
    route,
    write_archive,
)

AT = dt.datetime(2024, 1, 1, 23, 59, 59, 999999, tzinfo=dt.timezone.utc)


def landing(spark, source, *payloads):
    rows = [(f"{source}/{n}.json", source, AT, p if p is None or isinstance(p, str) else json.dumps(p)) for n, p in enumerate(payloads)]
    return spark.createDataFrame(rows, LANDING)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def reasons(parsed):
    return [r["reason"] for r in parsed.rejected.orderBy("object_key").collect()]


def ticker(symbol="BTCUSDT", price="1", change="0"):
    return {"symbol": symbol, "lastPrice": price, "priceChangePercent": change}


# -- crypto ---------------------------------------------------------------------


def test_crypto_rows(spark):
    polls = landing(spark, "crypto", [ticker("ADAUSDT", "0.75", "12"), ticker("USDTRY", "30"), ticker("XRPUSDT", "7", "-0.125")])
    rows = parse_crypto(polls).rows
    assert rows.columns == RAW_CRYPTO.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in RAW_CRYPTO]
    got = values(rows, "coin_id", "vs_currency", "price", "market_cap", "price_change_24h_pct")
    assert got[2] == ("XRP", "usdt", Decimal("7"), None, Decimal("-0.125"))
    assert [g[0] for g in got] == ["ADA", "USDTRY", "XRP"] and {g[1] for g in got} == {"usdt"}


def test_crypto_rows_share_capture_time_key_and_day(spark):
    rows = parse_crypto(landing(spark, "crypto", [ticker(), ticker("ETHUSDT")])).rows
    assert set(values(rows, F.unix_micros("captured_at"), "object_key", "extracted_date")) == {
        (int(AT.timestamp()) * 1_000_000 + 999_999, "crypto/0.json", dt.date(2024, 1, 1))
    }


def test_crypto_extra_fields_and_numbers_are_fine(spark):
    polls = landing(spark, "crypto", [{**ticker(), "lastPrice": 2.5, "volume": {"x": [1]}}], [])
    assert values(parse_crypto(polls).rows, "price") == [(Decimal("2.5"),)]


BAD_CRYPTO = [
    ([ticker(), {"symbol": "ETHUSDT", "lastPrice": "1"}], "required field missing"),
    ([ticker(), {**ticker(), "symbol": None}], "required field missing"),
    ([ticker(), None], "required field missing"),
    ([ticker(), ticker(price="n/a")], "number not readable"),
    (ticker(), "not an array of tickers"),
    ("{broken", "not an array of tickers"),
    ("", "not an array of tickers"),
    (None, "not an array of tickers"),
    ({"msg": "Too many requests"}, "not an array of tickers"),
]


def test_a_bad_ticker_rejects_its_whole_poll_only(spark):
    polls = landing(spark, "crypto", *[p for p, _ in BAD_CRYPTO], [ticker("SOLUSDT")])
    parsed = parse_crypto(polls, mode="quarantine")
    assert values(parsed.rows, "coin_id") == [("SOL",)]
    assert reasons(parsed) == [reason for _, reason in BAD_CRYPTO]


@pytest.mark.parametrize("payload, reason", BAD_CRYPTO)
def test_strict_mode_fails_on_a_bad_poll(spark, payload, reason):
    with pytest.raises(PySparkException, match=f"poll rejected: crypto/0.json: {reason}"):
        parse_crypto(landing(spark, "crypto", payload)).rows.collect()


def test_crypto_numbers_through_double(spark):
    polls = landing(spark, "crypto", [ticker(price="0.1234567890123456789")])
    assert values(parse_crypto(polls).rows, "price") == [(Decimal("0.123456789012345679"),)]
    assert values(parse_crypto(polls, as_double=True).rows, F.col("price").cast("double")) == [(0.12345678901234568,)]


# -- fx -------------------------------------------------------------------------


def test_fx_one_row_per_quote(spark):
    polls = landing(spark, "fx", {"rates": {"SEK": 11, "PLN": 4.5}, "base": "NOK", "date": "1999-12-31"})
    rows = parse_fx(polls).rows
    assert rows.columns == RAW_FX.names
    # The day is the capture day, not the published date.
    assert values(rows, "base_currency", "quote_currency", "rate", "extracted_date") == [
        ("NOK", "SEK", Decimal("11"), dt.date(2024, 1, 1)),
        ("NOK", "PLN", Decimal("4.5"), dt.date(2024, 1, 1)),
    ]


def test_fx_base_falls_back_to_settings_then_default(spark):
    polls = landing(spark, "fx", {"rates": {"GBP": 0.75}})
    assert values(parse_fx(polls, {"base": "CHF"}).rows, "base_currency") == [("CHF",)]
    assert values(parse_fx(polls).rows, "base_currency") == [("USD",)]


def test_fx_absent_or_empty_rates_give_no_rows(spark):
    parsed = parse_fx(landing(spark, "fx", {"rates": {}}, {"base": "USD"}, {}), mode="quarantine")
    assert parsed.rows.count() == 0 and reasons(parsed) == []


def test_fx_rejects(spark):
    cases = [
        ({"base": None, "rates": {"GBP": 1}}, "required field missing"),
        ({"rates": None}, "required field missing"),
        ({"rates": {"GBP": None, "EUR": 1}}, "number not readable"),
        ("oops", "not a rates object"),
        ([{"rates": {"GBP": 1}}], "not a rates object"),
        (None, "not a rates object"),
    ]
    parsed = parse_fx(landing(spark, "fx", *[p for p, _ in cases], {"rates": {"JPY": 150}}), mode="quarantine")
    assert reasons(parsed) == [reason for _, reason in cases]
    assert values(parsed.rows, "quote_currency") == [("JPY",)]


# -- weather --------------------------------------------------------------------


def city(name="Oslo", **changes):
    current = {"time": "2001-02-03T04:05", "temperature_2m": -6.5, "wind_speed_10m": 2.0, "weather_code": 71}
    current.update(changes)
    return {"city": name, "lat": 59.9, "lon": 10.75, "payload": {"current": {k: v for k, v in current.items() if v != "absent"}}}


def test_weather_rows(spark):
    rows = parse_weather(landing(spark, "weather", [city(), city("Lima", weather_code="absent", temperature_2m=19)])).rows
    assert rows.columns == RAW_WEATHER.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in RAW_WEATHER]
    got = values(rows, "city", "latitude", "longitude", "temperature_c", "windspeed_kmh", "weather_code", F.col("observed_at").cast("string"))
    assert got == [
        ("Oslo", Decimal("59.9"), Decimal("10.75"), Decimal("-6.5"), Decimal("2"), 71, "2001-02-03 04:05:00"),
        ("Lima", Decimal("59.9"), Decimal("10.75"), Decimal("19"), Decimal("2"), None, "2001-02-03 04:05:00"),
    ]


def test_weather_rejects(spark):
    cases = [
        [city(), city(temperature_2m="absent")],
        [city(time="t")],
        [{"city": "X", "lat": 1, "lon": 1, "payload": {}}],
        [{**city(), "lat": 5000}],
    ]
    parsed = parse_weather(landing(spark, "weather", *cases, [city("Oslo")], {"city": "X"}), mode="quarantine")
    assert reasons(parsed) == ["required field missing"] * 4 + ["not an array of cities"]
    assert values(parsed.rows, "city") == [("Oslo",)]


def test_a_payload_is_parsed_once(spark):
    plan = parse_crypto(landing(spark, "crypto", [ticker()]), mode="quarantine").rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and "Exchange" not in plan


# -- landing and bronze ---------------------------------------------------------


def polls(spark, *rows):
    return spark.createDataFrame(list(rows), "source_name string, captured_at timestamp, payload string")


def test_archive_round_trip_and_pruning(spark):
    root = shared_path(spark, "archive")
    text = '{"note": "line\\nbreak \\"quoted\\" é",\n "rates": {}}'
    keyed = write_archive(polls(spark, ("fx", AT, text), ("crypto", AT, "[]"), ("fx", AT + dt.timedelta(days=1), "{}")), root)
    back = read_archive(spark, root)
    order = ["object_key", "source_name", "captured_at", "payload"]
    assert sorted(values(back, *order)) == sorted(values(keyed, *order))
    one = back.where(F.col("source_name") == "fx")
    assert one.count() == 2
    assert "(source_name" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_structured_payloads_are_archived_as_json(spark):
    df = spark.range(1).select(F.lit("fx").alias("source_name"), F.lit(AT).alias("captured_at"), F.struct(F.lit("USD").alias("base")).alias("payload"))
    assert write_archive(df, shared_path(spark, "archive")).first()["payload"] == '{"base":"USD"}'


def test_landed_objects(spark, tmp_path):
    folder = tmp_path / "landing" / "crypto"
    folder.mkdir(parents=True)
    (folder / "20240101T235959999999Z.json").write_text(json.dumps([ticker(), ticker("ETHUSDT")], indent=2))
    df = read_landing(spark, str(tmp_path / "landing"))
    row = df.first()
    assert (row["object_key"], row["source_name"]) == ("crypto/20240101T235959999999Z.json", "crypto")
    assert df.select(F.unix_micros("captured_at")).first()[0] == int(AT.timestamp()) * 1_000_000 + 999_999
    assert values(route(df, "crypto").rows, "coin_id") == [("BTC",), ("ETH",)]


def test_files_of_polls_are_written_by_tasks(spark, monkeypatch):
    root = shared_path(spark, "objects")
    # Nothing of the polls may come to the driver.
    monkeypatch.setattr(DataFrame, "toLocalIterator", None)
    write_objects(spark, "/root/testdata/sf0.001", root, F.col("s_suppkey") < 40)
    names = list_folder(spark, f"{root}/crypto")
    suppliers = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet").where("s_suppkey < 40")
    assert len(names) == suppliers.count() and not [n for n in names if n.startswith(".")]
    kept = values(route(read_landing(spark, root), "crypto").rows, "coin_id", F.col("price").cast("double"))
    assert sorted(kept) == sorted(values(suppliers, "s_name", F.abs("s_acctbal")))


def test_bronze_only_grows_and_counts(spark):
    path = shared_path(spark, "raw_fx")
    rows = parse_fx(landing(spark, "fx", {"rates": {"GBP": 1, "EUR": 2}})).rows
    assert append_bronze(rows, path) == 2
    assert append_bronze(rows, path) == 2
    assert append_bronze(rows.where("false"), path) == 0
    assert read_bronze(spark, path, RAW_FX).count() == 4


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="feed 'nope' cannot be parsed"):
        route(landing(spark, "nope", "{}"), "nope")


def test_database_names():
    assert database_name("dev", None, production=True) == "dev"
    assert database_name("dev", " silver ", production=True) == "silver"
    assert database_name("dev", "silver", production=False) == "dev_silver"


def test_failed_rebuild_keeps_the_table(spark):
    root = shared_path(spark, "warehouse")
    name = materialize(spark.range(3), "trial_gold", "t", root)
    broken = spark.table(name).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        materialize(broken, "trial_gold", "t", root)
    assert spark.table(name).count() == 3
    materialize(spark.range(5).withColumn("p", F.col("id") % 2), "trial_gold", "t", root, partition_by=("p",))
    assert spark.table(name).where("p = 1").count() == 2


@pytest.mark.parametrize("partition_by", [(), ("p",)])
def test_readers_of_a_rebuilt_table_always_find_one_build(spark, partition_by):
    root, folder = shared_path(spark, "ware'house"), f"trial_swap/t{len(partition_by)}"
    name, seen, done = f"trial_swap.t{len(partition_by)}", [], threading.Event()

    def rows(build):
        return spark.range(40).select("id", F.lit(build).alias("build"), (F.col("id") % 2 + 2 * build).alias("p"))

    def read():
        while not done.is_set():
            seen.append([tuple(r) for r in spark.table(name).groupBy("build").count().collect()])

    materialize(rows(0), *name.split("."), root, partition_by)
    reader = threading.Thread(target=read)
    reader.start()
    for build in range(1, 5):
        materialize(rows(build), *name.split("."), root, partition_by)
    done.set()
    reader.join()
    assert seen and all(len(found) == 1 and found[0][1] == 40 for found in seen)
    assert {r["build"] for r in spark.table(name).collect()} == {4}
    # The build before the published one is kept for queries that began on it.
    assert len(list_folder(spark, f"{root}/{folder}")) == 2
    materialize(rows(5).withColumn("more", F.lit("x")), *name.split("."), root, partition_by)
    assert spark.table(name).where("build = 5 and more = 'x'").count() == 40


def test_builds_that_were_never_published_go_with_the_older_ones(spark):
    root = shared_path(spark, "warehouse")
    materialize(spark.range(3), "trial_lost", "t", root)
    write_build(spark.range(7), "trial_lost", "t", root)
    assert spark.table("trial_lost.t").count() == 3
    held = spark.table("trial_lost.t")
    materialize(spark.range(5), "trial_lost", "t", root)
    # The build published before is the one that is kept, not the one that came after it.
    assert spark.table("trial_lost.t").count() == 5 and held.count() in (3, 5)
    assert sorted(spark.read.parquet(f"{root}/trial_lost/t/{b}").count() for b in list_folder(spark, f"{root}/trial_lost/t")) == [3, 5]


# -- registry -------------------------------------------------------------------


@pytest.fixture
def registry(spark):
    return default_sources(spark, AT)


def test_active_sources(registry):
    assert values(active_sources(registry, "daily_pipeline"), "source_name") == [("weather",), ("fx",)]
    off = registry.withColumn("is_active", F.col("source_name") != "fx")
    assert values(active_sources(off, "daily_pipeline"), "source_name") == [("weather",)]


def test_settings_lists(registry):
    assert values(config_list(registry.where("source_name = 'fx'"), SYMBOLS_CONFIG, "symbols", "s"), "s") == [("GBP",), ("EUR",), ("JPY",)]
    cities = config_list(registry, CITIES_CONFIG, "cities", "c").select("source_id", "c.name", "c.lat")
    assert values(cities, "*") == [(1, "London", 51.5074), (1, "New York", 40.7128), (1, "Tokyo", 35.6895)]


def test_registering_again_changes_nothing(spark, registry):
    new = spark.createDataFrame([(7, "crypto", "x"), (9, "news", "later"), (8, "news", "first")], "source_id int, source_name string, base_url string")
    added = register_sources(registry, new, F.lit(AT))
    assert values(added.select("source_id", "source_name", "base_url"), "*") == [(8, "news", "first")]
    full = register_sources(registry, apply_defaults(new, {"http_method": "POST", "owning_dag": None}), F.lit(AT))
    assert full.first()["source_id"] == 8


def test_defaults_fill_nulls_and_absent_columns(spark):
    df = spark.createDataFrame([("POST",), (None,)], "http_method string")
    assert values(apply_defaults(df, {"http_method": "GET", "is_active": True}), "*") == [("POST", True), ("GET", True)]


# -- ingestion runs -------------------------------------------------------------


def source(name="fx", **changes):
    return {"source_id": 3, "source_name": name, "query_params": '{"base": "USD"}', "target_bronze_table": f"bronze.raw_{name}", **changes}


@pytest.fixture
def warehouse(spark):
    return Warehouse(shared_path(spark, "warehouse"))


FX = {"rates": {"GBP": 1, "EUR": 2}}


def test_a_run_loads_and_logs(spark, warehouse):
    times = iter([AT, AT + dt.timedelta(seconds=1.5)])
    attempt = ingest_source(source(), landing(spark, "fx", FX), warehouse, clock=lambda: next(times))
    record_attempts(spark, warehouse, "run-1", [attempt])
    log = spark.read.parquet(warehouse.run_log)
    assert values(log, "dag_run_id", "task_id", "source_id", "status", "rows_loaded", "duration_seconds") == [
        ("run-1", "extract_fx", 3, "success", 2, 1.5)
    ]


def test_a_failed_attempt_says_why(spark, warehouse):
    attempt = ingest_source(source(), landing(spark, "fx", FX, "oops"), warehouse)
    record_attempts(spark, warehouse, "run-1", [attempt])
    assert values(spark.read.parquet(warehouse.run_log), "status", "rows_loaded") == [("failed", None)]
    error = spark.read.parquet(warehouse.error_log).first()
    assert "poll rejected: fx/1.json" in error["error_message"] and "Traceback" in error["error_traceback"]


def test_a_log_that_cannot_be_written_is_no_secret(spark, warehouse, registry, monkeypatch):
    def boom(*args):
        raise ConnectionError("log unreachable")

    polls = landing(spark, "fx", FX).unionByName(landing(spark, "weather", [city()]))
    with monkeypatch.context() as patched, pytest.raises(ConnectionError):
        patched.setattr("tidemark.plans.ingest.append_run_log", boom)
        ingest_run(spark, registry, "daily_pipeline", polls, warehouse, "run-1")
    # The run is repeated and stores nothing twice.
    results = ingest_run(spark, registry, "daily_pipeline", polls, warehouse, "run-1")
    assert [r["rows_loaded"] for r in results] == [0, 0]
    assert read_bronze(spark, warehouse.table("bronze.raw_fx"), RAW_FX).count() == 2


def test_ingesting_again_adds_only_new_polls(spark, warehouse):
    for polls, rows in (([FX], 2), ([FX], 0), ([FX, {"rates": {"JPY": 3}}, "oops"], 1), ([FX, {"rates": {"JPY": 3}}, "oops"], 0)):
        assert ingest_source(source(), landing(spark, "fx", *polls), warehouse, mode="quarantine", clustered=True).rows_loaded == rows
    assert read_bronze(spark, warehouse.table("bronze.raw_fx"), RAW_FX).count() == 3
    assert spark.read.parquet(warehouse.table("rejected.fx")).count() == 1


def test_parallel_sources_are_all_logged(spark, warehouse):
    rows = [(n, f"feed{n}", "{}", f"bronze.raw_{n}") for n in range(8)]
    feeds = apply_defaults(spark.createDataFrame(rows, "source_id int, source_name string, query_params string, target_bronze_table string"), {"is_active": True, "owning_dag": "o"})
    feeds = feeds.selectExpr("*", *[f"cast(null as string) as {c}" for c in ("base_url", "endpoint_path", "http_method", "auth_type", "auth_conn_id", "load_type", "watermark_column")])
    for n in range(3):
        ingest_run(spark, feeds, "o", landing(spark, "fx", FX), warehouse, f"run-{n}")
    assert spark.read.parquet(warehouse.run_log).count() == 24
    assert "known feeds: crypto, fx, weather" in spark.read.parquet(warehouse.error_log).first()["error_message"]


def test_one_failing_source_does_not_stop_the_others(spark, warehouse, registry):
    both = landing(spark, "fx", FX).unionByName(landing(spark, "weather", "oops"))
    results = ingest_run(spark, registry, "daily_pipeline", both, warehouse, "run-1")
    assert [(r["source_name"], r["status"]) for r in results] == [("weather", "failed"), ("fx", "success")]
    assert may_proceed(results)
    assert not may_proceed([]) and not may_proceed(results[:1])
    assert ingest_run(spark, registry, "nobody", both, warehouse, "run-1") == []


def test_quarantine_keeps_rejected_polls(spark, warehouse):
    assert ingest_source(source(), landing(spark, "fx", FX, "oops"), warehouse, mode="quarantine").rows_loaded == 2
    assert values(spark.read.parquet(warehouse.table("rejected.fx")), "object_key", "payload") == [("fx/1.json", "oops")]
