from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import (
    archive_key,
    config_fallback,
    duration_seconds,
    key_captured_at,
    key_source,
    parse_utc,
    strict_cast,
    strip_suffix,
    utc_date,
)

UTC = dt.timezone.utc
FEW = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata", "Pacific/Apia"])
def zoned(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def values(df):
    return [tuple(row) for row in df.collect()]


def micros(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "m bigint").select(F.timestamp_micros("m").alias("t"), "m")


def epoch(text):
    moment = dt.datetime.fromisoformat(text).replace(tzinfo=UTC)
    return (moment - dt.datetime(1970, 1, 1, tzinfo=UTC)) // dt.timedelta(microseconds=1)


EDGES = ["2023-12-31T23:59:59.999999", "2024-01-01T00:00:00", "2024-03-10T02:30:00.000001", "2024-11-03T05:30:00", "1969-12-31T23:59:59.5"]


def test_utc_day_in_any_session_zone(zoned):
    df = micros(zoned, *[epoch(e) for e in EDGES]).select(utc_date(F.col("t")).cast("string"))
    assert values(df) == [(e[:10],) for e in EDGES]


def test_archive_key_in_any_session_zone(zoned):
    df = micros(zoned, *[epoch(e) for e in EDGES])
    keyed = df.select("t", archive_key(F.lit("fx"), F.col("t")).alias("k")).cache()
    assert keyed.first()["k"] == "fx/20231231T235959999999Z.json"
    assert keyed.where(key_captured_at(F.col("k")) == F.col("t")).count() == len(EDGES)
    assert ":" not in "".join(row["k"] for row in keyed.collect())


def test_key_parts_of_a_path(spark):
    df = spark.createDataFrame(
        [("file:/lake/landing/crypto/20240101T000500000000Z.json",), ("not a key",)], "k string"
    ).select(key_source(F.col("k")), key_captured_at(F.col("k")).cast("string"))
    assert values(df) == [("crypto", "2024-01-01 00:05:00"), (None, None)]


@FEW
@given(st.lists(st.integers(min_value=-(10**15), max_value=4 * 10**15), min_size=1, max_size=30))
def test_utc_day_matches_integer_division(spark, numbers):
    df = micros(spark, *numbers).select("m", F.unix_date(utc_date(F.col("t"))).alias("d"))
    assert all(row["d"] == row["m"] // 86_400_000_000 for row in df.collect())


def test_parse_utc(zoned):
    cases = {
        "2026-09-29T10:45": "2026-09-29T10:45:00",
        "2026-09-29T10:45:30": "2026-09-29T10:45:30",
        "2026-09-29T10:45:30.25": "2026-09-29T10:45:30.25",
        "2026-09-29T10:45Z": "2026-09-29T10:45:00",
        "2026-09-29T10:45+02:00": "2026-09-29T08:45:00",
        "2026-09-29 10:45:00-01": "2026-09-29T11:45:00",
        "2026-09-29": "2026-09-29T00:00:00",
        "t": None,
        "": None,
        None: None,
    }
    df = zoned.createDataFrame([(c,) for c in cases], "a string").select(F.unix_micros(parse_utc(F.col("a"))))
    assert values(df) == [(None if v is None else epoch(v),) for v in cases.values()]


def test_strip_suffix(spark):
    df = spark.createDataFrame([("BTCUSDT",), ("BTCEUR",), ("USDT",), ("USDTUSDT",), ("usdt",), (None,)], "s string")
    assert values(df.select(strip_suffix(F.col("s"), "USDT"))) == [("BTC",), ("BTCEUR",), ("",), ("USDT",), ("usdt",), (None,)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_cast_fails_on_bad_text_only(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("65000.50",), (None,)], "s string")
        assert [row[0] and float(row[0]) for row in df.select(strict_cast(F.col("s"), "decimal(38,18)")).collect()] == [65000.5, None]
        bad = spark.createDataFrame([("n/a",)], "s string").select(strict_cast(F.col("s"), "double"))
        with pytest.raises(PySparkException, match="cannot read as double: n/a"):
            bad.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_config_fallback(spark):
    df = spark.createDataFrame([("EUR", "CHF"), (None, "CHF"), (None, None)], "p string, c string")
    assert values(df.select(config_fallback(F.col("p"), F.col("c"), "USD"))) == [("EUR",), ("CHF",), ("USD",)]
    assert values(df.select(config_fallback(F.col("p"), None, "USD"))) == [("EUR",), ("USD",), ("USD",)]


def test_duration_keeps_microseconds(spark):
    df = micros(spark, 0).select(duration_seconds(F.col("t"), F.timestamp_micros(F.lit(1_500_001))))
    assert values(df) == [(1.500001,)]
