from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import shared_path
from tidemark.functions import utc_date
from tidemark.operators import incremental
from tidemark.operators.day_filters import DayFilters
from tidemark.operators import IncrementalTable, late_data_report, replace_matching
from tidemark.operators.incremental import _DONE, _STAGED
from tidemark.session import path_exists

HOUR = 3_600_000_000
FEW = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCHEMA = "coin string, hour bigint, price int"


def frame(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    at = F.timestamp_micros(F.col("hour") * HOUR)
    return df.select("coin", at.alias("captured_at"), "price", utc_date(at).alias("extracted_date"))


def table(spark, **options) -> IncrementalTable:
    return IncrementalTable(shared_path(spark, "t"), ("coin", "captured_at"), "captured_at", **options)


def content(spark, t, source):
    stored = t.read(spark, source.schema)
    hours = stored.select("coin", (F.unix_micros("captured_at") / HOUR).cast("int"), "price")
    return sorted(tuple(r) for r in hours.collect())


HOURS = [("BTC", h, h) for h in range(1, 60, 7)]


def test_first_run_builds_and_second_adds_nothing(spark):
    source = frame(spark, HOURS)
    t = table(spark)
    assert t.load(source)["mode"] == "build"
    assert t.load(source)["mode"] == "none"
    assert content(spark, t, source) == HOURS


@FEW
@given(st.lists(st.integers(1, 100), min_size=1, max_size=25, unique=True), st.lists(st.integers(1, 100), min_size=1, max_size=3))
def test_slices_equal_a_full_build(spark, hours, cuts):
    data = [("BTC", h, h) for h in sorted(hours)]
    t = table(spark)
    for cut in [*sorted(cuts), 100]:
        slice_ = [row for row in data if row[1] <= cut]
        if slice_:
            t.load(frame(spark, slice_))
    assert content(spark, t, frame(spark, data)) == data


def test_strict_watermark_loses_late_rows_and_lookback_finds_them(spark):
    first, late = [("BTC", 30, 1)], [("ETH", 30, 2), ("ETH", 29, 3), ("BTC", 31, 4)]
    strict, reach = table(spark), table(spark, lookback=dt.timedelta(hours=2))
    for t in (strict, reach):
        t.load(frame(spark, first))
        t.load(frame(spark, first + late))
    assert content(spark, strict, frame(spark, first)) == [("BTC", 30, 1), ("BTC", 31, 4)]
    assert content(spark, reach, frame(spark, first)) == sorted(first + late)


def test_lookback_replaces_by_key_and_keeps_the_rest(spark):
    t = table(spark, lookback=dt.timedelta(hours=5))
    t.load(frame(spark, [("BTC", 20, 1), ("BTC", 26, 1), ("ETH", 27, 1)]))
    t.load(frame(spark, [("BTC", 20, 9), ("BTC", 26, 9), ("BTC", 28, 9)]))
    assert content(spark, t, frame(spark, HOURS)) == [("BTC", 20, 1), ("BTC", 26, 9), ("BTC", 28, 9), ("ETH", 27, 1)]


def test_repeats_within_a_load_are_kept_unless_asked(spark):
    data = [("BTC", 5, 1), ("BTC", 5, 2)]
    plain, deduped = table(spark), table(spark, dedupe_by=("price",))
    for t in (plain, deduped):
        t.load(frame(spark, [("BTC", 1, 0)]))
        t.load(frame(spark, [("BTC", 1, 0), *data]))
    assert content(spark, plain, frame(spark, data)) == [("BTC", 1, 0), *data]
    assert content(spark, deduped, frame(spark, data)) == [("BTC", 1, 0), ("BTC", 5, 2)]


class Lost(Exception):
    pass


def _fail(*args, **kwargs):
    raise Lost


@pytest.mark.parametrize("lookback", [0, 30])
def test_a_load_lost_before_the_swap_is_finished_by_the_next(spark, monkeypatch, lookback):
    t = table(spark, lookback=dt.timedelta(hours=lookback))
    old = [("BTC", h, 0) for h in (1, 30, 50)]
    new = old + [("BTC", h, 0) for h in (55, 60, 80)]
    t.load(frame(spark, old))
    with monkeypatch.context() as patch:
        patch.setattr(t, "_move_in", _fail)
        with pytest.raises(Lost):
            t.load(frame(spark, new))
    assert t.last_load(spark)["phase"] == _STAGED
    assert content(spark, t, frame(spark, old)) == old
    t.load(frame(spark, new))
    assert t.last_load(spark)["phase"] == _DONE
    assert content(spark, t, frame(spark, new)) == new


def test_a_load_lost_during_the_swap_is_finished_by_the_next(spark, monkeypatch):
    """Only the newest day was swapped in: the table's own maximum would hide the missing day."""
    t = table(spark)
    old, new = [("BTC", 10, 0)], [("BTC", 10, 0), ("BTC", 12, 0), ("BTC", 60, 0)]
    t.load(frame(spark, old))
    whole = t._move_in

    def newest_only(spark, staged, load_no, folders, replace):
        whole(spark, staged, load_no, [f for f in folders if f.endswith("1970-01-03")], replace)
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(t, "_move_in", newest_only)
        with pytest.raises(Lost):
            t.load(frame(spark, new))
    assert content(spark, t, frame(spark, old)) == [("BTC", 10, 0), ("BTC", 60, 0)]
    t.load(frame(spark, new))
    assert content(spark, t, frame(spark, new)) == new


@pytest.mark.parametrize("lost_at", ["rename", "remove", "record"])
def test_a_rewrite_lost_at_any_step_is_finished_by_the_next(spark, monkeypatch, lost_at):
    t = table(spark)
    t.load(frame(spark, HOURS))
    change = [("BTC", 1, 100), ("BTC", 29, 5)]
    done = sorted([r for r in HOURS if r[1] not in (1, 29)] + change)
    calls = {"rename": "move_files", "remove": "remove_path"}

    def second(function, seen=[]):
        def run(*args):
            seen.append(args)
            if len(seen) == 2 and (lost_at != "remove" or "staged" not in args[1]):
                raise Lost
            return function(*args)

        return run

    with monkeypatch.context() as patch:
        if lost_at == "record":
            patch.setattr(t, "_record", second(t._record, []))
        else:
            patch.setattr(incremental, calls[lost_at], second(getattr(incremental, calls[lost_at]), []))
        with pytest.raises(Lost):
            t.upsert(frame(spark, change))
    t.upsert(frame(spark, change))
    assert content(spark, t, frame(spark, HOURS)) == done


def test_a_strict_load_leaves_stored_files_as_they_are(spark):
    t = table(spark)
    t.load(frame(spark, [("BTC", 1, 0), ("BTC", 25, 0)]))

    def files():
        return {(p, p.stat().st_mtime_ns) for p in Path(t.path.removeprefix("file:")).rglob("*.parquet")}

    before = files()
    assert t.load(frame(spark, [("BTC", 25, 0), ("ETH", 26, 0), ("BTC", 50, 0)]))["rewritten"] is False
    assert before < files()
    assert content(spark, t, frame(spark, HOURS)) == [("BTC", 1, 0), ("BTC", 25, 0), ("BTC", 50, 0), ("ETH", 26, 0)]
    assert not path_exists(spark, f"{t.log_path}/staged/load=2")


def test_a_batch_is_added_once(spark, monkeypatch):
    t = table(spark)
    first, second = frame(spark, [("BTC", 5, 0), ("BTC", 30, 0)]), frame(spark, [("BTC", 3, 0), ("ETH", 31, 0)])
    t.append(first, "0")
    assert t.append(first, "0")["mode"] == "none"
    whole = t._move_in

    def part(spark, staged, load_no, folders, replace):
        whole(spark, staged, load_no, folders[:1], replace)
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(t, "_move_in", part)
        with pytest.raises(Lost):
            t.append(second, "1")
    t.append(second, "1")
    assert content(spark, t, first) == [("BTC", 3, 0), ("BTC", 5, 0), ("BTC", 30, 0), ("ETH", 31, 0)]
    assert t.last_load(spark)["watermark_micros"] == 31 * HOUR


def test_a_load_lost_while_staging_changed_nothing(spark, monkeypatch):
    t = table(spark)
    t.load(frame(spark, HOURS[:3]))
    with monkeypatch.context() as patch:
        patch.setattr(t, "_replace_all", _fail)
        with pytest.raises(Lost):
            t.load(frame(spark, HOURS))
    t.load(frame(spark, HOURS))
    assert content(spark, t, frame(spark, HOURS)) == HOURS


def test_a_lost_first_build_starts_over(spark, monkeypatch):
    t = table(spark)
    whole = t._replace_all

    def part(df, path):
        whole(df.where(F.col("extracted_date") > F.lit(dt.date(1970, 1, 1))), path)
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(t, "_replace_all", part)
        with pytest.raises(Lost):
            t.load(frame(spark, HOURS))
    assert t.load(frame(spark, HOURS))["mode"] == "build"
    assert content(spark, t, frame(spark, HOURS)) == HOURS


def test_an_adopted_table_starts_from_its_newest_row(spark):
    t = table(spark)
    frame(spark, HOURS[:4]).write.partitionBy("extracted_date").parquet(t.path)
    assert t.load(frame(spark, HOURS))["mode"] == "increment"
    assert content(spark, t, frame(spark, HOURS)) == HOURS


def test_upsert_twice_is_upsert_once(spark):
    t = table(spark)
    t.load(frame(spark, HOURS))
    change = [("BTC", 8, 100), ("SOL", 9, 5)]
    once = sorted([r for r in HOURS if r[1] != 8] + change)
    for _ in range(2):
        t.upsert(frame(spark, change))
        assert content(spark, t, frame(spark, HOURS)) == once


def test_upsert_does_not_move_the_watermark_back(spark):
    t = table(spark)
    t.load(frame(spark, HOURS))
    assert t.upsert(frame(spark, [("SOL", 9, 5)]))["watermark_micros"] == HOURS[-1][1] * HOUR


def test_replace_matching_keeps_null_keys(spark):
    target = spark.createDataFrame([(None, 1), (1, 1), (2, 1)], "k int, v int")
    delta = spark.createDataFrame([(None, 2), (1, 2)], "k int, v int")
    got = sorted((tuple(r) for r in replace_matching(target, delta, ["k"]).collect()), key=repr)
    assert got == [(1, 2), (2, 1), (None, 1), (None, 2)]


def test_late_report_agrees_with_real_loads(spark):
    # (event hour, arrival day); the load of a day sees all that arrived up to that day.
    arrivals = [(5, 0), (20, 0), (30, 1), (19, 1), (20, 1), (50, 2), (29, 2), (31, 2)]
    t = table(spark)
    picked = {}
    for day in range(3):
        seen = [("BTC", hour, n) for n, (hour, arrived) in enumerate(arrivals) if arrived <= day]
        before = len(content(spark, t, frame(spark, seen))) if day else 0
        t.load(frame(spark, seen))
        picked[day] = len(content(spark, t, frame(spark, seen))) - before
    df = spark.createDataFrame(arrivals, "hour bigint, day int").withColumn("t", F.timestamp_micros(F.col("hour") * HOUR))
    report = {r["day"]: (r["picked_up"], r["missed"]) for r in late_data_report(df, "t", "day").collect()}
    assert report == {0: (2, 0), 1: (1, 2), 2: (2, 1)}
    assert {day: n for day, (n, _) in report.items()} == picked


def test_an_event_moved_to_another_day_replaces_the_old_one(spark):
    table = IncrementalTable(shared_path(spark, "moved"), ["id"], "at", "day")

    def rows(*data):
        df = spark.createDataFrame([(n, v, d) for n, v, d in data], "id int, v string, d string")
        return df.select("id", "v", F.to_timestamp("d").alias("at"), F.to_date("d").alias("day"))

    table.load(rows((1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2024-01-02")))
    table.upsert(rows((1, "new", "2024-01-03"), (2, "new", "2024-01-01")))
    got = sorted((r["id"], r["v"], str(r["day"])) for r in table.read(spark).collect())
    assert got == [(1, "new", "2024-01-03"), (2, "new", "2024-01-01"), (3, "c", "2024-01-02")]
    # A day may lose all its rows.
    table.upsert(rows((3, "d", "2024-01-03")))
    assert sorted((r["id"], str(r["day"])) for r in table.read(spark).collect()) == [(1, "2024-01-03"), (2, "2024-01-01"), (3, "2024-01-03")]
    assert not path_exists(spark, f"{table.log_path}/staged/load=2")


def test_rows_without_a_watermark_are_kept(spark):
    table = IncrementalTable(shared_path(spark, "untimed"), ["id"], "at", "day")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, None)], "id int, d string")
    rows = df.select("id", F.to_timestamp("d").alias("at"), F.to_date("d").alias("day"))
    table.load(rows.where("id = 1"))
    table.upsert(rows)
    table.upsert(rows.where("at is null"))
    assert sorted(r["id"] for r in table.read(spark, rows.schema).collect()) == [1, 2]


def orders(spark, data):
    df = spark.createDataFrame(data, "id int, v string, d int")
    at = F.timestamp_micros((F.col("d") * 24 * HOUR + F.col("id")).cast("long"))
    return df.select("id", "v", at.alias("at"), utc_date(at).alias("day"))


def by_id(spark, t):
    return sorted((r["id"], r["v"], r["day"].day - 1) for r in t.read(spark).collect())


def test_filters_open_only_days_that_may_hold_the_keys(spark, monkeypatch):
    plain, filtered = (IncrementalTable(shared_path(spark, "o"), ["id"], "at", "day", day_filters=f) for f in (False, True))
    first = [(i, "a", i % 20) for i in range(400)]
    changes = [
        [(7, "b", 21), (401, "b", 3)],  # one moves, one is new
        [(7, "c", 1), (12, "c", 12), (500, "c", 25)],  # moves back, stays, new
        [(500, "d", 4)],  # the only row of its day goes
        [(401, "e", 5), (7, "e", 2)],
    ]
    for t in (plain, filtered):
        t.load(orders(spark, first))
    opened = []
    whole = DayFilters.candidates

    def watched(self, *args):
        opened.append(whole(self, *args))
        return opened[-1]

    monkeypatch.setattr(DayFilters, "candidates", watched)
    state = {i: (i, v, d) for i, v, d in first}
    for change in changes:
        for t in (plain, filtered):
            t.upsert(orders(spark, change))
        state |= {row[0]: row for row in change}
        assert by_id(spark, filtered) == by_id(spark, plain) == sorted(state.values())
    # The days that do hold the keys, and now and then one that passes by chance.
    held = [{8}, {13, 22}, {26}, {4, 2}]
    for found, days in zip(opened, held, strict=True):
        assert {f"day=1970-01-{d:02d}" for d in days} <= set(found) and len(found) <= len(days) + 3


def test_filters_of_a_lost_load_do_not_count(spark, monkeypatch):
    t = IncrementalTable(shared_path(spark, "o"), ["id"], "at", "day", day_filters=True)
    t.load(orders(spark, [(1, "a", 1), (2, "a", 1), (3, "a", 2)]))
    with monkeypatch.context() as patch:
        patch.setattr(t, "_record", _fail)
        with pytest.raises(Lost):
            t.upsert(orders(spark, [(1, "b", 3)]))
    # The lost load had taken 1 out of its day.
    t.upsert(orders(spark, [(1, "c", 4)]))
    assert by_id(spark, t) == [(1, "c", 4), (2, "a", 1), (3, "a", 2)]


def test_days_without_filters_are_opened(spark):
    path = shared_path(spark, "o")
    IncrementalTable(path, ["id"], "at", "day").load(orders(spark, [(1, "a", 1), (2, "a", 2)]))
    t = IncrementalTable(path, ["id"], "at", "day", day_filters=True)
    t.append(orders(spark, [(3, "a", 2), (4, "a", 5)]), "1")
    t.upsert(orders(spark, [(1, "b", 3), (3, "b", 3), (4, "b", 6)]))
    assert by_id(spark, t) == [(1, "b", 3), (2, "a", 2), (3, "b", 3), (4, "b", 6)]
