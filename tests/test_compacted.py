"""Merged logs: bounded reads, writers that die half-way, sketches of the days that changed."""

import datetime as dt

from vectorloom.operators.compacted import KeyedState
from vectorloom.operators.sketches import KeySketches, relative_error

STATE = "key string, value string, updated_at timestamp, version long"


def write(spark, key, value, at, version=0):
    when = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=at)
    return spark.createDataFrame([(key, value, when, version)], STATE).coalesce(1)


def values(state):
    return {r.key: r.value for r in state.read().collect()}


def test_reads_stay_bounded_and_newest_wins(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), every=4)
    assert values(state) == {} and state.sources() == []
    want = {}
    for i in range(18):
        key, at = f"k{i % 5}", 100 - i if i % 7 == 3 else 200 + i
        state.append(write(spark, key, f"v{i}", at))
        if key not in want or at > want[key][0]:
            want[key] = (at, f"v{i}")
        assert len(state.sources()) <= 4
    assert values(state) == {k: v for k, (_, v) in want.items()}
    assert len(list((tmp_path / "s").iterdir())) <= 10


def test_equal_times_go_by_version_and_null_values_count(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), every=2)
    for value, version in (("a", 1), (None, 3), ("b", 2)):
        state.append(write(spark, "k", value, 5, version))
    state.append(write(spark, None, "n", 5))
    assert values(state) == {"k": None, None: "n"}


def test_half_written_folders_do_not_count(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), every=9)
    for i in range(3):
        state.append(write(spark, "k", f"v{i}", i))
    (tmp_path / "s" / "base=00000003").mkdir()
    (tmp_path / "s" / "part=00000004").mkdir()
    assert values(state) == {"k": "v2"}
    assert state.append(write(spark, "k", "v5", 9)) == 5
    state.compact()
    assert values(state) == {"k": "v5"} and len(state.sources()) == 1
    state.compact()
    assert values(state) == {"k": "v5"}


def rows(spark, pairs):
    return spark.createDataFrame([(k, None if d is None else dt.date(2024, 1, d)) for k, d in pairs], "key string, day date")


def test_only_days_that_grew_are_sketched(spark, tmp_path):
    sketches = KeySketches(spark, str(tmp_path / "k"), every=2)
    first = [("a", 1), ("a", 1), ("b", 2), (None, 2), ("c", None)]
    assert sketches.refresh(rows(spark, first), "key", "day") == 3
    assert sketches.refresh(rows(spark, first), "key", "day") == 0
    assert sketches.refresh(rows(spark, [*first, ("d", 2), ("a", 3)]), "key", "day") == 2
    days = {r.day and r.day.day: (r.rows, r.total) for r in sketches.days().collect()}
    assert days == {1: (2, 2), 2: (3, 2), 3: (1, 1), None: (1, 1)}
    assert [tuple(r) for r in sketches.counts().collect()] == [(6, 4)]
    assert sketches.refresh(rows(spark, first), "key", "day", force=True) == 3


def test_an_empty_table_has_no_keys(spark, tmp_path):
    sketches = KeySketches(spark, str(tmp_path / "k"))
    assert sketches.refresh(rows(spark, []), "key", "day") == 0
    assert [tuple(r) for r in sketches.counts().collect()] == [(0, 0)]


def test_estimate_over_many_days(spark, tmp_path):
    sketches = KeySketches(spark, str(tmp_path / "k"))
    table = spark.range(60_000).selectExpr("id % 40000 AS key", "date_add(DATE'2024-01-01', CAST(id % 20 AS INT)) AS day")
    assert sketches.refresh(table, "key", "day") == 20
    got = sketches.counts().first()
    assert got.total == 60_000
    assert abs(got.distinct_keys - 40_000) <= 4 * relative_error() * 40_000
