"""Full loads that replace all rows at once, incremental ones on top, archives and seeds."""

import pytest

from vectorloom.operators.snapshots import Snapshots
from vectorloom.sources.archive import archive_files, archive_name


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k long, v string").coalesce(1)


def seen(table, version=None):
    return sorted((r.k, r.v) for r in table.read(version).collect())


def test_full_and_incremental_loads(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    table.add(rows(spark, (1, "a"), (1, "b"), (2, "c")), ["k"], "v")
    assert seen(table) == [(1, "a"), (2, "c")]
    table.add(rows(spark, (2, "x"), (3, "d")), ["k"], "v")
    old = table.versions()[-1]
    assert seen(table) == [(1, "a"), (2, "c"), (3, "d")]
    table.full(rows(spark, (9, "z")))
    assert seen(table) == [(9, "z")] and seen(table, old) == [(1, "a"), (2, "c"), (3, "d")]
    table.add(rows(spark, (1, "n"), (9, "n")), ["k"], "v")
    assert seen(table) == [(1, "n"), (9, "z")]


def test_unfinished_loads_are_never_seen(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"))
    table.full(rows(spark, (1, "a")))
    # A load that wrote its part, and one that wrote a pointer without finishing it.
    rows(spark, (5, "half")).write.parquet(table._part(1, 1))
    rows(spark, (6, "half")).write.parquet(table._part(2, 0))
    (tmp_path / "t" / "pointer" / "000002").mkdir()
    assert seen(table) == [(1, "a")] and table.versions() == [1]
    table.add(rows(spark, (2, "b")), ["k"], "v")
    assert seen(table) == [(1, "a"), (2, "b")]
    table.full(rows(spark, (3, "c")))
    assert seen(table) == [(3, "c")] and table.parts() == [(3, 0)]


def test_old_snapshots_go(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"))
    for n in range(6):
        table.full(rows(spark, (n, "x")))
    assert table.expire(keep=3) == [1, 2] and seen(table) == [(5, "x")] and seen(table, 3) == [(2, "x")]
    assert table.expire(keep=3) == []


def test_archive_numbers_taken_names(spark, tmp_path):
    away = tmp_path / "away"
    for n in range(3):
        (tmp_path / f"d{n}").mkdir()
        (tmp_path / f"d{n}" / "a b.jsonl").write_text(str(n))
    paths = [str(tmp_path / f"d{n}" / "a b.jsonl") for n in range(3)]
    moved = archive_files(spark, paths + paths[:1], str(away))
    assert [m.rsplit("/", 1)[1] for m in moved] == ["a b.jsonl", "a b_1.jsonl", "a b_2.jsonl"]
    assert (away / "a b_2.jsonl").read_text() == "2" and not (tmp_path / "d0" / "a b.jsonl").exists()
    assert archive_name(spark, str(away), "plain") == f"{away}/plain"
