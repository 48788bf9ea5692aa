"""The log of arrival messages: offsets, ranges, pieces, restarts."""

import gzip
import json
import uuid

import pytest
from pyspark.sql import functions as F

from vectorloom.functions.encoders import hashing_encoder
from vectorloom.operators.lake import Lake
from vectorloom.sources import message_log as source
from vectorloom.session import PLAIN_READS, small_buffers
from vectorloom.sources.message_log import MessageLog, _LogReader, file_pieces, message_log, piece_lines, piece_rooms
from vectorloom.streaming import medallion
from vectorloom.streaming.medallion import load_notified


def message(path):
    return json.dumps({"filepath": str(path), "filename": path.name}) + "\n"


def texts(reader, start, end):
    return [value for part in reader.partitions(start, end) for value, _, _ in reader.read(part)]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_offsets_are_places_in_the_log(tmp_path, size):
    reader = _LogReader({"path": f"file:{tmp_path}/log", "range_bytes": str(size)})
    start = reader.initialOffset()
    assert reader.latestOffset() == start and reader.partitions(start, start) == []
    (tmp_path / "log" / "0").mkdir(parents=True)
    (tmp_path / "log" / "_SUCCESS").write_text("")
    (tmp_path / "log" / "0" / ".a.crc").write_text("x\n")
    (tmp_path / "log" / "0" / "a").write_text("one\ntwo\n\nfour é\r\n")
    (tmp_path / "log" / "0" / "b").write_text("five\nsi")
    first = reader.latestOffset()
    assert first == {"segment": "0/b", "bytes": 5}
    assert texts(reader, start, first) == ["one", "two", "", "four é", "five"]
    with open(tmp_path / "log" / "0" / "b", "a") as file:
        file.write("x\n")
    (tmp_path / "log" / "1").write_text("seven\n")
    second = reader.latestOffset()
    assert texts(reader, first, second) == ["six", "seven"]
    assert texts(reader, start, second) == ["one", "two", "", "four é", "five", "six", "seven"]
    assert reader.partitions(second, second) == []


def test_last_segment_without_a_whole_line(tmp_path):
    (tmp_path / "a").write_text("x" * 200_000)
    reader = _LogReader({"path": str(tmp_path)})
    assert reader.latestOffset() == {"segment": "a", "bytes": 0}
    assert reader.partitions(reader.initialOffset(), reader.latestOffset()) == []


def messages_of(spark, *paths):
    return spark.createDataFrame([(message(p),) for p in paths] + [("junk",), (None,), ("{}",)], "value string")


@pytest.mark.parametrize("piece", [3, 32 << 20])
def test_pieces_give_every_line_once(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(source, "PIECE", piece)  # the size of a piece is chosen here, the tasks take what they are given
    lines = ["a", "", "bb ü", "c" * 50, "end"]
    (tmp_path / "x y%20+.jsonl").write_text("\n".join(lines))
    (tmp_path / "empty.jsonl").write_text("")
    (tmp_path / "folder").mkdir()
    with gzip.open(tmp_path / "z.jsonl.gz", "wt") as file:
        file.write("p\nq\n")
    names = ["x y%20+.jsonl", "x y%20+.jsonl", "empty.jsonl", "z.jsonl.gz", "folder", "gone.jsonl"]
    pieces = file_pieces(messages_of(spark, *[tmp_path / n for n in names]))
    assert {r.source_file for r in pieces.where("file_size IS NULL").collect()} == {"folder", "gone.jsonl"}
    found = piece_lines(pieces.where("file_size IS NOT NULL"))
    got = {}
    for r in found.orderBy("source_path", "source_pos").collect():
        got.setdefault(r.source_file, []).append(r.value)
    assert got == {"x y%20+.jsonl": lines, "z.jsonl.gz": ["p", "q"]}
    assert found.groupBy("source_path", "source_pos").count().where("count > 1").count() == 0


def test_load_goes_on_after_restarts(spark, tmp_path):
    name = uuid.uuid4().hex[:8]
    lake = Lake(spark, str(tmp_path / name), f"l{name}_", (16, 8, 4, 2)).create()
    folder, log = tmp_path / "in", tmp_path / "log"
    folder.mkdir(), log.mkdir()

    def run():
        load_notified(lake, message_log(spark, str(log)), hashing_encoder(16), str(tmp_path / "cp"), once=True, model_name="m").awaitTermination()
        return tuple(lake.read(n).count() for n in ("bronze", "silver", "gold", "rejects"))

    for i in (1, 2, 3):
        (folder / f"{i}.jsonl").write_text(json.dumps({"id": f"p{i}", "title": "T", "abstract": "words"}) + "\n")
    (log / "0").write_text(message(folder / "1.jsonl") + message(folder / "gone.jsonl"))
    assert run() == (1, 1, 1, 1)
    (log / "1").write_text(message(folder / "2.jsonl") + message(folder / "gone.jsonl") + message(folder / "1.jsonl"))
    assert run() == (2, 2, 2, 1)
    assert run() == (2, 2, 2, 1)
    (log / "2").write_text(message(folder / "also gone.jsonl"))
    assert run() == (2, 2, 2, 2)
    with open(log / "2", "a") as file:
        file.write(message(folder / "3.jsonl"))
    assert run() == (3, 3, 3, 2)
    rejects = lake.read("rejects").select("stage", "source_file", "reason").orderBy("source_file").collect()
    assert [tuple(r) for r in rejects] == [("files", "also gone.jsonl", "file not found"), ("files", "gone.jsonl", "file not found")]
    assert lake.read("runs").where(F.col("status") == "failed").count() == 0


def test_source_is_registered_by_name():
    assert MessageLog.name() == "message_log"


def test_files_are_read_by_many_tasks(spark, tmp_path):
    """Rows that name pieces are few bytes, the files behind them are not: they must not end up in one task."""
    for n in range(6):
        (tmp_path / f"{n}.jsonl").write_text(f"{n}\n")
    lines = piece_lines(file_pieces(messages_of(spark, *[tmp_path / f"{n}.jsonl" for n in range(6)])))
    found = lines.withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r.value for r in found) == [str(n) for n in range(6)]
    assert len({r.task for r in found}) == spark.sparkContext.defaultParallelism


def cut(pieces, size):
    """Pieces of unpacked files cut into smaller ones."""
    starts = F.when(F.col("end") < 1 << 40, F.sequence("start", F.col("end") - 1, F.lit(size).cast("long"))).otherwise(F.array("start"))
    rows = pieces.select("source_path", "source_file", "file_size", F.explode_outer(starts).alias("start"), F.col("end").alias("last"))
    end = F.when(F.col("last") < 1 << 40, F.least("last", F.col("start") + size)).otherwise(F.col("last"))
    return rows.select("source_path", "source_file", "file_size", "start", end.alias("end"))


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_rooms_are_found_at_the_ends_of_pieces(spark, tmp_path, size):
    for n, text in enumerate(["a\n\nbb \u00fc\nend", "a\nb\n", "\n", "x", "\n\n\n", "no line feed", ""]):
        (tmp_path / f"{n}.jsonl").write_text(text)
    with gzip.open(tmp_path / "z.jsonl.gz", "wt") as file:
        file.write("p\nlast\n")
    names = [*(f"{n}.jsonl" for n in range(7)), "z.jsonl.gz"]
    pieces = cut(file_pieces(messages_of(spark, *[tmp_path / n for n in names])), size)
    lines = piece_lines(pieces).groupBy("source_path").agg((F.max("source_pos") + 1).alias("room"))
    rooms = {tuple(r) for r in piece_rooms(pieces).collect()}
    assert len(rooms) == 7 and rooms == {tuple(r) for r in lines.collect()}


def test_a_long_last_line_starts_where_it_starts(spark, tmp_path):
    (tmp_path / "long.jsonl").write_text("a\n" + "x" * 200_000)
    (tmp_path / "one.jsonl").write_text("x" * 200_000 + "\n")
    rooms = piece_rooms(file_pieces(messages_of(spark, tmp_path / "long.jsonl", tmp_path / "one.jsonl"))).orderBy("source_path").collect()
    assert [r["room"] for r in rooms] == [3, 1]


def test_a_load_keeps_no_lines_and_reads_again_what_is_new(spark, tmp_path, monkeypatch):
    """Lines kept in executors filled their memory; pieces whose ids are all known are read once only."""
    kept, again, frame = [], [], type(spark.range(0))
    find = medallion.pieces_at

    def pieces_at(pieces, parts):
        again.append(sorted((r["source_file"], r["start"]) for r in find(pieces, parts).collect()))
        return find(pieces, parts)

    monkeypatch.setattr(frame, "persist", lambda self, *level: kept.append(self) or self)
    monkeypatch.setattr(medallion, "pieces_at", pieces_at)
    name = uuid.uuid4().hex[:8]
    lake = Lake(spark, str(tmp_path / name), f"l{name}_", (16, 8, 4, 2)).create()
    log = tmp_path / "log"
    log.mkdir()

    def record(key):
        return json.dumps({"id": key, "title": "T", "abstract": f"words of {key}"}) + "\n"

    files = {"a": record("1") + "junk\n\n" + record("2"), "b": record("2") + record("3"), "c": record("1") + record("3")}
    for n, text in files.items():
        (tmp_path / f"{n}.jsonl").write_text(text)
    half = len(record("1"))  # pieces of a line's length
    monkeypatch.setattr(medallion, "file_pieces", lambda messages: cut(file_pieces(messages), half))
    found = []
    for n, named in enumerate(("a", "ab", "abc")):
        (log / str(n)).write_text("".join(message(tmp_path / f"{x}.jsonl") for x in named))
        load_notified(lake, message_log(spark, str(log)), hashing_encoder(16), str(tmp_path / "cp"), once=True, model_name="m").awaitTermination()
        found.append({r["arxiv_id"]: (r["source_file"], r["id"]) for r in lake.read("bronze").collect()})
    assert not kept
    assert again == [[("a.jsonl", 0), ("a.jsonl", half)], [("b.jsonl", half)], []]
    first = {"1": ("a.jsonl", 1), "2": ("a.jsonl", half + 7)}
    # Ids go on after the highest in use, by file and place.
    assert found == [first, *[first | {"3": ("b.jsonl", half + 7 + (half + 6 + 1) + half + 1)}] * 2]
    runs = lake.read("runs").orderBy("started_at").select("bronze", "silver", "gold", "skipped", "status").collect()
    assert [tuple(r) for r in runs] == [(2, 2, 2, 1, "success"), (1, 1, 1, 1, "success"), (0, 0, 0, 1, "success")]


def test_buffers_are_small_for_a_while_only(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with small_buffers(spark):
        inside = {k: spark.conf.get(k) for k in (name, *PLAIN_READS)}
        with small_buffers(spark):
            pass
        assert inside == {k: spark.conf.get(k) for k in inside} == {name: str(4 << 20), **PLAIN_READS}
    assert spark.conf.get(name) == before and all(spark.conf.get(k, None) is None for k in PLAIN_READS)
