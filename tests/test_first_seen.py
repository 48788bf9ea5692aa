"""State kept per id: winners within and between batches, restarts, and what a batch reads."""

import json

from vectorloom.sources.lines import stream_lines
from vectorloom.streaming.first_seen import STORE, first_seen, state_session, write_first_seen


def drop(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(x + "\n" for x in lines))


def paper(i, note):
    return json.dumps({"id": f"p{i}", "title": note, "abstract": "x"})


def winners(spark, out):
    return {r.arxiv_id: json.loads(r.raw_data)["title"] for r in spark.read.parquet(out).collect()}


def run(spark, folder, tmp_path, **options):
    session = state_session(spark)
    query = write_first_seen(stream_lines(session, str(folder), **options), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    return query


def test_first_line_wins_within_a_batch_and_between_runs(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "a.jsonl", [paper(1, "a1"), paper(2, "a2"), "junk", "", paper(1, "a3")])
    drop(folder, "b.jsonl", [paper(2, "b1"), paper(3, "b2"), '{"title": "no id"}'])
    run(spark, folder, tmp_path)
    assert winners(spark, str(tmp_path / "out")) == {"p1": "a1", "p2": "a2", "p3": "b2"}
    drop(folder, "0.jsonl", [paper(1, "late"), paper(4, "c1"), paper(4, "c2")])
    run(spark, folder, tmp_path)
    want = {"p1": "a1", "p2": "a2", "p3": "b2", "p4": "c1"}
    assert winners(spark, str(tmp_path / "out")) == want and spark.read.parquet(str(tmp_path / "out")).count() == 4
    run(spark, folder, tmp_path)  # nothing new
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_a_lost_commit_is_done_again_once(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "a.jsonl", [paper(i, f"a{i}") for i in range(20)] * 3)
    run(spark, folder, tmp_path)
    for commit in (tmp_path / "cp" / "commits").glob("*0*"):
        commit.unlink()
    run(spark, folder, tmp_path)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_one_hot_id_over_many_files_and_batches(spark, tmp_path):
    folder = tmp_path / "in"
    for f in range(6):
        drop(folder, f"{f}.jsonl", [paper(0 if i % 3 else 100 * f + i, f"{f}-{i}") for i in range(60)])
    run(spark, folder, tmp_path, max_files=2)
    got = winners(spark, str(tmp_path / "out"))
    # One batch or several, all of them bring the hot id; the first file of the first batch has it.
    assert got["p0"].endswith(("-0", "-1")) and len(got) == len({f"p{100 * f + i}" for f in range(6) for i in range(0, 60, 3)} | {"p0"})


def test_plan_keeps_state_and_reads_no_table(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "a.jsonl", [paper(1, "a")])
    query = run(spark, folder, tmp_path)
    plan = query._jsq.explainInternal(False)
    assert "TransformWithState" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan and plan.count("Scan") <= 2
    assert "RocksDB" in state_session(spark).conf.get(STORE) and spark.conf.get(STORE) != state_session(spark).conf.get(STORE)
    assert first_seen(stream_lines(state_session(spark), str(folder))).isStreaming
