import json
import os
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from vectorloom.functions import fields
from vectorloom.functions.encoders import hashing_encoder
from vectorloom.operators import listing, tables
from vectorloom.operators.lake import Lake
from vectorloom.plans import loads
from vectorloom.plans.stages import parse_lines
from vectorloom.sources.lines import read_jsonl

DIMS = (16, 8, 4, 2)
ENCODER = hashing_encoder(16)
PAPERS = [
    {
        "id": "2305.11111", "title": "Tides in Small Lakes", "abstract": "We measure how seiches decay.",
        "authors": ["Ines Lago", "Tom Bay"], "categories": ["cs.CL"], "doi": "10.5555/lake.7",
        "journal-ref": None, "published": "2023-01-02T08:00:00Z",
    },
    {
        "id": "2305.22222", "title": "Counting Knots by Hand", "abstract": "A table of knots up to ten crossings.",
        "authors": "Rope Maker", "categories": "cs.AI  math.CO", "published": "2023-01-03T08:00:00Z",
    },
]


def write(path, records):
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), f"t{uuid.uuid4().hex[:8]}_", DIMS).create()


BAD = [
    "", "   ", "not json", '{"id":""}', '{"id":null}', '{"title":"n"}', "[1]", '{"id":5}', '{"id":0}',
    '{"id":false}', '{"id":"x"} y', '{"id":"d1","n":1}', '{"id":"d1","n":2}', '{"id":"k","id":"last","n":NaN}',
    "{'id':'q'}", ' {"id":"sp"} ', '{"id":["a"]}', '[{"id":"z"}]', '{"id":"cut"',
]


def test_bad_lines(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", BAD)
    rows = {r.raw_data: (r.arxiv_id, r.reason) for r in parse_lines(read_jsonl(spark, path)).collect()}
    assert "" not in rows and len(rows) == len(BAD) - 2
    accepted = {k: v[0] for k, v in rows.items() if v[1] is None}
    assert accepted == {
        '{"id":5}': "5", '{"id":"d1","n":1}': "d1", '{"id":"d1","n":2}': "d1",
        '{"id":"k","id":"last","n":NaN}': "last", '{"id":"sp"}': "sp",
    }
    reasons = {k: v[1] for k, v in rows.items() if v[1]}
    for line in ("not json", "[1]", '{"id":"x"} y', "{'id':'q'}", '[{"id":"z"}]', '{"id":"cut"'):
        assert reasons[line] == "invalid JSON", line
    for line in ('{"id":""}', '{"id":null}', '{"title":"n"}', '{"id":0}', '{"id":false}', '{"id":["a"]}'):
        assert reasons[line] == "missing id", line


@pytest.mark.parametrize("small", [False, True])
def test_counts_and_rerun(spark, lake, tmp_path, small):
    bad = [{"id": "x1", "title": "T", "abstract": "  "}, {"id": "x2", "title": "", "abstract": "A"}, "oops"]
    path = write(tmp_path / "a.jsonl", PAPERS + bad)
    first = loads.run_stages(lake, read_jsonl(spark, path), ENCODER, "m", small=small)
    assert (first.bronze, first.silver, first.gold, first.skipped) == (4, 2, 2, 3)
    again = loads.run_stages(lake, read_jsonl(spark, path), ENCODER, "m", small=small)
    assert (again.bronze, again.silver, again.gold) == (0, 0, 0)
    assert [r["count"] for r in listing.layer_counts(**{n: lake.read(n) for n in ("bronze", "silver", "gold")}).collect()] == [4, 2, 2]
    runs = lake.read("runs").orderBy("started_at").collect()
    assert [(r.bronze, r.status) for r in runs] == [(4, "success"), (0, "success")]


def test_silver_fields(spark, lake, tmp_path):
    loads.load_files(lake, write(tmp_path / "a.jsonl", PAPERS), ENCODER, "m")
    one, two = lake.read("silver").orderBy("arxiv_id").collect()
    assert one.authors == "Ines Lago, Tom Bay" and one.authors_list == ["Ines Lago", "Tom Bay"]
    assert two.authors == "Rope Maker" and two.authors_list == ["Rope Maker"]
    assert one.categories == ["cs.CL"] and two.categories == ["cs.AI", "math.CO"]
    assert one.doi == "10.5555/lake.7" and one.journal_ref is None
    assert one.published == datetime(2023, 1, 2, 8)
    gold = lake.read("gold").collect()
    assert {len(g.embedding_16) for g in gold} == {16} and {len(g.embedding_2) for g in gold} == {2}
    assert {g.model_name for g in gold} == {"m"}


def test_first_record_wins_over_files_and_blocks(spark, lake, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    filler = [{"id": f"f{i}", "n": i, "pad": "x" * 50} for i in range(400)]
    write(folder / "b.jsonl", [{"id": "k", "n": 3}, *filler])
    write(folder / "a.jsonl", [*filler, {"id": "k", "n": 1}, {"id": "k", "n": 2}])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = read_jsonl(spark, str(folder))
        assert lines.select("block_start").distinct().count() > 5
        order = [json.loads(r.value)["n"] for r in lines.orderBy("seq").collect()]
        assert order == [*range(400), 1, 2, 3, *range(400)]
        loads.load_bronze(lake, lines, datetime.now(timezone.utc))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = lake.read("bronze").orderBy("id").collect()
    assert len(rows) == 401 and len({r.id for r in rows}) == 401
    assert [json.loads(r.raw_data)["n"] for r in rows] == [*range(400), 1]
    # A later load goes on after the highest id.
    loads.load_bronze(lake, read_jsonl(spark, write(tmp_path / "c.jsonl", [{"id": "new"}])), datetime.now(timezone.utc))
    assert lake.read("bronze").orderBy(F.col("id").desc()).first().arxiv_id == "new"


def test_first_record_wins_when_small_files_share_a_task_with_a_large_one(spark, lake, tmp_path):
    """A task reads its files by size, so a short file can be read after many rows of a long one."""
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.jsonl", [{"id": "k", "n": 1}])
    write(folder / "b.jsonl", [{"id": "b", "n": 2}])
    write(folder / "z.jsonl", [{"id": "k", "n": 3}, *({"id": f"f{i}"} for i in range(30_000))])
    lines = read_jsonl(spark, str(folder))
    assert lines.count() == lines.select("seq").distinct().count() == 30_003
    loads.load_bronze(lake, lines, datetime.now(timezone.utc))
    row = lake.read("bronze").where("arxiv_id = 'k'").collect()
    assert len(row) == 1 and row[0].source_file == "a.jsonl"
    assert lake.read("bronze").select("id").distinct().count() == 30_002


def test_second_load_compares_only_what_is_new(spark, lake, tmp_path):
    """A load after a success reads the day's rows and shuffles no stored texts."""
    write(tmp_path / "a.jsonl", PAPERS)
    loads.load_files(lake, str(tmp_path / "a.jsonl"), ENCODER, "m")
    since = loads.last_success(lake)
    pending = loads._pending(lake.read("bronze"), "ingested", lake.read("silver"), "processed", since)
    assert "PartitionFilters: [isnotnull(ingested_on" in pending._jdf.queryExecution().toString()
    counts = loads.load_files(lake, write(tmp_path / "b.jsonl", [{**PAPERS[0], "id": "new"}]), ENCODER, "m")
    assert (counts.bronze, counts.silver, counts.gold) == (1, 1, 1)


def test_failed_run_is_finished_by_the_next(spark, lake, tmp_path):
    """Rows appended before a failure are picked up although the next batch has other papers."""

    class Broken:
        dim = 16

        def encode(self, texts):
            raise RuntimeError("no model")

    loads.run_stages(lake, read_jsonl(spark, write(tmp_path / "z.jsonl", [PAPERS[1]])), ENCODER, "m", small=True)
    with pytest.raises(Exception, match="no model"):
        loads.run_stages(lake, read_jsonl(spark, write(tmp_path / "a.jsonl", PAPERS)), Broken, "m", small=True)
    assert lake.read("silver").count() == 2 and lake.read("gold").count() == 1
    assert lake.read("runs").where("status = 'failed'").count() == 1
    counts = loads.run_stages(lake, read_jsonl(spark, write(tmp_path / "b.jsonl", [{"id": "n"}])), ENCODER, "m", small=True)
    assert (counts.bronze, counts.silver, counts.gold) == (1, 0, 1)


def test_micro_batches_prune_older_days(spark, lake, tmp_path):
    long_ago = datetime(2020, 1, 1, tzinfo=timezone.utc)
    loads.load_bronze(lake, read_jsonl(spark, write(tmp_path / "a.jsonl", [PAPERS[0]])), long_ago)
    loads.load_silver(lake, long_ago)
    now = datetime.now(timezone.utc)
    loads.load_bronze(lake, read_jsonl(spark, write(tmp_path / "b.jsonl", [PAPERS[1]])), now)
    pending = loads._pending(lake.read("bronze"), "ingested", lake.read("silver"), "processed", now - timedelta(hours=1))
    plan = pending._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingested_on" in plan and "PartitionFilters: [isnotnull(processed_on" in plan
    assert [r.arxiv_id for r in pending.collect()] == ["2305.22222"]


def test_shared_folder():
    from types import SimpleNamespace as N

    from vectorloom.session import shared_dir

    def session(master, setting=None):
        return N(conf=N(get=lambda key, default: setting or default), sparkContext=N(master=master, applicationId="a1"))

    assert shared_dir(session("yarn", "hdfs:///x/")) == "hdfs:///x"
    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]")) != ""
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))


def test_new_model_embeds_all_again(spark, lake, tmp_path):
    loads.load_files(lake, write(tmp_path / "a.jsonl", PAPERS), ENCODER, "m")
    assert loads.replace_model(lake, ENCODER, "m2") == 2
    assert loads.replace_model(lake, ENCODER, "m2") == 0
    assert lake.read("gold").groupBy("model_name").count().count() == 2


def test_rejects_table(spark, lake, tmp_path):
    lines = read_jsonl(spark, write(tmp_path / "a.jsonl", ["oops", {"id": "a"}, {"x": 1}]))
    assert loads.store_rejects(lake, lines, datetime.now(timezone.utc)) == 2
    assert {r.reason for r in lake.read("rejects").collect()} == {"invalid JSON", "missing id"}


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), f"t{uuid.uuid4().hex[:8]}_", DIMS, buckets=4).create()
    loads.load_files(lake, write(tmp_path / "a.jsonl", PAPERS), ENCODER, "m")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pending = listing.unprocessed(lake.read("bronze"), lake.read("silver"))
        assert "Exchange" not in pending._jdf.queryExecution().executedPlan().toString()
        assert pending.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_create_is_repeatable_and_reset_empties(spark, lake, tmp_path):
    loads.load_files(lake, write(tmp_path / "a.jsonl", PAPERS), ENCODER, "m")
    lake.set_state("k", "v")
    assert lake.create().read("bronze").count() == 2
    assert lake.reset().read("bronze").count() == 0
    assert lake.get_state("k") == "v"


def test_rows_outlive_the_catalog(spark, lake, tmp_path):
    loads.load_files(lake, write(tmp_path / "a.jsonl", PAPERS), ENCODER, "m")
    for database in lake._databases():
        spark.sql(f"DROP DATABASE {database} CASCADE")
    again = Lake(spark, lake.root, lake.prefix, DIMS).create()
    assert [again.read(n).count() for n in ("bronze", "silver", "gold", "runs")] == [2, 2, 2, 1]
    counts = loads.run_stages(again, read_jsonl(spark, str(tmp_path / "a.jsonl")), ENCODER, "m", small=True)
    assert (counts.bronze, counts.silver, counts.gold) == (0, 0, 0)


def test_state_last_write_wins(lake):
    assert lake.get_state("k") is None and lake.get_state("k", "d") == "d"
    for value in ("a", "b", "c"):
        lake.set_state("k", value)
    lake.set_state("other", "x")
    assert lake.get_state("k") == "c" and lake.get_state("other") == "x"
    assert lake.seed_state("k") == 0 and lake.get_state("k") == "c"
    assert lake.seed_state() == 1
    seeded = datetime.fromisoformat(lake.get_state("last_fetch_time"))
    age = datetime.now(timezone.utc) - seeded
    assert timedelta(hours=23, minutes=59) < age < timedelta(hours=24, minutes=5)


def test_one_key_with_a_third_of_the_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    kept = tables.first_wins(df, ["k"], "id")
    assert kept.where("k = -1").first()["id"] == 0 and kept.count() == 2001
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, "rows must be reduced before the shuffle"


@pytest.mark.parametrize("count", [None, 3, 10**9])
def test_absent_from(spark, count):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    existing = spark.createDataFrame([(2, "x"), (9, "y")], "k int, v string")
    assert sorted(r.k for r in tables.absent_from(df, existing, ["k"], count).collect()) == [1, 3]


def test_cleaning_is_computed_once(spark, lake, tmp_path):
    from vectorloom.plans.stages import clean_rows

    loads.load_bronze(lake, read_jsonl(spark, write(tmp_path / "a.jsonl", PAPERS)), datetime.now(timezone.utc))
    rows = clean_rows(lake.read("bronze"), F.current_timestamp()).where(F.col("reason").isNull())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snaps")
    for day in ("2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29"):
        tables.full_refresh(spark.range(3), path, day)
    table = spark.read.parquet(path)
    assert [str(r.snapshot) for r in tables.expired_snapshots(table, "snapshot").collect()] == ["2024-01-01"]
    assert tables.drop_expired(spark, path) == ["2024-01-01"]
    assert spark.read.parquet(path).select("snapshot").distinct().count() == 4


def test_listings(spark, lake, tmp_path):
    loads.load_files(lake, write(tmp_path / "a.jsonl", PAPERS), ENCODER, "m")
    assert listing.peek_bronze(lake.read("bronze")).first().raw_data_preview.endswith("...")
    assert listing.peek_silver(lake.read("silver")).count() == 2
    assert listing.peek_gold(lake.read("gold"), dims=DIMS).first().emb_16_preview.endswith("...]")
    assert listing.work_list(lake.read("silver"), 1, 1).first().arxiv_id == "2305.22222"
    wanted = spark.createDataFrame([("2305.11111",), ("9",), ("8",)], "arxiv_id string")
    with pytest.raises(ValueError, match=r"2 id\(s\) missing, listed in ") as error:
        listing.require_ids(wanted, lake.read("gold"), order="arxiv_id")
    report = spark.read.parquet(str(error.value).rsplit(" ", 1)[1])
    assert sorted(r.arxiv_id for r in report.collect()) == ["8", "9"]
    listing.require_ids(wanted.limit(1), lake.read("gold"))
    assert [r.arxiv_id for r in listing.in_list(lake.read("gold"), wanted).collect()] == ["2305.11111"]


def test_field_functions(spark):
    df = spark.createDataFrame(
        [("2301.00001",), ("quant-ph/0202022",), ("2301.1",), ("2301.12345v1",), ("",)], "x string"
    )
    assert [r.v for r in df.select(fields.valid_id(F.col("x")).alias("v")).collect()] == [True, True, False, False, False]
    times = spark.createDataFrame([("2023-01-02T08:00:00Z",), ("2023-01-02T08:00:00+02:00",), ("not-a-date",)], "x string")
    assert [r.t for r in times.select(fields.iso_timestamp(F.col("x")).alias("t")).collect()] == [
        datetime(2023, 1, 2, 8), datetime(2023, 1, 2, 6), None,
    ]
    raw = spark.createDataFrame(
        [('{"categories":"a  b"}',), ('{"categories":["a","b c"]}',), ("{}",), ('{"categories":[]}',), ('{"categories":""}',)], "x string"
    )
    got = [r.c for r in raw.select(fields.tags(fields.parse_record(F.col("x"))["categories"]).alias("c")).collect()]
    assert got == [["a", "b"], ["a", "b c"], [], [], []]


@pytest.mark.parametrize("limit", [0, 1, 1_000_000])
def test_marked_rows_meet_short_lists_of_keys(spark, monkeypatch, limit):
    """Each way of meeting the keys gives what the plain comparison gives, with repeated and absent keys."""
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e"), (4, "f")], "k int, v string")
    existing = spark.createDataFrame([(2,), (2,), (4,), (9,), (None,)], "k int")
    want = sorted(r.v for r in tables.absent_from(df, existing, ["k"]).collect())
    monkeypatch.setattr(tables, "MAX_BROADCAST_KEYS", limit)
    assert sorted(r.v for r in tables.absent_rows(df, existing, ["k"]).collect()) == want == ["a", "b", "d", "e"]


@pytest.mark.parametrize("limit", [0, 1_000_000])
@pytest.mark.parametrize("small", [False, True])
def test_a_load_shuffles_no_texts(spark, lake, tmp_path, monkeypatch, small, limit):
    """Keys and places decide which lines are new; lines and texts go from the scan to the table."""
    plans, append = {}, Lake.append

    def watched(self, layer, df):
        plans.setdefault(layer, []).append(df._jdf.queryExecution().executedPlan().toString())
        return append(self, layer, df)

    monkeypatch.setattr(Lake, "append", watched)
    monkeypatch.setattr(tables, "MAX_BROADCAST_KEYS", limit)
    path = write(tmp_path / "a.jsonl", [*PAPERS, {**PAPERS[0], "title": "later"}])
    first = loads.run_stages(lake, read_jsonl(spark, path), ENCODER, "m", small=small)
    for layer in ("silver", "gold") if limit == 0 else ("bronze", "silver", "gold"):
        assert "Exchange hashpartitioning" not in plans[layer][0], layer
    again = loads.run_stages(lake, read_jsonl(spark, path), ENCODER, "m", small=small, whole=True)
    assert first.bronze == lake.read("bronze").count() == lake.read("bronze").select("arxiv_id").distinct().count()
    assert lake.read("bronze").where("raw_data LIKE '%later%'").count() == 0
    assert (again.bronze, again.silver, again.gold) == (0, 0, 0) and first.gold == lake.read("gold").count() > 0


def test_new_rows_of_a_day_are_cleaned_and_encoded_by_many_tasks(spark, lake, tmp_path):
    """The files of an earlier load of that day must not make the new ones share a task."""

    def load(name, size):
        folder = tmp_path / name
        folder.mkdir()
        for i in range(4):
            write(folder / f"{i}.jsonl", [{"id": f"{name}{i}-{j}", "title": "t", "abstract": os.urandom(size // 40).hex()} for j in range(20)])
        before = [set(lake.read(layer).inputFiles()) for layer in ("silver", "gold")]
        loads.load_files(lake, str(folder), ENCODER, "m")
        new = [lake.read(layer).select("arxiv_id", F.col("_metadata.file_path").alias("file")).where(F.startswith("arxiv_id", F.lit(name))) for layer in ("silver", "gold")]
        assert [rows.count() for rows in new] == [80, 80]
        return [len({r.file for r in rows.collect()} - files) for rows, files in zip(new, before)]

    load("a", 5_000_000)
    # Silver is as large as bronze, so gold meets long files too.
    assert load("b", 6_000_000) == [4, 4]
