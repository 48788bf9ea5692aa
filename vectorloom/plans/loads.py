"""Runs of the stages against the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vectorloom.config import MAX_BROADCAST_KEYS, MODEL_NAME
from vectorloom.functions.encoders import Encoder
from vectorloom.operators.lake import Lake
from vectorloom.operators.tables import absent_from, absent_rows
from vectorloom.plans.stages import bronze_rows, clean_rows, gold_rows, parse_lines
from vectorloom.session import short_splits
from vectorloom.sources.lines import read_jsonl


@dataclass
class Counts:
    bronze: int = 0
    silver: int = 0
    gold: int = 0
    skipped: int = 0


def _at(moment: datetime):
    return F.lit(moment).cast("timestamp")


def _skipped(rows: DataFrame, seen: Observation) -> DataFrame:
    """Count rejected rows while they pass; the rest go on.

    A map stage that runs again after a lost executor counts again: this is a
    progress figure, the rejects table is exact.
    """
    return rows.observe(seen, F.count_if(F.col("reason").isNotNull()).alias("rows")).where(
        F.col("reason").isNull()
    )


#: What names a part of the lines that can be read by itself.
PARTS = ("source_path", "block_start")


def load_bronze(
    lake: Lake, lines: DataFrame, now: datetime, small: bool = False, again: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[int, int]:
    """Raw lines to bronze; returns rows inserted and rows skipped.

    Lines are parsed once for their ids and once more for the rows that go in. ``again`` gives all lines of
    some ``PARTS``: the second time only parts with new rows are read.
    """
    seen, base = Observation(), lake.last_bronze_id()
    accepted = _skipped(parse_lines(lines), seen)

    def rows_of(parts: DataFrame) -> DataFrame:
        return bronze_rows(parse_lines(again(parts)).where(F.col("reason").isNull()), base, _at(now))

    more = {"parts": PARTS, "again": rows_of} if again else {}
    rows = bronze_rows(accepted, base, _at(now), more.get("parts", ()))
    added = lake.insert_if_absent("bronze", rows, "seq", small=small, place="seq", **more)
    return added, int(seen.get["rows"])


def load_silver(lake: Lake, now: datetime, since: datetime | None = None) -> tuple[int, int]:
    """Bronze rows not in silver yet, all of them in one pass.

    ``since`` limits the work to bronze rows loaded from then on; without it the
    whole backlog is compared.
    """
    seen = Observation()
    pending = _pending(lake.read("bronze"), "ingested", lake.read("silver"), "processed", since)
    rows = _skipped(clean_rows(pending, _at(now)), seen).drop("reason")
    with short_splits(lake.spark):
        added = lake.append("silver", rows)
    return added, int(seen.get["rows"])


def load_gold(
    lake: Lake,
    factory: Callable[[], Encoder],
    now: datetime,
    since: datetime | None = None,
    model_name: str = MODEL_NAME,
) -> int:
    """Silver rows that have no vector of this model yet."""
    done = lake.read("gold").where(F.col("model_name") == model_name)
    pending = _pending(lake.read("silver"), "processed", done, "embedded", since)
    with short_splits(lake.spark):
        return lake.append("gold", gold_rows(pending, factory, _at(now), lake.dims, model_name))


def _pending(
    rows: DataFrame, verb: str, done: DataFrame, done_verb: str, since: datetime | None
) -> DataFrame:
    """Rows of one layer that the next does not have.

    A row loaded since some time was processed after it, so the other side is
    cut to the same days (and one before, for a clock set back). Both cuts prune
    day partitions: a micro-batch does not touch older data.
    """
    if since is None:
        return absent_rows(rows, done, ["arxiv_id"])
    recent = rows.where(
        (F.col(f"{verb}_on") >= F.lit(since.date())) & (F.col(f"{verb}_at") >= _at(since))
    )
    days = F.col(f"{done_verb}_on") >= F.lit(since.date() - timedelta(days=1))
    count = recent.count()
    if count > MAX_BROADCAST_KEYS:
        return absent_rows(recent, done.where(days), ["arxiv_id"])
    return absent_from(recent, done.where(days), ["arxiv_id"], count)


def last_run(lake: Lake) -> tuple[datetime, int] | None:
    """Start and batch number of the last run that went through, or None."""
    newest = F.max(F.struct(F.unix_micros("started_at").alias("us"), "batch_id")).alias("run")
    run = lake.read("runs").where(F.col("status") == "success").agg(newest).first()["run"]
    return None if run is None else (datetime.fromtimestamp(run["us"] / 1e6, timezone.utc), run["batch_id"])


def last_success(lake: Lake) -> datetime | None:
    run = last_run(lake)
    return run and run[0]


def log_run(lake: Lake, batch_id: int, counts: Counts, started: datetime, status: str) -> None:
    row = {
        **{name: int(n) for name, n in asdict(counts).items()},
        "run_id": uuid.uuid4().hex,
        "batch_id": batch_id,
        "started_at": started,
        "finished_at": datetime.now(timezone.utc),
        "status": status,
    }
    schema = lake.read("runs").schema
    # As literals: rows of Python objects would start further Python workers, which then stay with the executors.
    lake.append("runs", lake.spark.range(1).select(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in schema]))


def run_stages(
    lake: Lake,
    lines: DataFrame,
    factory: Callable[[], Encoder],
    model_name: str = MODEL_NAME,
    batch_id: int = -1,
    small: bool = False,
    whole: bool = False,
    again: Callable[[DataFrame], DataFrame] | None = None,
) -> Counts:
    """Bronze, silver and gold for some lines; a failure is logged and raised.

    Only rows since the last success are compared between the layers, so a load
    costs what is new. A failed run leaves what it appended, and the next one
    picks up the rest. ``whole`` compares all rows of the layers. ``again`` gives
    the lines of parts of the input a second time (``load_bronze``).
    """
    started = datetime.now(timezone.utc)
    since = None if whole else last_success(lake)
    counts = Counts()
    try:
        counts.bronze, bad_lines = load_bronze(lake, lines, started, small, again)
        counts.silver, bad_texts = load_silver(lake, started, since)
        counts.gold = load_gold(lake, factory, started, since, model_name)
        counts.skipped = bad_lines + bad_texts
    except Exception:
        log_run(lake, batch_id, counts, started, "failed")
        raise
    log_run(lake, batch_id, counts, started, "success")
    return counts


def load_files(
    lake: Lake, path: str | list[str], factory: Callable[[], Encoder], model_name: str = MODEL_NAME
) -> Counts:
    """Batch load of JSON-lines files through all three layers."""
    return run_stages(lake, read_jsonl(lake.spark, path), factory, model_name)


def store_rejects(lake: Lake, lines: DataFrame, now: datetime) -> int:
    """Keep the lines bronze does not accept, with the reason."""
    bad = parse_lines(lines).where(F.col("reason").isNotNull())
    return lake.append(
        "rejects",
        bad.select(
            F.lit("bronze").alias("stage"),
            "arxiv_id",
            "source_file",
            "source_pos",
            "raw_data",
            "reason",
            _at(now).alias("rejected_at"),
        ),
    )


def replace_model(lake: Lake, factory: Callable[[], Encoder], model_name: str) -> int:
    """Embed every paper that has no vector of the new model; old vectors stay."""
    return load_gold(lake, factory, datetime.now(timezone.utc), None, model_name)
