"""Continuous loads: every micro-batch runs the batch stages."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vectorloom.config import MODEL_NAME, POLL_SECONDS, STATE_KEY
from vectorloom.functions.encoders import Encoder
from vectorloom.operators.checkpoint import next_checkpoint, parse_checkpoint
from vectorloom.operators.lake import Lake
from vectorloom.operators.tables import absent_from
from vectorloom.plans.loads import last_run, run_stages
from vectorloom.session import small_buffers
from vectorloom.sources.archive import archive_files, plain_path
from vectorloom.sources.feeds import record_lines
from vectorloom.sources.lines import file_starts, in_sequence, with_sequence
from vectorloom.sources.message_log import file_pieces, piece_lines, piece_rooms, pieces_at


def _start(stream: DataFrame, each, checkpoint: str, interval: int, once: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": f"{interval} seconds"}
    return writer.trigger(**trigger).start()


def load_stream(
    lake: Lake,
    lines: DataFrame,
    factory: Callable[[], Encoder],
    checkpoint: str,
    interval: int = POLL_SECONDS,
    once: bool = False,
    model_name: str = MODEL_NAME,
    archive: str | None = None,
) -> StreamingQuery:
    """Load a stream of lines; ``once`` takes what is there and stops.

    Spark's checkpoint holds the progress. A batch that fails is not committed
    and comes again; the key anti-joins make that harmless. With ``archive`` the
    files of a loaded batch are moved there, by the driver: give the stream a
    ``max_files`` then.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        here = lake.on(batch.sparkSession)
        # Kept, so that the files of the batch are read once.
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            run_stages(here, with_sequence(kept), factory, model_name, batch_id, small=True)
            if archive:
                done = kept.select(plain_path("source_path").alias("path")).distinct().orderBy("path")
                archive_files(here.spark, [r["path"] for r in done.toLocalIterator()], archive)
        finally:
            kept.unpersist()

    return _start(lines, each, checkpoint, interval, once)


def load_notified(
    lake: Lake,
    messages: DataFrame,
    factory: Callable[[], Encoder],
    checkpoint: str,
    interval: int = POLL_SECONDS,
    once: bool = False,
    model_name: str = MODEL_NAME,
) -> StreamingQuery:
    """Load the files named by a stream of arrival messages, of ``message_log`` or any other source.

    Tasks look the files up and read them, so no path reaches the driver. A path without a file becomes a row of the
    rejects (stage ``files``), once; the load goes on. Lines are kept nowhere on the way: all are read for their ids, and
    the pieces that hold new ids once more for the table.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        with small_buffers(batch.sparkSession):
            load(batch, batch_id)

    def load(batch: DataFrame, batch_id: int) -> None:
        here = lake.on(batch.sparkSession)
        pieces = file_pieces(batch)
        there = pieces.where(F.col("file_size").isNotNull())
        if not there.isEmpty():
            starts = file_starts(piece_rooms(there))

            def lines_of(some: DataFrame) -> DataFrame:
                return in_sequence(piece_lines(some), starts)

            run_stages(
                here, lines_of(there), factory, model_name, batch_id, small=True, again=lambda parts: lines_of(pieces_at(there, parts))
            )
        gone = pieces.where(F.col("file_size").isNull()).select(
            F.lit("files").alias("stage"), F.lit(None).cast("string").alias("arxiv_id"), "source_file",
            F.lit(None).cast("long").alias("source_pos"), F.col("source_path").alias("raw_data"),
            F.lit("file not found").alias("reason"), F.current_timestamp().alias("rejected_at"),
        )
        here.append("rejects", absent_from(gone, here.read("rejects").where("stage = 'files'"), ["raw_data"]))

    return _start(messages, each, checkpoint, interval, once)


def load_feed(
    lake: Lake,
    entries: DataFrame,
    to_records: Callable[[DataFrame], DataFrame],
    factory: Callable[[], Encoder],
    checkpoint: str,
    state_key: str = STATE_KEY,
    timed: bool = True,
    interval: int = POLL_SECONDS,
    once: bool = False,
    model_name: str = MODEL_NAME,
) -> StreamingQuery:
    """Load landed feed files and move the event-time checkpoint of this source.

    ``timed`` feeds carry publication times; for others the start of the cycle
    stands in. The checkpoint moves only after the batch has been loaded.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        start = datetime.now(timezone.utc)
        here = lake.on(batch.sparkSession)
        before = last_run(here)
        records = to_records(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            run_stages(here, with_sequence(record_lines(records)), factory, model_name, batch_id, small=True)
            here.set_state(state_key, _advance(here, records, _cut(before, batch_id), state_key, timed, start))
        finally:
            records.unpersist()

    return _start(entries, each, checkpoint, interval, once)


def _cut(before: tuple[datetime, int] | None, batch_id: int) -> datetime | None:
    """Time from which rows of bronze count as new for a batch.

    After the last success, so what failed runs left counts. Where the last
    success was this same batch, a crash came between its last append and the
    end of the batch: its rows count again.
    """
    if before is None:
        return None
    started, last = before
    return started if last == batch_id else started + timedelta(microseconds=1)


def _advance(
    lake: Lake, records: DataFrame, success: datetime | None, key: str, timed: bool, start: datetime
) -> str:
    """Next checkpoint from the records of the batch that bronze holds since ``success``."""
    now = F.lit(start).cast("timestamp")
    since = parse_checkpoint(F.lit(lake.get_state(key)).cast("string"), now) if timed else now
    loaded = lake.read("bronze")
    if success is not None:
        loaded = loaded.where(
            (F.col("ingested_on") >= F.lit(success.date())) & (F.col("ingested_at") >= F.lit(success).cast("timestamp"))
        )
    new = records.join(loaded.select(F.col("arxiv_id").alias("id")), "id", "left_semi")
    seen = new.select(F.try_to_timestamp("published").alias("published"))
    stamp = F.date_format("checkpoint", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("value")
    return next_checkpoint(seen, since, now).select(stamp).first()["value"]
