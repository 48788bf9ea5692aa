"""First record wins on a stream, by state kept for each paper id.

A load by micro-batches looks each new id up in the whole table. Here the ids seen are rows of a state store (RocksDB, in shards, kept
in the checkpoint), so a batch costs what it brings and reads no table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from vectorloom.plans.stages import parse_lines

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
UNLOAD = "spark.sql.streaming.stateStore.unloadOnCommit"
_ROW = "arxiv_id STRING, raw_data STRING, source_file STRING, source_path STRING, source_pos BIGINT"


def state_session(spark: SparkSession, shards: int | None = None, keep_open: bool = False) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB.

    A stream keeps the number of shards it starts with, and each is a store with some MB of files of its own, so it is
    chosen here, by default one for each core, and does not follow the shuffle settings. A store is closed when its task has written the batch to the
    checkpoint, so local disks hold the stores of running tasks only; ``keep_open`` leaves them there, for batches that follow each other at once.
    """
    session = spark.newSession()
    session.conf.set(UNLOAD, str(not keep_open).lower())
    session.conf.set(STORE, ROCKS_DB)
    session.conf.set("spark.sql.shuffle.partitions", str(shards or spark.sparkContext.defaultParallelism))
    return session


def _first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each id among the lines of a task, with its place in the file.

    Lines of a file block follow each other, so the offset of the block plus the number of the line in the task rises within a
    file. An id with a third of the input then sends one row per task.
    """
    number, first = 0, {}
    schema = None
    for batch in batches:
        schema = batch.schema
        keys, paths, starts = (batch.column(c).to_pylist() for c in ("arxiv_id", "source_path", "block_start"))
        for i, (key, path, start) in enumerate(zip(keys, paths, starts)):
            place = (path, start + number + i)
            if key not in first or place < first[key][0]:
                first[key] = (place, batch.column("raw_data")[i].as_py(), batch.column("source_file")[i].as_py())
        number += batch.num_rows
    if schema is not None and first:
        rows = [(k, raw, file, path, pos) for k, ((path, pos), raw, file) in first.items()]
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
        names = ["arxiv_id", "raw_data", "source_file", "source_path", "source_pos"]
        for lo in range(0, len(rows), 1000):
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows[lo : lo + 1000]), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)


class FirstSeen(StatefulProcessor):
    """Lets the first row of an id pass, once; the state holds where it stood."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.winner = handle.getValueState("winner", "source_path STRING, source_pos BIGINT")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = None
        for row in rows:  # one at a time, whatever their number
            if best is None or (row.source_path, row.source_pos) < (best.source_path, best.source_pos):
                best = row
        if best is not None and not self.winner.exists():
            self.winner.update((best.source_path, best.source_pos))
            yield Row(
                arxiv_id=key[0], raw_data=best.raw_data, source_file=best.source_file,
                source_path=best.source_path, source_pos=best.source_pos,
            )

    def close(self) -> None:
        pass


def first_seen(lines: DataFrame) -> DataFrame:
    """Accepted lines of a stream (``stream_lines``) whose id no earlier batch had; within a batch the first by path and line.

    Rejected lines are left out. The stream's session must be one of ``state_session``.
    """
    accepted = parse_lines(lines).where(F.col("reason").isNull())
    local = accepted.select("arxiv_id", "raw_data", "source_file", "source_path", "block_start").mapInArrow(_first_of_task, _ROW)
    return local.groupBy("arxiv_id").transformWithState(FirstSeen(), _ROW, "Append", "None")


def write_first_seen(lines: DataFrame, path: str, checkpoint: str, interval: int | None = None) -> StreamingQuery:
    """Append the winners to Parquet files, each exactly once; what is there is loaded and the stream ends, unless an ``interval`` in seconds is given."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": f"{interval} seconds"}
    writer = first_seen(lines).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**trigger).start()
