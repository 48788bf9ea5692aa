"""A log of arrival messages as a streaming source whose offsets are places in the log, and the files they name as rows.

The log is a folder of text segments, a message in each line, read in order of their paths; segments are only appended to, and one is
complete once a later one is there. The driver lists segments and plans byte ranges of them: it never sees a message, and the path of no named file.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from vectorloom.session import stored
from vectorloom.sources.notifications import parse_messages

#: Bytes of the log that one task reads, and bytes of a named file that are one piece of work.
RANGE, PIECE = 4 << 20, 32 << 20
#: Bytes of lines that a task sends on at once; it and the JVM hold a few such batches.
_BATCH = 1 << 20
_PACKED = (".gz", ".bz2", ".zst", ".lz4")
_LINES = "value STRING, source_path STRING, source_file STRING, file_size BIGINT, block_start BIGINT, source_pos BIGINT"


def file_place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path there, for a plain path or a URI whose path is not percent-encoded."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/@"))


def lines_between(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(place, line) for the lines whose first byte is in the range."""
    reader, at = io.BufferedReader(file, 1 << 20), start
    if start:
        reader.seek(start - 1)
        at = start - 1 + len(reader.readline())
    while at < end:
        line = reader.readline()
        if not line:
            return
        yield at, line
        at += len(line)


@dataclass
class _Range(InputPartition):
    segment: str
    start: int
    end: int


class _LogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.range = options["path"].rstrip("/"), int(options.get("range_bytes", RANGE))

    def _segments(self) -> list[tuple[str, int]]:
        """(path below the log, bytes) in order; hidden files such as markers of a finished write are none."""
        files, base = file_place(self.path)
        found = files.get_file_info(pyarrow.fs.FileSelector(base, recursive=True, allow_not_found=True))
        below = [(f.path[len(base) :].lstrip("/"), f.size) for f in found if f.type == pyarrow.fs.FileType.File]
        return sorted((p, n) for p, n in below if not any(part[0] in "._" for part in p.split("/")))

    def _whole_lines(self, segment: str, size: int) -> int:
        """Bytes of a segment up to the end of its last whole line."""
        files, base = file_place(self.path)
        with files.open_input_file(f"{base}/{segment}") as file:
            end = size
            while end:
                start = max(0, end - (1 << 16))
                file.seek(start)
                cut = file.read(end - start).rfind(b"\n")
                if cut >= 0:
                    return start + cut + 1
                end = start
        return 0

    def initialOffset(self) -> dict:
        return {"segment": "", "bytes": 0}

    def latestOffset(self) -> dict:
        segments = self._segments()
        if not segments:
            return self.initialOffset()
        name, size = segments[-1]
        return {"segment": name, "bytes": self._whole_lines(name, size)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for name, size in self._segments():
            if start["segment"] <= name <= end["segment"]:
                lo = start["bytes"] if name == start["segment"] else 0
                hi = end["bytes"] if name == end["segment"] else size
                out += [_Range(name, at, min(at + self.range, hi)) for at in range(lo, hi, self.range)]
        return out

    def read(self, partition: _Range) -> Iterator[tuple]:
        files, base = file_place(self.path)
        with files.open_input_file(f"{base}/{partition.segment}") as file:
            for at, line in lines_between(file, partition.start, partition.end):
                yield line.decode("utf-8", "replace").rstrip("\r\n"), partition.segment, at


class MessageLog(DataSource):
    """``spark.readStream.format("message_log").load(folder)``: the messages as ``value`` with segment and place."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return "value STRING, segment STRING, place BIGINT"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _LogReader(self.options)


def message_log(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(MessageLog)
    return spark.readStream.format("message_log").load(folder)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each named file; without a size where there is no such file. A packed file is one piece."""
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())

    def batch(rows):
        columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["source_path", "source_file", "file_size", "start", "end"])

    rows = []
    for given in batches:
        for path in given.column(0).to_pylist():
            if len(rows) >= 1000:
                yield batch(rows)
                rows = []
            name = path.rstrip("/").rsplit("/", 1)[-1]
            files, place = file_place(path)
            info = files.get_file_info(place)
            if info.type != pyarrow.fs.FileType.File:
                rows.append((path, name, None, None, None))
                continue
            if name.endswith(_PACKED):
                rows.append((path, name, info.size, 0, 1 << 62))
                continue
            for start in range(0, info.size, PIECE):
                rows.append((path, name, info.size, start, min(start + PIECE, info.size)))
                if len(rows) >= 1000:
                    yield batch(rows)
                    rows = []
    if rows:
        yield batch(rows)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["value", "source_path", "source_file", "file_size", "block_start", "source_pos"]

    def batch(values, places, piece):
        path, name, size, start = (piece[c] for c in ("source_path", "source_file", "file_size", "start"))
        same = [pa.repeat(pa.scalar(x, t), len(values)) for x, t in ((path, pa.string()), (name, pa.string()), (size, pa.int64()), (start, pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array(values, pa.string()), *same, pa.array(places, pa.int64())], names)

    for given in batches:
        for piece in given.to_pylist():
            files, place = file_place(piece["source_path"])
            packed = piece["source_file"].endswith(_PACKED)
            opened = files.open_input_stream(place, compression="detect") if packed else files.open_input_file(place)
            with opened as file:
                values, places, held = [], [], 0
                for at, line in lines_between(file, piece["start"], piece["end"]):
                    values.append(line.decode("utf-8", "replace").rstrip("\r\n"))
                    places.append(at)
                    held += len(line)
                    if held > _BATCH or len(values) >= 10_000:
                        yield batch(values, places, piece)
                        values, places, held = [], [], 0
                if values:
                    yield batch(values, places, piece)


def _last_start(file, start: int, end: int) -> int | None:
    """Place of the last line whose first byte is in the range; the range is read from its end."""
    at = end - 1
    while at >= start:
        lo = max(0, start - 1, at - (1 << 16))
        file.seek(lo)
        cut = file.read(at - lo).rfind(b"\n")
        if cut >= 0:
            return lo + cut + 1
        if lo <= start - 1 or not lo:
            break
        at = lo
    return None if start else 0


def _last_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of the last line of each piece; a packed file is read through."""
    for given in batches:
        paths, places = [], []
        for piece in given.to_pylist():
            files, place = file_place(piece["source_path"])
            if piece["source_file"].endswith(_PACKED):
                last = None
                with files.open_input_stream(place, compression="detect") as file:
                    for last, _ in lines_between(file, piece["start"], piece["end"]):
                        pass
            else:
                with files.open_input_file(place) as file:
                    last = _last_start(file, piece["start"], piece["end"])
            if last is not None:
                paths.append(piece["source_path"])
                places.append(last)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(places, pa.int64())], ["source_path", "source_pos"])


def file_pieces(messages: DataFrame) -> DataFrame:
    """The files that some messages name, in pieces for reading; ``file_size`` is null where there is no such file.

    A file named more than once is there once; a message without a path is left out. Tasks look the files up.
    """
    named = parse_messages(messages).select("filepath").distinct()
    return stored(
        named.mapInArrow(_pieces, "source_path STRING, source_file STRING, file_size BIGINT, start BIGINT, end BIGINT"), "pieces"
    )


def _dealt(pieces: DataFrame) -> DataFrame:
    """Pieces in turn to as many tasks as their number and bytes, which are known, ask for.

    The rows that name pieces are short: dealt by a key, all of them would be put together into one task.
    """
    count, size = pieces.agg(F.count("*"), F.sum(F.least("end", "file_size") - F.col("start"))).first()
    cores = pieces.sparkSession.sparkContext.defaultParallelism
    return pieces.repartition(max(1, min(count, max(cores, -(-(size or 0) // PIECE)))))


def piece_lines(pieces: DataFrame) -> DataFrame:
    """Lines of pieces, which tasks read in any order. Lines end with a line feed; ``source_pos`` is the byte a line starts at."""
    return _dealt(pieces).mapInArrow(_read, _LINES)


def piece_rooms(pieces: DataFrame) -> DataFrame:
    """Places that each file asks for, as ``with_sequence`` counts them: found at the ends of its pieces, no line is sent anywhere."""
    last = _dealt(pieces).mapInArrow(_last_starts, "source_path STRING, source_pos BIGINT")
    return last.groupBy("source_path").agg((F.max("source_pos") + 1).alias("room"))


def pieces_at(pieces: DataFrame, parts: DataFrame) -> DataFrame:
    """The pieces that some rows name by ``source_path`` and ``block_start``."""
    return pieces.join(parts.withColumnRenamed("block_start", "start"), ["source_path", "start"], "left_semi")
