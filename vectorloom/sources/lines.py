"""JSON-lines files as rows with their place in the input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vectorloom.session import stored

# monotonically_increasing_id() keeps the row number inside a task in its low 33 bits.
ROW_BITS = (1 << 33) - 1
# Spark gives paths percent-encoded; the path stays so as a key, the name is shown as it
# is. A plus sign is not an encoded space here.
FILE_COLUMNS = (
    "_metadata.file_path AS source_path",
    "url_decode(replace(_metadata.file_name, '+', '%2B')) AS source_file",
    "_metadata.file_size AS file_size",
    "_metadata.file_block_start AS block_start",
)


def scan_lines(spark: SparkSession, path: str | list[str], suffix: str | None = None) -> DataFrame:
    """Text lines with the file and block they come from."""
    reader = spark.read.option("pathGlobFilter", f"*{suffix}") if suffix else spark.read
    return reader.text(path).selectExpr("value", *FILE_COLUMNS)


def stream_lines(
    spark: SparkSession,
    folder: str,
    suffix: str = ".jsonl",
    max_files: int | None = None,
    max_bytes: str | None = None,
    archive_dir: str | None = None,
    max_file_age: str = "36500d",
) -> DataFrame:
    """New files of a folder as a stream, oldest first, each path once.

    Files present at the start are read first. Files of one name in different
    folders are different files. A file moved in later may carry an old time, so
    ``max_file_age`` is long; lower it when old arrivals cannot happen, as Spark
    remembers every path younger than that.
    """
    reader = (
        spark.readStream.format("text")
        .option("pathGlobFilter", f"*{suffix}")
        .option("latestFirst", "false")
        .option("maxFileAge", max_file_age)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(folder).selectExpr("value", *FILE_COLUMNS)


def with_position(lines: DataFrame) -> DataFrame:
    """Add ``source_pos``, which rises with the line inside each file.

    It is the byte offset of the block plus the row number in the task. A line
    has at least one byte, so it stays below the offset of the next block:
    unique and ordered with neither a shuffle nor a count.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))
    return lines.withColumn("source_pos", F.col("block_start") + row)


def with_sequence(lines: DataFrame) -> DataFrame:
    """Add ``seq``: one number ordered by file path, then line, unique over all files.

    A task reads several files and counts on from one to the next, so a short
    file can hold high positions. Each file therefore gets as many numbers as
    its highest position asks for: one pass that parses nothing, and a running
    sum over the files, one row each. The sums are stored, so Spark knows their
    size and broadcasts them when they are small.
    """
    placed = lines if "source_pos" in lines.columns else with_position(lines)
    rooms = placed.groupBy("source_path").agg((F.max("source_pos") + 1).alias("room"))
    return in_sequence(placed, file_starts(rooms))


def file_starts(rooms: DataFrame) -> DataFrame:
    """Where the numbers of each file start, from the numbers each asks for."""
    before = Window.orderBy("source_path").rowsBetween(Window.unboundedPreceding, -1)
    starts = rooms.select("source_path", F.coalesce(F.sum("room").over(before), F.lit(0)).alias("file_start"))
    return stored(starts, "files")


def in_sequence(placed: DataFrame, starts: DataFrame) -> DataFrame:
    """Add ``seq`` to lines that have a place, some or all lines of the files."""
    return placed.join(starts, "source_path").withColumn("seq", F.col("file_start") + F.col("source_pos")).drop("file_start")


def read_jsonl(spark: SparkSession, path: str | list[str], suffix: str | None = None) -> DataFrame:
    """Lines of JSON-lines files in arrival order (``seq``)."""
    return with_sequence(scan_lines(spark, path, suffix))


def block_starts(lines: DataFrame) -> DataFrame:
    """Rows of each file block and what to add to a row id to get its line number.

    One counting pass, then a running sum over the blocks, of which there are
    as many as input splits. The result is written to the shared folder: Spark
    then knows its size and broadcasts it when it is small.
    """
    # The scan gives blocks in any order, but rows of one block follow each other.
    blocks = (
        lines.withColumn("_row", F.monotonically_increasing_id())
        .groupBy("source_path", "block_start")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("_row").alias("first_row"))
    )
    before = Window.orderBy("source_path", "block_start").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first_row")
    return stored(blocks.select("source_path", "block_start", "rows", shift.alias("shift")), "blocks")


def line_numbers(lines: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Add ``line_index``, the zero-based number of a line over all files in path order."""
    shifts = (starts or block_starts(lines)).select("source_path", "block_start", "shift")
    return (
        lines.withColumn("_row", F.monotonically_increasing_id())
        .join(shifts, ["source_path", "block_start"])
        .withColumn("line_index", F.col("shift") + F.col("_row"))
        .drop("_row", "shift")
    )


def head_lines(lines: DataFrame, n: int = 200) -> DataFrame:
    """The first lines of the input in order, as a small development file."""
    return with_position(lines).orderBy("source_path", "source_pos").limit(n)
