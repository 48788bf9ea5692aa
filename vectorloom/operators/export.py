"""Writing records back to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vectorloom.sources.lines import block_starts, line_numbers


def write_jsonl(records: DataFrame, path: str) -> int:
    """JSON lines with null fields kept and text unescaped; returns the row count."""
    seen = Observation()
    out = records.observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return int(seen.get["rows"])


def split_parts(lines: DataFrame, parts: int = 3) -> DataFrame:
    """Number contiguous parts from 1: equal sizes, the last takes the rest.

    Fewer lines than parts: all of them are in the last part.
    """
    starts = block_starts(lines)
    total = starts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    numbered = line_numbers(lines, starts)
    size = total // parts
    part = F.lit(parts - 1) if size == 0 else F.least(
        F.lit(parts - 1), F.floor(F.col("line_index") / F.lit(size)).cast("int")
    )
    return numbered.withColumn("part", part + 1)


def write_parts(lines: DataFrame, path: str, parts: int = 3) -> None:
    """One folder of text files per part, lines in order inside each file."""
    split_parts(lines, parts).select("part", "value").write.mode("overwrite").partitionBy("part").text(path)
