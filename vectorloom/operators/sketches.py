"""Distinct keys of a growing table, kept up to date by a sketch for each day.

A day's sketch (HyperLogLog, from Spark's ``hll_`` functions) is made once; a refresh counts rows per day from the day column alone and sketches only days whose
number of rows has changed. Any span of days is then the union of a few kilobytes per day, not a count over all keys again.

The relative standard error is 1.04 / sqrt(2^bits), 0.8 % for 14 bits. Null keys count as rows but not as keys; rows without a day form
a day of their own. A table in which rows are replaced and none added needs ``force``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.operators.compacted import CompactedLog
from vectorloom.operators.tables import newest_by_key

BITS = 14


def relative_error(bits: int = BITS) -> float:
    """Standard error of an estimate, as a share of it."""
    return 1.04 / 2 ** (bits / 2)


class KeySketches:
    SCHEMA = "day date, version long, rows long, total long, sketch binary"

    def __init__(self, spark: SparkSession, root: str, bits: int = BITS, every: int = 50):
        self.bits = bits
        self.log = CompactedLog(spark, root, self.SCHEMA, lambda rows: newest_by_key(rows, ["day"], "version"), every)

    def refresh(self, df: DataFrame, key: str, day: str, force: bool = False) -> int:
        """Sketch the days that have gained rows; returns their number."""
        known = self.log.read()
        version = (known.agg(F.max("version")).first()[0] or 0) + 1
        keyed = df.select(F.col(day).cast("date").alias("day"), F.col(key).alias("key"))
        if not force:
            counts = keyed.groupBy("day").agg(F.count("*").alias("now"))
            behind = counts.join(known.select(F.col("day").alias("old_day"), "rows"), F.col("day").eqNullSafe(F.col("old_day")), "left")
            behind = behind.where(~F.col("now").eqNullSafe(F.col("rows"))).select(F.col("day").alias("new_day"))
            keyed = keyed.join(behind, F.col("day").eqNullSafe(F.col("new_day")), "left_semi")
        made = keyed.groupBy("day").agg(
            F.lit(version).cast("long").alias("version"), F.count("*").alias("rows"), F.count("key").alias("total"),
            F.hll_sketch_agg("key", F.lit(self.bits)).alias("sketch"),
        )
        self.log.append(made)
        return self.log.read().where(F.col("version") == version).count()

    def days(self) -> DataFrame:
        return self.log.read().select("day", "rows", "total", "sketch")

    def counts(self, *by) -> DataFrame:
        """total and distinct_keys (estimated) of all days, or by columns made of ``day``."""
        merged = self.days().groupBy(*by).agg(
            F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.hll_union_agg("sketch").alias("sketch")
        )
        return merged.withColumn("distinct_keys", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0))).drop("sketch")
