"""Held-out rows and bounded samples of labelled ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows a classifier is fitted on.
SAMPLE = 20_000


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by five; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, most: int = SAMPLE) -> DataFrame:
    """(key, y) of at most ``most`` labelled ids that are not held out, those of smallest hash. Of several labels the largest counts."""
    return (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(F.xxhash64("key"), "key").limit(most)
    )
