"""Event-time checkpoint of a polling source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.functions.fields import iso_timestamp


def parse_checkpoint(value: Column, now: Column) -> Column:
    """Stored time; 24 hours back when it is missing or unreadable."""
    return F.coalesce(iso_timestamp(value), now - F.expr("INTERVAL 24 HOURS"))


def newest_published(published: Column, since: Column) -> Column:
    """Aggregate: the latest readable time, never before ``since``."""
    return F.greatest(F.max(published), since)


def next_checkpoint(
    batch: DataFrame, since: Column, cycle_start: Column, published: str = "published"
) -> DataFrame:
    """One row with the next checkpoint.

    Something new: one second after the newest paper. Nothing new: the start of
    the cycle. A feed without times passes ``cycle_start`` for ``since``.
    """
    rows = batch.agg(
        F.count(F.lit(1)).alias("rows"), newest_published(F.col(published), since).alias("newest")
    )
    after = F.col("newest") + F.expr("INTERVAL 1 SECOND")
    return rows.select("rows", "newest", F.when(F.col("rows") > 0, after).otherwise(cycle_start).alias("checkpoint"))


def pages_newest(pages: DataFrame, since: Column, published: str = "published") -> DataFrame:
    """Newest time of each fetched page."""
    return pages.groupBy("page").agg(
        F.count(F.lit(1)).alias("rows"), newest_published(F.col(published), since).alias("newest")
    )
