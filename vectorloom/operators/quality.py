"""Data-quality metrics: one row each, with threshold and verdict."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.functions.fields import valid_id


@dataclass(frozen=True)
class Metric:
    name: str
    definition: str
    compare: str
    threshold: float
    cadence: str


# Names, thresholds and cadences of the data contract.
COMPLETENESS = Metric(
    "Embedding Completeness", "% of raw papers that have a vector", ">", 98.0, "Every pipeline run"
)
FRESHNESS = Metric("Abstract Freshness", "Hours since the last successful sync", "<", 48.0, "Daily")
VALIDITY = Metric(
    "Schema Validity", "% of records with a valid id, a title and an abstract", "=", 100.0, "Every pipeline run"
)
DIMENSIONS = Metric(
    "Vector Dimension Consistency", "% of vectors with the expected size", "=", 100.0, "Every pipeline run"
)
_COMPARE = {
    ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "=": operator.eq,
}


def percent(condition: Column) -> Column:
    """Share of rows that meet a condition, null for an empty table."""
    return F.try_divide(F.count_if(condition) * F.lit(100.0), F.count(F.lit(1)))


def embedding_completeness(papers: DataFrame, vectors: DataFrame, key: str, vector_col: str) -> DataFrame:
    """Papers with a vector, in percent.

    The vector table is reduced to one row per key first, so repeated keys do
    not multiply the papers.
    """
    have = vectors.where(F.col(vector_col).isNotNull()).select(key).distinct().withColumn("_has", F.lit(True))
    return papers.select(key).join(have, key, "left").agg(percent(F.coalesce("_has", F.lit(False))).alias("value"))


def freshness_hours(runs: DataFrame, synced_at: str, now: Column, success: Column | None = None) -> DataFrame:
    """Hours between the last successful run and ``now``."""
    done = runs if success is None else runs.where(success)
    seconds = F.unix_micros(now) - F.unix_micros(F.max(synced_at).cast("timestamp"))
    return done.agg((seconds / F.lit(3.6e9)).alias("value"))


def schema_validity(papers: DataFrame, key: str, title: str, abstract: str) -> DataFrame:
    good = F.coalesce(valid_id(F.col(key)), F.lit(False))
    good = good & F.col(title).isNotNull() & F.col(abstract).isNotNull()
    return papers.agg(percent(good).alias("value"))


def dimension_consistency(vectors: DataFrame, vector_col: str, dim: int) -> DataFrame:
    right = F.coalesce(F.size(vector_col) == dim, F.lit(False)) & F.col(vector_col).isNotNull()
    return vectors.agg(percent(right).alias("value"))


def column_profile(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Row count, uniqueness of the key and share of filled values in one pass."""
    filled = [percent(F.col(c).isNotNull()).alias(f"{c}_filled_pct") for c in columns]
    unique = F.try_divide(F.count_distinct(F.col(key)) * F.lit(100.0), F.count(F.lit(1)))
    return df.agg(F.count(F.lit(1)).alias("row_count"), unique.alias("unique_pct"), *filled)


def rule_validity(df: DataFrame, **rules: Column) -> DataFrame:
    """Share of rows that meet each rule; an unknown result does not."""
    return df.agg(*[percent(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])


def list_consistency(df: DataFrame, column: str, reference: DataFrame, reference_col: str) -> DataFrame:
    """Share of rows whose value is in the reference list.

    Values are counted before the join, so a frequent value is one row.
    """
    counts = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    known = reference.select(F.col(reference_col).alias("_value")).distinct().withColumn("_known", F.lit(True))
    return counts.join(known, "_value", "left").agg(
        F.try_divide(
            F.sum(F.when(F.col("_known"), F.col("_rows")).otherwise(0)) * F.lit(100.0), F.sum("_rows")
        ).alias("value")
    )


def verdict(value: DataFrame, metric: Metric) -> DataFrame:
    """A metric row: name, definition, value, threshold, cadence, passed."""
    passed = _COMPARE[metric.compare](F.col("value"), F.lit(metric.threshold))
    return value.select(
        F.lit(metric.name).alias("metric"),
        F.lit(metric.definition).alias("definition"),
        F.col("value").cast("double").alias("value"),
        F.lit(f"{metric.compare} {metric.threshold:g}").alias("threshold"),
        F.lit(metric.cadence).alias("cadence"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def report(*rows: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)
