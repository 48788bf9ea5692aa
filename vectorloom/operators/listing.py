"""Counts, first rows and work lists of the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.config import DIMS
from vectorloom.functions.text import preview
from vectorloom.functions.vectors import to_text
from vectorloom.session import new_folder


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def layer_counts(**layers: DataFrame) -> DataFrame:
    """One row per layer with its number of rows."""
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("layer"), "count")
            for name, df in layers.items()
        ]
    )


def key_counts(key: str, approximate: bool = False, **layers: DataFrame) -> DataFrame:
    """Rows and distinct keys per layer; equal numbers mean no duplicates."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return _stack(
        [
            df.agg(F.count(key).alias("total"), distinct(F.col(key)).alias("distinct_keys")).select(
                F.lit(name).alias("layer"), "total", "distinct_keys"
            )
            for name, df in layers.items()
        ]
    )


def unprocessed(upstream: DataFrame, downstream: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """Rows of one layer that the next does not have."""
    return upstream.join(downstream.select(key), key, "left_anti")


def work_list(pending: DataFrame, n: int, offset: int = 0, order: str = "id") -> DataFrame:
    """A page of pending rows by surrogate id."""
    return pending.orderBy(order).offset(offset).limit(n)


def missing_ids(wanted: DataFrame, present: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """Wanted ids the table does not have."""
    return wanted.join(present.select(key), key, "left_anti")


def require_ids(wanted: DataFrame, present: DataFrame, key: str = "arxiv_id", order: str | None = None) -> None:
    """Stop when wanted ids are missing; all of them are in the report table that the error names."""
    missing = missing_ids(wanted, present, key)
    path = new_folder(wanted.sparkSession, "missing-ids")
    (missing.orderBy(order) if order else missing).write.parquet(path)
    count = wanted.sparkSession.read.schema(missing.schema).parquet(path).count()
    if count:
        raise ValueError(f"{count} id(s) missing, listed in {path}")


def in_list(df: DataFrame, ids: DataFrame, key: str = "arxiv_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def peek_bronze(bronze: DataFrame, n: int = 2) -> DataFrame:
    return bronze.orderBy("id").limit(n).select(
        "id", "arxiv_id", "source_file", "ingested_at", preview(F.col("raw_data"), 120).alias("raw_data_preview")
    )


def peek_silver(silver: DataFrame, n: int = 2) -> DataFrame:
    return silver.orderBy("id").limit(n).select(
        "id",
        "arxiv_id",
        F.substring("title", 1, 60).alias("title"),
        preview(F.col("abstract_clean"), 80).alias("abstract_preview"),
        "categories",
        "processed_at",
    )


def peek_gold(gold: DataFrame, n: int = 2, dims=DIMS) -> DataFrame:
    short = [
        preview(to_text(F.col(f"embedding_{d}")), 40, "...]").alias(f"emb_{d}_preview") for d in dims
    ]
    return gold.orderBy("id").limit(n).select("id", "arxiv_id", "model_name", "embedded_at", *short)
