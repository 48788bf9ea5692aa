"""Retrieval test cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vectorloom.schemas import TEST_CASE


def read_test_set(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array file of ``{arxiv_id, abstract, query}``."""
    return spark.read.schema(TEST_CASE).json(path, multiLine=True)
