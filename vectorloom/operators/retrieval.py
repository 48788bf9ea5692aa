"""Retrieval quality: rank of the true paper and the scores made of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.config import DIMS, MATCH_THRESHOLD, TOP_K
from vectorloom.operators.topk import top_k


def true_ranks(truth: DataFrame, ranked: DataFrame, dims: Sequence[int], id_col: str = "arxiv_id") -> DataFrame:
    """Rank of each query's true id at each size; null when it is not in the list.

    ``truth`` has ``query_id`` and ``true_id``.
    """
    asked = truth.withColumn("dim", F.explode(F.array(*[F.lit(d) for d in dims])))
    found = ranked.select("query_id", "dim", F.col(id_col).alias("true_id"), "rank")
    return asked.join(found, ["query_id", "dim", "true_id"], "left")


def scores(ranks: DataFrame, k: int = TOP_K, within: int = MATCH_THRESHOLD) -> DataFrame:
    """Accuracy, average rank and mean reciprocal rank per size; a miss has rank k+1."""
    if within > k:
        raise ValueError(f"a match within {within} cannot be found among {k}")
    rank = F.coalesce(F.col("rank"), F.lit(k + 1))
    return ranks.groupBy("dim").agg(
        F.count(F.lit(1)).alias("queries"),
        F.avg((rank <= within).cast("int")).alias("accuracy"),
        F.avg(rank).alias("avg_rank"),
        F.avg(F.lit(1.0) / rank).alias("mrr"),
    )


def evaluate(
    vectors: DataFrame,
    queries: DataFrame,
    truth: DataFrame,
    dims: Sequence[int] = DIMS,
    k: int = TOP_K,
    within: int = MATCH_THRESHOLD,
    id_col: str = "arxiv_id",
    vector_col: str = "embedding_384",
) -> DataFrame:
    """Scores per size from one scan of the full vectors."""
    ranked = top_k(vectors, queries, k, id_col, vector_col, dims=dims)
    return scores(true_ranks(truth, ranked, dims, id_col), k, within)
