"""Semantic search over the gold and silver tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.config import DIMS, TOP_K
from vectorloom.functions.encoders import Encoder, encoder_udf
from vectorloom.functions.fields import any_tag, on_or_after
from vectorloom.functions.text import abs_url, pdf_url, preview
from vectorloom.functions.vectors import score, to_text
from vectorloom.operators.topk import top_k
from vectorloom.session import stored


def embed_queries(
    queries: DataFrame,
    factory: Callable[[], Encoder],
    text_col: str = "query",
    dims: Sequence[int] = DIMS,
) -> DataFrame:
    """Add ``query_vector``: the query text as it is, uncleaned, through the encoder."""
    full = max(dims)
    vectors = encoder_udf(factory, dims)(F.col(text_col))
    return queries.withColumn("query_vector", vectors[f"embedding_{full}"])


def search_filter(
    categories: Sequence[str] | None = None,
    since: str | None = None,
    tags_col: str = "categories",
    date_col: str = "published",
) -> Column:
    """Tag overlap and lower date bound; what is not given does not filter."""
    keep = F.lit(True)
    if categories:
        keep = keep & any_tag(F.col(tags_col), list(categories))
    if since:
        keep = keep & on_or_after(F.col(date_col), since)
    return keep


def search(
    gold: DataFrame,
    silver: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    dim: int = DIMS[0],
    where: Column | None = None,
    model_name: str | None = None,
    gold_within_silver: bool = False,
    query_id: str = "query_id",
) -> DataFrame:
    """Ranked papers of each query with title, score and links.

    ``where`` is a condition on silver, applied before ranking. Without it and
    with ``gold_within_silver`` (true for tables written by the stages, whose
    gold ids all come from silver) gold is only scanned; otherwise it is first
    cut to the ids silver has. Name the model when gold holds several.
    """
    # The head of the query stands for its truncated vector: cosine ignores length.
    queries = queries.withColumn("query_vector", F.slice("query_vector", 1, dim))
    vectors = gold
    if model_name is not None:
        vectors = vectors.where(F.col("model_name") == model_name)
    vectors = vectors.select("arxiv_id", f"embedding_{dim}")
    if where is not None:
        vectors = vectors.join(silver.where(where).select("arxiv_id"), "arxiv_id", "left_semi")
    elif not gold_within_silver:
        vectors = vectors.join(silver.select("arxiv_id"), "arxiv_id", "left_semi")
    ranked = top_k(vectors, queries, k, vector_col=f"embedding_{dim}", query_id=query_id)
    papers = silver.select("arxiv_id", "title", "authors", "categories", "abstract_clean")
    return ranked.join(papers, "arxiv_id").select(
        query_id,
        "rank",
        "arxiv_id",
        "title",
        "authors",
        "categories",
        "abstract_clean",
        score(F.col("distance")).alias("score"),
        abs_url(F.col("arxiv_id")).alias("arxiv_url"),
        pdf_url(F.col("arxiv_id")).alias("pdf_url"),
    )


def recent(gold: DataFrame, silver: DataFrame, n: int = 25, dim: int = DIMS[0]) -> DataFrame:
    """The n papers embedded last, numbered, with attributes and a vector preview.

    Ids and times alone decide which n they are; vectors and texts are fetched
    for those only.
    """
    by_time = [F.col("embedded_at").desc(), F.col("arxiv_id").asc()]
    newest = stored(
        gold.select("arxiv_id", "embedded_at")
        .join(silver.select("arxiv_id"), "arxiv_id", "left_semi")
        .orderBy(*by_time)
        .limit(n),
        "recent",
    )
    # At most n rows: bounded by the argument.
    vectors = gold.join(F.broadcast(newest), ["arxiv_id", "embedded_at"], "left_semi").select(
        "arxiv_id", "embedded_at", f"embedding_{dim}"
    )
    papers = silver.join(F.broadcast(newest.select("arxiv_id")), "arxiv_id", "left_semi")
    text = preview(to_text(F.col(f"embedding_{dim}")), 96)
    return (
        vectors.join(papers, "arxiv_id")
        .orderBy(*by_time)
        .limit(n)
        .withColumn("article_no", F.row_number().over(Window.orderBy(*by_time)))
        .select(
            "article_no",
            "arxiv_id",
            "title",
            "authors",
            "categories",
            "abstract_clean",
            text.alias(f"embedding_{dim}_preview"),
            abs_url(F.col("arxiv_id")).alias("arxiv_url"),
            pdf_url(F.col("arxiv_id")).alias("pdf_url"),
        )
    )
