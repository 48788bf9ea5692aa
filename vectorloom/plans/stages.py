"""The three layers as pure transformations, shared by batch and stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.config import DIMS, MODEL_NAME
from vectorloom.functions import fields
from vectorloom.functions.encoders import Encoder, encoder_udf
from vectorloom.functions.text import clean_text, strip
from vectorloom.functions.vectors import of_size
from vectorloom.operators.tables import compute_once


def parse_lines(lines: DataFrame) -> DataFrame:
    """Non-blank lines with their id, or the reason they are rejected."""
    stripped = compute_once(lines, raw_data=strip(F.col("value"))).where(F.col("raw_data") != "")
    record = fields.parse_record(F.col("raw_data"), "id VARIANT")
    parsed = compute_once(stripped, _record=record)
    checked = compute_once(parsed, arxiv_id=fields.scalar_id(F.col("_record")["id"]))
    return checked.select(
        *[c for c in lines.columns if c != "value"],
        "raw_data",
        "arxiv_id",
        F.when(F.col("_record").isNull(), F.lit("invalid JSON"))
        .when(F.col("arxiv_id").isNull(), F.lit("missing id"))
        .alias("reason"),
    )


def bronze_rows(accepted: DataFrame, base_id: int, at: Column, parts: Sequence[str] = ()) -> DataFrame:
    """Accepted lines in table shape, and the columns ``parts``; ids rise with file and line."""
    return accepted.select(
        (F.col("seq") + F.lit(base_id + 1)).alias("id"),
        "arxiv_id",
        "raw_data",
        "source_file",
        at.alias("ingested_at"),
        F.to_date(at).alias("ingested_on"),
        "seq",
        *parts,
    )


def clean_rows(
    bronze: DataFrame, at: Column, cleaner: Callable[[Column], Column] = clean_text
) -> DataFrame:
    """Raw records cleaned and normalised, with a reason where they are rejected.

    ``cleaner`` is the text rule for titles and abstracts.
    """
    record = F.col("_record")
    parsed = compute_once(bronze, _record=fields.parse_record(F.col("raw_data")))
    cleaned = compute_once(
        parsed,
        title=cleaner(record["title"]),
        abstract_clean=cleaner(record["abstract"]),
    )
    return cleaned.select(
        "id",
        "arxiv_id",
        "title",
        "abstract_clean",
        fields.names_text(record["authors"]).alias("authors"),
        fields.names_list(record["authors"]).alias("authors_list"),
        fields.tags(record["categories"]).alias("categories"),
        record["doi"].alias("doi"),
        record["journal-ref"].alias("journal_ref"),
        fields.iso_timestamp(record["published"]).alias("published"),
        at.alias("processed_at"),
        F.to_date(at).alias("processed_on"),
        F.when(F.col("abstract_clean").isNull(), F.lit("empty abstract"))
        .when(F.col("title").isNull(), F.lit("empty title"))
        .alias("reason"),
    )


def gold_rows(
    silver: DataFrame,
    factory: Callable[[], Encoder],
    at: Column,
    dims: Sequence[int] = DIMS,
    model_name: str = MODEL_NAME,
    text_cols: Sequence[str] = ("abstract_clean",),
) -> DataFrame:
    """One vector per size from a single encoder call per text."""
    text = F.col(text_cols[0]) if len(text_cols) == 1 else F.concat_ws("\n", *text_cols)
    embedded = silver.select("id", "arxiv_id", encoder_udf(factory, dims)(text).alias("v"))
    return embedded.select(
        "id",
        "arxiv_id",
        *[of_size(F.col("v")[f"embedding_{d}"], d).alias(f"embedding_{d}") for d in dims],
        F.lit(model_name).alias("model_name"),
        at.alias("embedded_at"),
        F.to_date(at).alias("embedded_on"),
    )
