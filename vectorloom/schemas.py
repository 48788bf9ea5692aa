"""Table schemas of the layers, as Spark DDL."""

from __future__ import annotations

from collections.abc import Sequence

from vectorloom.config import DIMS

# Layer name -> schema.table
LAYERS = {
    "bronze": "bronze.arxiv_raw",
    "silver": "silver.arxiv_abstracts",
    "gold": "gold.arxiv_embeddings",
    "state": "streaming.state",
    "runs": "streaming.runs",
    "rejects": "streaming.rejects",
}

BRONZE = (
    "id BIGINT, arxiv_id STRING, raw_data STRING, source_file STRING, "
    "ingested_at TIMESTAMP, ingested_on DATE"
)
SILVER = (
    "id BIGINT, arxiv_id STRING, title STRING, abstract_clean STRING, authors STRING, "
    "authors_list ARRAY<STRING>, categories ARRAY<STRING>, doi STRING, journal_ref STRING, "
    "published TIMESTAMP, processed_at TIMESTAMP, processed_on DATE"
)
STATE = "key STRING, value STRING, version BIGINT, updated_at TIMESTAMP"
RUNS = (
    "run_id STRING, batch_id BIGINT, bronze BIGINT, silver BIGINT, gold BIGINT, "
    "skipped BIGINT, started_at TIMESTAMP, finished_at TIMESTAMP, status STRING"
)
REJECTS = (
    "stage STRING, arxiv_id STRING, source_file STRING, source_pos BIGINT, "
    "raw_data STRING, reason STRING, rejected_at TIMESTAMP"
)
# One parsed feed entry; also the shape of a JSON-lines record.
RECORD = (
    "id STRING, title STRING, abstract STRING, authors ARRAY<STRING>, "
    "categories ARRAY<STRING>, doi STRING, `journal-ref` STRING, published STRING"
)
TEST_CASE = "arxiv_id STRING, abstract STRING, query STRING"


def gold(dims: Sequence[int] = DIMS) -> str:
    vectors = ", ".join(f"embedding_{d} ARRAY<FLOAT>" for d in dims)
    return (
        f"id BIGINT, arxiv_id STRING, {vectors}, model_name STRING, "
        "embedded_at TIMESTAMP, embedded_on DATE"
    )
