"""Approximate nearest neighbours: vectors stored by cluster, few clusters read.

Centres, such as those of MLlib k-means, split the vectors into cells, one table partition each. A query
reads the cells whose centres are nearest to it, so the scan shrinks with the
share of cells probed, and ranks their vectors exactly. Probing every cell
gives the exact answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.config import MAX_BROADCAST_QUERIES, TIE_DECIMALS, TOP_K
from vectorloom.operators.topk import _emit, _matrix, _output, _scan, best_of
from vectorloom.session import scan_tasks, stored

def _nearness(matrix: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Cosine of every row to every centre; rounded, so that ties go by the number of the centre."""
    lengths = np.maximum(np.linalg.norm(matrix, axis=1), 1e-300)[:, None]
    return np.round((matrix / lengths) @ (centres / np.linalg.norm(centres, axis=1, keepdims=True)).T, TIE_DECIMALS)


def fit_centres(
    vectors: DataFrame, cells: int, vector_col: str = "embedding_384", seed: int = 7, rounds: int = 20
) -> np.ndarray:
    """Centres of k-means by cosine, fitted on all vectors."""
    points = _with_direction(vectors, vector_col).select(
        array_to_vector(F.col(vector_col).cast("array<double>")).alias("features")
    )
    model = KMeans(k=cells, seed=seed, distanceMeasure="cosine", maxIter=rounds).fit(points)
    return np.asarray(model.clusterCenters())


def _with_direction(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Without vectors of length zero, which no search returns either."""
    column = F.col(vector_col)
    return vectors.where(column.isNotNull() & F.exists(column, lambda x: x != 0))


def build_cells(
    vectors: DataFrame,
    path: str,
    centres: np.ndarray,
    id_col: str = "arxiv_id",
    vector_col: str = "embedding_384",
) -> None:
    """Write the vectors under ``path``, each in the cell of its nearest centre.

    The centres, from ``fit_centres`` or any other source, are sent to every
    task: their number is the caller's choice. Rebalancing splits a cell that
    holds a large part of the rows.
    """
    rows = _with_direction(vectors, vector_col).select(id_col, vector_col)
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _nearness(_matrix(batch.column(1), shared.value.shape[1]), shared.value)
            cell = pa.array(near.argmax(axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, cell], [*batch.schema.names, "cell"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    (
        rows.mapInArrow(placed, f"{fields}, cell INT")
        .hint("rebalance", "cell")
        .write.mode("overwrite")
        .partitionBy("cell")
        .parquet(path)
    )


def top_k_cells(
    spark: SparkSession,
    path: str,
    centres: np.ndarray,
    queries: DataFrame,
    probes: int,
    k: int = TOP_K,
    id_col: str = "arxiv_id",
    vector_col: str = "embedding_384",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    max_queries: int = MAX_BROADCAST_QUERIES,
) -> DataFrame:
    """Nearest vectors of each query among its ``probes`` nearest cells.

    How many cells a recall needs depends on how clustered the vectors are:
    measure it with ``recall``. A cell is multiplied only with the queries that
    probe it. More queries than ``max_queries`` go in blocks, one pass over the
    cells that the block probes each.
    """
    cells = spark.read.parquet(path)
    wanted = queries.select(query_id, query_vector).where(F.col(query_vector).isNotNull())
    # Stored, as the frame may hold the encoder and is counted and read.
    wanted = stored(wanted, "queries")
    blocks = max(1, -(-wanted.count() // max_queries))
    found = None
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == block) if blocks > 1 else wanted
        one = _probe(cells, centres, part, queries, probes, k, id_col, vector_col, query_id)
        found = one if found is None else found.unionByName(one)
    return found


def _probe(cells, centres, part, queries, probes, k, id_col, vector_col, query_id) -> DataFrame:
    asked = part.toArrow()
    size = centres.shape[1]
    matrix = _matrix(asked.column(1).combine_chunks(), size)
    allowed = np.zeros((len(matrix), len(centres)), dtype=bool)
    chosen = np.argsort(-_nearness(matrix, centres), axis=1, kind="stable")[:, :probes]
    np.put_along_axis(allowed, chosen, True, axis=1)
    probed = [int(c) for c in np.flatnonzero(allowed.any(axis=0))]
    schema, names = _output(cells, queries, query_id, id_col)
    shared = cells.sparkSession.sparkContext.broadcast((matrix, allowed, asked.column(0).combine_chunks()))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, probing, ids = shared.value
        for batch in batches:
            cell = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1), len(cell)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                mine = np.flatnonzero(probing[:, cell[lo]]) if hi > lo else []
                if len(mine):
                    run = batch.slice(lo, hi - lo)
                    best = _scan(iter([(run.column(0), run.column(1))]), vectors[mine], (size,), k)
                    yield from _emit(best, ids.take(pa.array(mine)), run.column(0).type, names)

    rows = cells.where(F.col("cell").isin(probed)).select(id_col, vector_col, "cell")
    return best_of(rows.mapInArrow(nearest, schema), query_id, id_col, k, scan_tasks(rows))


def recall(approximate: DataFrame, exact: DataFrame, query_id: str, id_col: str) -> DataFrame:
    """Share of the exact answers that the approximate search found."""
    hits = exact.select(query_id, id_col).join(
        approximate.select(query_id, id_col).withColumn("found", F.lit(1)), [query_id, id_col], "left"
    )
    return hits.agg(F.try_divide(F.count("found"), F.count(F.lit(1))).alias("recall"))
