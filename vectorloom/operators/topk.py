"""Exact nearest neighbours by cosine distance.

A bounded set of query vectors is broadcast; each task keeps the best k per
query over its own vectors and hands on only those. No pair of query and vector
ever becomes a row. All sizes of a nested vector are answered in one scan:
cosine ignores length, so a truncated vector ranks like the head of the full
one, and the sums of a shorter head are reused for the next longer one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.config import MAX_BROADCAST_KEYS, MAX_BROADCAST_QUERIES, TIE_DECIMALS, TOP_K
from vectorloom.session import scan_tasks

# Query-times-vector products held at once in a task.
_BLOCK_PRODUCTS = 2_000_000
# Hits of a block that are sorted at once.
_BLOCK_HITS = 250_000
# Rows of one query that the last ranking takes without merging groups first.
_MERGE_ROWS = 200_000
# Vectors per group where the queries are too many to broadcast.
_VECTOR_BLOCK = 50_000


class _Best:
    """The k best of each query so far, as flat arrays."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.bound = np.full(queries, np.inf)
        self.query = np.zeros(0, dtype=np.int64)
        self.distance = np.zeros(0)
        self.ids: np.ndarray | None = None

    def add(self, distance: np.ndarray, ids: pa.Array, columns: np.ndarray | None = None) -> None:
        """Take in a block of distances, rows by queries (all, or those of ``columns``); NaN never counts."""
        hit = distance <= (self.bound if columns is None else self.bound[columns])
        if hit.sum() > 2 * self.k * hit.shape[1] and len(distance) > self.k:
            filled = np.where(hit, distance, np.inf)
            kth = np.partition(filled, self.k - 1, axis=0)[self.k - 1]
            hit &= distance <= kth
        if hit.sum() > _BLOCK_HITS and len(distance) > 1:
            # Copies tie at the bound, and all of them count until the ids decide.
            half = len(distance) // 2
            self.add(distance[:half], ids.slice(0, half), columns)
            self.add(distance[half:], ids.slice(half), columns)
            return
        row, query = np.nonzero(hit)
        if not len(row):
            return
        found = distance[row, query]
        query = query if columns is None else columns[query]
        new_ids = np.asarray(ids.take(pa.array(row)).to_pylist())
        all_ids = new_ids if self.ids is None else np.concatenate([self.ids, new_ids])
        queries = np.concatenate([self.query, query])
        distances = np.concatenate([self.distance, found])
        order = np.lexsort((all_ids, distances, queries))
        queries, distances, all_ids = queries[order], distances[order], all_ids[order]
        first = np.searchsorted(queries, queries, side="left")
        place = np.arange(len(queries)) - first
        keep = place < self.k
        self.query, self.distance, self.ids = queries[keep], distances[keep], all_ids[keep]
        full = place == self.k - 1
        self.bound[queries[full]] = distances[full]


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    lengths = pc.list_value_length(vectors)
    if len(vectors) and (pc.min(lengths).as_py() != size or pc.max(lengths).as_py() != size):
        raise ValueError(f"a vector does not have {size} components")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _scan(
    batches: Iterator[tuple[pa.Array, pa.Array]],
    matrix: np.ndarray,
    dims: Sequence[int],
    k: int,
) -> dict[int, _Best]:
    """Best k per query and size over the batches of one task."""
    count, size = matrix.shape
    best = {d: _Best(count, k) for d in dims}
    lengths = {d: np.sqrt((matrix[:, :d] ** 2).sum(axis=1)) for d in dims}
    step = max(1, _BLOCK_PRODUCTS // max(1, count))
    for ids, vectors in batches:
        present = pc.and_(ids.is_valid(), vectors.is_valid())
        if not pc.all(present).as_py():
            ids, vectors = ids.filter(present), vectors.filter(present)
        for start in range(0, len(ids), step):
            block = _matrix(vectors.slice(start, step), size)
            products = np.zeros((len(block), count))
            squares = np.zeros(len(block))
            done = 0
            for d in sorted(dims):
                products += block[:, done:d] @ matrix[:, done:d].T
                squares += (block[:, done:d] ** 2).sum(axis=1)
                done = d
                # One array holds what becomes the distance.
                distance = np.sqrt(squares)[:, None] * lengths[d][None, :]
                with np.errstate(divide="ignore", invalid="ignore"):
                    np.divide(products, distance, out=distance)
                np.round(np.subtract(1.0, distance, out=distance), TIE_DECIMALS, out=distance)
                distance[~np.isfinite(distance)] = np.nan
                best[d].add(distance, ids.slice(start, step))
    return best


def _emit(best: dict[int, _Best], query_ids: pa.Array, id_type: pa.DataType, names: list[str]):
    for d, found in best.items():
        if found.ids is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    query_ids.take(pa.array(found.query)),
                    pa.array(np.full(len(found.query), d, dtype=np.int32)),
                    pa.array(found.ids.tolist(), type=id_type),
                    pa.array(found.distance),
                ],
                names=names,
            )


def _output(vectors: DataFrame, queries: DataFrame, query_id: str, id_col: str) -> tuple[str, list[str]]:
    q, v = queries.schema[query_id].dataType, vectors.schema[id_col].dataType
    names = [query_id, "dim", id_col, "distance"]
    return f"`{query_id}` {q.simpleString()}, dim INT, `{id_col}` {v.simpleString()}, distance DOUBLE", names


def best_of(candidates: DataFrame, query_id: str, id_col: str, k: int, tasks: int) -> DataFrame:
    """Rank the candidates of all tasks; equal distances go by id.

    Where many tasks each hand on k rows for a query, they are merged in groups
    first, so the last step sees at most k rows of each group.
    """
    order = [F.col("distance").asc(), F.col(id_col).asc()]

    def nearest(rows: DataFrame, *keys: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn("rank", place).where(F.col("rank") <= k)

    if tasks * k > _MERGE_ROWS:
        groups = max(2, math.isqrt(tasks))
        grouped = candidates.withColumn("_group", F.spark_partition_id() % groups)
        candidates = nearest(grouped, "_group", "dim", query_id).drop("_group", "rank")
    return nearest(candidates, "dim", query_id)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    id_col: str = "arxiv_id",
    vector_col: str = "embedding_384",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    dims: Sequence[int] | None = None,
    max_broadcast: int = MAX_BROADCAST_QUERIES,
) -> DataFrame:
    """The k nearest vectors of each query: query id, dim, id, distance, rank.

    ``dims`` are the head lengths to answer for; the default is the full vector.
    Vectors of length zero have no direction and are never returned. The query
    set is counted first; beyond ``max_broadcast`` it stays distributed. A result
    of a bounded size carries a broadcast hint, so a later join with a large
    table scans that table and does not shuffle it.
    """
    wanted = queries.select(query_id, query_vector).where(F.col(query_vector).isNotNull())
    head = wanted.limit(max_broadcast + 1).toArrow()
    if head.num_rows > max_broadcast:
        return _top_k_blocks(vectors, wanted, k, id_col, vector_col, query_id, query_vector, dims, max_broadcast)
    schema, names = _output(vectors, queries, query_id, id_col)
    if head.num_rows == 0:
        return best_of(vectors.sparkSession.createDataFrame([], schema), query_id, id_col, k, 1)
    query_vectors = head.column(1).combine_chunks()
    size = len(query_vectors[0])
    shared = vectors.sparkSession.sparkContext.broadcast(
        (_matrix(query_vectors, size), head.column(0).combine_chunks())
    )
    sizes = tuple(dims or (size,))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, ids = shared.value
        id_type = None

        def pairs():
            nonlocal id_type
            for batch in batches:
                id_type = batch.column(0).type
                yield batch.column(0), batch.column(1)

        best = _scan(pairs(), matrix, sizes, k)
        yield from _emit(best, ids, id_type, names)

    rows = vectors.select(id_col, vector_col)
    ranked = best_of(rows.mapInArrow(nearest, schema), query_id, id_col, k, scan_tasks(rows))
    # The queries were counted, so the size of the result is known as well.
    return F.broadcast(ranked) if head.num_rows * k * len(sizes) <= MAX_BROADCAST_KEYS else ranked


def _top_k_blocks(
    vectors, queries, k, id_col, vector_col, query_id, query_vector, dims, block
) -> DataFrame:
    """The same for any number of queries: blocks of queries meet blocks of vectors.

    Row counts give the number of blocks, rows are dealt to them in turn, so
    none depends on a key. A group sees one block of each side and hands on k
    rows per query.
    """
    schema, names = _output(vectors, queries, query_id, id_col)
    query_blocks = max(1, math.ceil(queries.count() / block))
    vector_blocks = max(1, math.ceil(vectors.count() / _VECTOR_BLOCK))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    deal = F.spark_partition_id() + row
    left = (
        vectors.select(id_col, vector_col)
        .withColumn("_v", (deal % vector_blocks).cast("int"))
        .withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )
    right = (
        queries.select(query_id, query_vector)
        .withColumn("_q", (deal % query_blocks).cast("int"))
        .withColumn("_v", F.explode(F.sequence(F.lit(0), F.lit(vector_blocks - 1))))
    )

    def nearest(block_vectors: pa.Table, block_queries: pa.Table) -> pa.Table:
        out_schema = None
        batches = []
        if block_vectors.num_rows and block_queries.num_rows:
            ids = block_vectors.column(id_col).combine_chunks()
            rows = block_vectors.column(vector_col).combine_chunks()
            query_rows = block_queries.column(query_vector).combine_chunks()
            size = len(query_rows[0])
            best = _scan(iter([(ids, rows)]), _matrix(query_rows, size), tuple(dims or (size,)), k)
            batches = list(_emit(best, block_queries.column(query_id).combine_chunks(), ids.type, names))
        if not batches:
            out_schema = pa.schema(
                [
                    (query_id, block_queries.schema.field(query_id).type),
                    ("dim", pa.int32()),
                    (id_col, block_vectors.schema.field(id_col).type),
                    ("distance", pa.float64()),
                ]
            )
        return pa.Table.from_batches(batches, out_schema)

    found = left.groupBy("_q", "_v").cogroup(right.groupBy("_q", "_v")).applyInArrow(nearest, schema)
    return best_of(found, query_id, id_col, k, vector_blocks)
