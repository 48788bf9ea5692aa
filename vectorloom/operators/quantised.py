"""Compressed approximate search: cells, product codes of what is left of a vector, exact ranking of a short list.

A vector of length one lies in the cell of its nearest centre; what remains after taking off the centre is cut into parts, and of each part only
the number of the nearest code word is kept, one byte. A query reads the codes of its nearest cells, a few bytes a vector instead of all its
components; the distance to a code is a sum of numbers looked up in a table that the query makes once for each cell. The best of
these, ``shortlist`` for each query, are then ranked by their full vectors, which are read from the same cells and never shuffled
while the short lists are few enough to be broadcast.

Up to ``max_queries`` queries are broadcast and the codes stay where they are read. More of them are sent to the cells they visit; cells and
their queries are cut into blocks, so a cell with a third of all vectors is many tasks. Vectors and queries without a direction (null, zero,
with a null or non-finite component) are left out. Equal distances go by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vectorloom.config import MAX_BROADCAST_KEYS, MAX_BROADCAST_QUERIES, TIE_DECIMALS, TOP_K
from vectorloom.functions import vectors as vec
from vectorloom.operators.approx import _nearness, fit_centres
from vectorloom.operators.topk import _Best, _emit, _matrix, _output, best_of
from vectorloom.session import scan_tasks, stored

#: Code words are fitted on at most this many vectors; centres on all, and all vectors get codes.
SAMPLE, ROUNDS = 50_000, 12
#: Most members, and most queries, of one unit of work where queries are sent to the cells.
MEMBERS, ASKING = 65_536, 2048
_PRODUCTS = 2_000_000


@dataclass(frozen=True)
class Codebooks:
    """``centres``: cells by components. ``words``: parts by code words (at most 256) by components of a part."""

    centres: np.ndarray
    words: np.ndarray

    def __post_init__(self):
        parts, codes, width = self.words.shape
        if codes > 256 or parts * width != self.centres.shape[1]:
            raise ValueError(f"{parts} parts of {width} components with {codes} words do not fit centres of {self.centres.shape[1]}")


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]


def _directed(df: DataFrame, vector_col: str) -> DataFrame:
    column = F.col(vector_col)
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(finite & F.exists(column, lambda x: x != 0))


def residuals(matrix: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest cell of each vector and what is left of it there."""
    cell = _nearness(matrix, centres).argmax(axis=1)
    return cell, _unit(matrix) - _unit(centres)[cell]


def _squares(left: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances of (rows, parts, width) to the words of each part: rows by parts by codes."""
    out = np.zeros((len(left), *words.shape[:2]))
    for i in range(words.shape[2]):
        out += (left[:, :, None, i] - words[None, :, :, i]) ** 2
    return out


def encode(matrix: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Cell and codes of each vector; of equally near words the first."""
    cell, left = residuals(matrix, books.centres)
    parts, _, width = books.words.shape
    codes = np.zeros((len(matrix), parts), np.uint8)
    for lo in range(0, len(matrix), 512):
        some = left[lo : lo + 512].reshape(-1, parts, width)
        codes[lo : lo + 512] = np.round(_squares(some, books.words), TIE_DECIMALS).argmin(axis=2)
    return cell, codes


def _lloyd(points: np.ndarray, codes: int) -> np.ndarray:
    points_once = np.unique(points, axis=0)
    words = points_once[np.linspace(0, len(points_once) - 1, min(codes, len(points_once))).astype(int)]
    for _ in range(ROUNDS):
        near = np.concatenate([
            ((words * words).sum(1)[None, :] - 2 * points[lo : lo + 4096] @ words.T).argmin(axis=1) for lo in range(0, len(points), 4096)
        ])
        size = np.bincount(near, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, near, points)
        words = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], words)
    return words


def fit_codebooks(
    vectors: DataFrame, cells: int, parts: int, codes: int = 256, vector_col: str = "embedding_384", sample: int = SAMPLE
) -> Codebooks:
    """Centres by k-means over all vectors; code words by Lloyd's method, parts dealt over tasks, over a bounded sample drawn by hash.

    A part with fewer different values than ``codes`` repeats its last word.
    """
    centres = fit_centres(vectors, cells, vector_col)
    parts_width = centres.shape[1] // parts
    shared = vectors.sparkSession.sparkContext.broadcast(centres)
    drawn = _directed(vectors, vector_col).select(F.col(vector_col).alias("v")).orderBy(F.xxhash64("v")).limit(sample)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, left = residuals(_matrix(batch.column(0), shared.value.shape[1]), shared.value)
            flat = left.reshape(-1, parts_width)
            number = np.tile(np.arange(parts, dtype=np.int32), len(left))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), parts_width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(number), lists], ["part", "x"])

    def fitted(rows: pa.Table) -> pa.Table:
        points = _matrix(rows.column("x").combine_chunks(), parts_width)
        words = _lloyd(points, codes)
        number = rows.column("part")[0].as_py()
        return pa.table({
            "part": pa.array([number] * len(words), pa.int32()), "code": pa.array(range(len(words)), pa.int32()), "word": pa.array(words.tolist())
        })

    # Dealt in a given number of tasks, which adaptive execution does not merge into one.
    found = drawn.mapInArrow(cut, "part INT, x ARRAY<DOUBLE>").repartition(parts, "part").groupBy("part").applyInArrow(fitted, "part INT, code INT, word ARRAY<DOUBLE>")
    words = np.zeros((parts, codes, parts_width))
    for row in sorted(found.collect(), key=lambda r: (r.part, r.code)):  # at most 256 words for each part
        words[row.part, row.code :] = row.word
    return Codebooks(centres, words)


def build_quantised(vectors: DataFrame, path: str, books: Codebooks, id_col: str = "arxiv_id", vector_col: str = "embedding_384") -> None:
    """Write ids, vectors and codes under ``path``, a table partition for each cell; a search of codes reads no vector.

    Cell -1 holds a file without rows, which gives a table without vectors its columns.
    """
    rows = _directed(vectors, vector_col).where(F.col(id_col).isNotNull()).select(id_col, vector_col)
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, codes = encode(_matrix(batch.column(1), shared.value.centres.shape[1]), shared.value)
            packed = pa.array([c.tobytes() for c in codes], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, packed, pa.array(cell.astype(np.int32))], [*batch.schema.names, "code", "cell"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    (
        rows.mapInArrow(coded, f"{fields}, code BINARY, cell INT")
        .hint("rebalance", "cell")
        .write.mode("overwrite").partitionBy("cell").parquet(path)
    )
    vectors.sparkSession.createDataFrame([], f"{fields}, code BINARY").write.parquet(f"{path}/cell=-1")


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, parts)


def _near(ids: pa.Array, codes: np.ndarray, cell: int, asked: np.ndarray, bound: np.ndarray, books: Codebooks, k: int) -> _Best:
    """The k members of a cell with the nearest codes for each query, none beyond its bound."""
    parts, count, width = books.words.shape
    best = _Best(len(asked), k)
    best.bound = bound
    centre = _unit(books.centres[cell : cell + 1])
    # The tables of some queries at a time: parts by words for each of them.
    some = max(1, _PRODUCTS // (parts * count))
    for lo in range(0, len(asked), some):
        tables = _squares((asked[lo : lo + some] - centre).reshape(-1, parts, width), books.words)
        step = max(1, _PRODUCTS // len(tables))
        for at in range(0, len(codes), step):
            distance = sum(tables[:, p, codes[at : at + step, p]] for p in range(parts))
            best.add(np.round(distance.T, TIE_DECIMALS), ids.slice(at, step), np.arange(lo, lo + len(tables)))
    return best


def _broadcast_way(cells, asked, books, probes, k, schema, names, id_col, query_id) -> tuple[DataFrame, list[int]]:
    """Candidates where the queries are few: they go to the codes; also the cells that anyone visits."""
    table = asked.toArrow()
    matrix = _matrix(table.column(1).combine_chunks(), books.centres.shape[1])
    chosen = np.argsort(-_nearness(matrix, books.centres), axis=1, kind="stable")[:, :probes]
    probing = np.zeros((len(matrix), len(books.centres)), bool)
    np.put_along_axis(probing, chosen, True, axis=1)
    visited = [int(c) for c in np.flatnonzero(probing.any(axis=0))]
    shared = cells.sparkSession.sparkContext.broadcast((_unit(matrix), probing, table.column(0).combine_chunks(), books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, probing, ids, books = shared.value
        bound = np.full(len(unit), np.inf)  # k members nearer than this have been handed on
        for batch in batches:
            cell = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1), len(cell)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                mine = np.flatnonzero(probing[:, cell[lo]]) if hi > lo else []
                if len(mine):
                    part = batch.slice(lo, hi - lo)
                    best = _near(part.column(0), _codes(part.column(1), books.words.shape[0]), cell[lo], unit[mine], bound[mine], books, k)
                    bound[mine] = best.bound
                    yield from _emit({0: best}, ids.take(pa.array(mine)), part.column(0).type, names)

    rows = cells.where(F.col("cell").isin(visited)).select(id_col, "code", "cell")
    return rows.mapInArrow(run, schema), visited


def _sent_way(cells, asked, books, probes, k, schema, names, id_col, query_id) -> DataFrame:
    """Candidates where the queries are many: they are sent to the cells they visit, in blocks on both sides."""
    spark = cells.sparkSession
    shared = spark.sparkContext.broadcast(books)
    id_type, query_type = (df.schema[c].dataType.simpleString() for df, c in ((cells, id_col), (asked, query_id)))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value.centres
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                near = _nearness(_matrix(batch.column(1), centres.shape[1]), centres)
                chosen = np.argsort(-near, axis=1, kind="stable")[:, :probes]
                where = pa.array(np.repeat(np.arange(len(chosen)), chosen.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chosen.ravel().astype(np.int32)), batch.column(0).take(where), batch.column(1).take(where)], ["cell", "query", "vector"]
                )

    vector_type = asked.schema[asked.columns[1]].dataType.simpleString()
    sent = asked.mapInArrow(visits, f"cell INT, query {query_type}, vector {vector_type}")
    held = cells.groupBy("cell").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("blocks"))
    asking = sent.groupBy("cell").agg(F.ceil(F.count("*") / ASKING).cast("int").alias("groups"))
    units = F.broadcast(stored(held.join(asking, "cell"), "units"))  # a row for each cell
    members = cells.join(units, "cell").select(
        "cell", F.pmod(F.xxhash64(id_col), "blocks").cast("int").alias("a"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("b"),
        F.col(id_col).alias("id"), "code",
    )
    visiting = sent.join(units, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("a"), F.pmod(F.xxhash64("query"), "groups").cast("int").alias("b"), "query", "vector"
    )
    kinds = pa.schema(list(zip(names, (
        asked.limit(1).select(query_id).toArrow().schema.field(0).type, pa.int32(), cells.limit(1).select(id_col).toArrow().schema.field(0).type, pa.float64()
    ))))

    def run(members: pa.Table, visiting: pa.Table) -> pa.Table:
        if not (members.num_rows and visiting.num_rows):
            return kinds.empty_table()
        books = shared.value
        unit = _unit(_matrix(visiting.column("vector").combine_chunks(), books.centres.shape[1]))
        codes = _codes(members.column("code").combine_chunks(), books.words.shape[0])
        cell = members.column("cell")[0].as_py()
        best = _near(members.column("id").combine_chunks(), codes, cell, unit, np.full(len(unit), np.inf), books, k)
        return pa.Table.from_batches(_emit({0: best}, visiting.column("query").combine_chunks(), kinds.field(2).type, names), kinds)

    return members.groupBy("cell", "a", "b").cogroup(visiting.groupBy("cell", "a", "b")).applyInArrow(run, schema)


def top_k_quantised(
    spark: SparkSession, path: str, books: Codebooks, queries: DataFrame, probes: int, shortlist: int, k: int = TOP_K,
    id_col: str = "arxiv_id", vector_col: str = "embedding_384", query_id: str = "query_id", query_vector: str = "query_vector",
    max_queries: int = MAX_BROADCAST_QUERIES,
) -> DataFrame:
    """(query id, id, distance, rank) of the k nearest among the ``shortlist`` members whose codes are nearest, in the ``probes`` nearest cells.

    Which ``probes`` and ``shortlist`` a recall needs is measured with ``approx.recall`` against the exact search.
    """
    cells = spark.read.parquet(path)
    asked = stored(_directed(queries.where(F.col(query_id).isNotNull()), query_vector).select(query_id, query_vector), "queries")
    n = asked.count()
    schema, names = _output(cells, queries, query_id, id_col)
    if not n or not cells.limit(1).count():
        return spark.createDataFrame([], schema).select(query_id, id_col, "distance", F.lit(0).alias("rank"))
    args = cells, asked, books, probes, shortlist, schema, names, id_col, query_id
    if n <= max_queries:
        found, visited = _broadcast_way(*args)
        cells = cells.where(F.col("cell").isin(visited))
    else:
        found = _sent_way(*args)
    tasks = scan_tasks(cells.select(id_col, "code"))
    short = stored(best_of(found, query_id, id_col, shortlist, tasks).select(query_id, id_col), "short")
    listed = F.broadcast(short) if short.count() <= MAX_BROADCAST_KEYS else short
    pairs = cells.select(id_col, vector_col).join(listed, id_col)
    pairs = pairs.join(F.broadcast(asked) if n <= max_queries else asked, query_id)
    distance = vec.tie_safe(vec.cosine_distance(F.col(vector_col), F.col(query_vector)))
    ranked = pairs.select(query_id, id_col, distance.alias("distance"))
    place = F.row_number().over(Window.partitionBy(query_id).orderBy("distance", id_col))
    return ranked.withColumn("rank", place).where(F.col("rank") <= k)
