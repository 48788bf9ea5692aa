"""Exact nearest neighbours for many queries, with cells that cannot hold one left out.

Vectors of length one lie in cells, each with a centre and a radius. By the triangle inequality no member is nearer to a query than the distance to
the centre less the radius. Queries visit cells in order of that bound: first as many as hold k vectors, then a few more, then
all whose bound does not exceed the k-th distance found by then. What is left out cannot hold an answer, so the result is exact.

Neighbouring cells are bundled up to ``BLOCK`` vectors, and a query is sent once to each bundle with a cell that it visits, with the numbers of those
cells: only they are multiplied with it, and only what is no farther than its k-th distance goes on. A cell with a third of all vectors is cut into blocks, and so are
the queries of a bundle, so no task gets an unbounded part. Of equal vectors only the k smallest ids can be among the answers, and equal queries are
asked once, so copies cost nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.config import TIE_DECIMALS, TOP_K
from vectorloom.operators.topk import _Best, _matrix
from vectorloom.session import stored

#: Centres are fitted on a sample of bounded size, which no result depends on.
SAMPLE, MAX_CELLS, ROUNDS = 20_000, 4096, 6
#: Most members, and most queries, of one unit.
BLOCK, ASKING = 4096, 16_384
#: Pairs of a vector and a cell that a task holds at once.
PAIRS = 1 << 19
#: Cells a query visits beyond those that hold k vectors, before the last round.
SECOND = 8
_SLACK = 1e-9


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :], 0)


def fit_cells(vectors: DataFrame, vector_col: str, cells: int) -> np.ndarray:
    """Centres by Lloyd's method on a bounded sample, from evenly drawn starting points."""
    rows = vectors.orderBy(F.xxhash64(vector_col)).select(vector_col).limit(SAMPLE).toArrow()
    column = rows.column(0).combine_chunks()
    x = _unit(_matrix(column, len(column[0])))
    centres = x[:: max(1, len(x) // cells)][:cells].copy()
    for _ in range(ROUNDS):
        near = _squares(x, centres).argmin(axis=1)
        size = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def _directed(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows whose vector has a direction, as (id, vector)."""
    column = F.col(vector_col)
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(column, lambda x: x != 0)
    return df.where(F.col(id_col).isNotNull() & finite & some).select(F.col(id_col).alias("id"), column.alias("vector"))


def _placed(centres):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, PAIRS // len(centres.value))
        for whole, lo in ((b, lo) for b in batches for lo in range(0, b.num_rows, step)):
            batch = whole.slice(lo, step)
            squares = _squares(_unit(_matrix(batch.column("vector"), centres.value.shape[1])), centres.value)
            cell = squares.argmin(axis=1)
            away = np.sqrt(squares[np.arange(len(cell)), cell])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int32)), pa.array(away), batch.column("id"), batch.column("vector")], ["cell", "away", "id", "vector"]
            )

    return run


def _visited(vectors: np.ndarray, kth: np.ndarray | None, index, k: int, stage: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of one stage; what earlier stages visited follows from the order of the bounds."""
    centres, radii, sizes, _ = index
    away = np.sqrt(_squares(_unit(vectors), centres))
    bound = np.maximum(away - radii[None, :], 0)
    order = np.lexsort((away, bound), axis=1)  # equal bounds, such as zero, by the distance to the centre
    first = (np.cumsum(sizes[order], axis=1) < k).sum(axis=1) + 1
    rank = np.arange(len(centres))[None, :]
    if stage == 0:
        take = rank < first[:, None]
    else:
        # A cosine distance is half the squared distance of the unit vectors.
        reach = np.take_along_axis(bound, order, 1) ** 2 / 2 <= kth[:, None] + _SLACK
        second = (first + SECOND)[:, None]
        take = reach & ((rank >= first[:, None]) & (rank < second) if stage == 1 else rank >= second)
    row, at = np.nonzero(take)
    return row, order[row, at]


def _visits(shared, k: int, stage: int, counted: bool):
    """A row for each query and bundle with the cells that it visits there; or only how many there are for each bundle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        bundle_of = index[3]
        step = min(1024, max(1, PAIRS // len(index[0])))
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                vectors, kth = _matrix(batch.column("vector"), index[0].shape[1]), batch.column("kth").to_numpy()
                row, cell = _visited(vectors, kth, index, k, stage)
                order = np.lexsort((cell, bundle_of[cell], row))
                row, cell = row[order], cell[order]
                bundle = bundle_of[cell]
                head = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (bundle[1:] != bundle[:-1]))) if len(row) else row
                if counted:
                    n = np.bincount(bundle[head], minlength=1)
                    cells = np.bincount(bundle, minlength=len(n))
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n), dtype=np.int32)), pa.array(n), pa.array(cells)], ["bundle", "n", "cells"])
                    continue
                where = pa.array(row[head])
                lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(row)), pa.int32()), pa.array(cell.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bundle[head].astype(np.int32)), batch.column("query").take(where), batch.column("kth").take(where),
                     batch.column("vector").take(where), lists], ["bundle", "query", "kth", "vector", "cells"],
                )

    return run


def _nearest(k: int, schema: pa.Schema):
    def run(members: pa.Table, asking: pa.Table) -> pa.Table:
        if not (members.num_rows and asking.num_rows):
            return schema.empty_table()
        members = members.sort_by("cell")
        v, ids, cell = (members.column(c).combine_chunks() for c in ("vector", "id", "cell"))
        q, queries, cells = (asking.column(c).combine_chunks() for c in ("vector", "query", "cells"))
        left, right, cell = _unit(_matrix(q, len(q[0]))), _unit(_matrix(v, len(v[0]))), cell.to_numpy()
        row, asked = np.repeat(np.arange(len(cells)), cells.value_lengths().to_numpy()), cells.flatten().to_numpy()
        order = np.argsort(asked, kind="stable")
        row, asked = row[order], asked[order]
        best = _Best(len(left), k)
        best.bound = asking.column("kth").combine_chunks().to_numpy(zero_copy_only=False).copy()
        for c in np.unique(asked):
            rows = row[np.searchsorted(asked, c) : np.searchsorted(asked, c, "right")]
            lo, hi = np.searchsorted(cell, c), np.searchsorted(cell, c, "right")
            for a in range(0, len(rows), 512):
                some = rows[a : a + 512]
                for at in range(lo, hi, 1024):
                    to = min(at + 1024, hi)
                    best.add(np.round(1.0 - right[at:to] @ left[some].T, TIE_DECIMALS), ids.slice(at, to - at), some)
        if best.ids is None:
            return schema.empty_table()
        return pa.Table.from_arrays([queries.take(pa.array(best.query)), pa.array(best.ids.tolist(), ids.type), pa.array(best.distance)], schema=schema)

    return run


def _bundled(centres: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bundle of each cell: a walk from a centre to the nearest one left, cut whenever ``BLOCK`` vectors are reached."""
    left, at, bundle, held = np.ones(len(centres), dtype=bool), 0, 0, 0
    out = np.zeros(len(centres), np.int64)
    for _ in range(len(centres)):
        left[at] = False
        if held and held + sizes[at] > BLOCK:
            bundle, held = bundle + 1, 0
        out[at], held = bundle, held + sizes[at]
        away = np.where(left, ((centres - centres[at]) ** 2).sum(1), np.inf)
        at = int(away.argmin())
    return out


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def top_k_pruned(
    vectors: DataFrame, queries: DataFrame, k: int = TOP_K, id_col: str = "arxiv_id", vector_col: str = "embedding_384",
    query_id: str = "query_id", query_vector: str = "query_vector", cells: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The k nearest vectors of each query (query id, id, distance, rank), and a row with the share of (query, cell) pairs left out.

    Vectors and queries without a direction (null, zero, not finite) are never in the result. Equal distances go by id.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    # One of equal queries asks; 128 bits stand for a vector.
    name = F.struct(F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(7), "vector").alias("h2")).alias("query")
    given = stored(_directed(queries, query_id, query_vector).select(F.col("id").alias(query_id), "vector", name), "queries")
    asked = stored(given.groupBy("query").agg(F.first("vector").alias("vector")), "asked")
    rows = _directed(vectors, id_col, vector_col)
    kept = stored(
        rows.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("place") <= k).drop("place"), "vectors"
    )
    n = kept.count()
    if not n or not asked.limit(1).count():
        nothing = spark.createDataFrame([], f"`{query_id}` {queries.schema[query_id].dataType.simpleString()}, `{id_col}` {id_type}, distance DOUBLE, rank INT")
        return nothing, spark.createDataFrame([(0, 0, 0.0)], "pairs BIGINT, visited BIGINT, skipped DOUBLE")
    centres = spark.sparkContext.broadcast(fit_cells(kept, "vector", cells or min(MAX_CELLS, max(1, math.isqrt(n)))))
    fields = f"id {id_type}, vector {kept.schema['vector'].dataType.simpleString()}"
    members = stored(kept.mapInArrow(_placed(centres), f"cell INT, away DOUBLE, {fields}"), "members")
    facts = members.groupBy("cell").agg(F.max("away").alias("radius"), F.count("*").alias("n")).collect()  # a row for each cell
    used = sorted(facts, key=lambda r: r.cell)
    middle, sizes = centres.value[[r.cell for r in used]], np.array([r.n for r in used], np.int64)
    bundle = _bundled(middle, sizes)
    shared = spark.sparkContext.broadcast((middle, np.array([r.radius for r in used]) + _SLACK, sizes, bundle))
    held = np.bincount(bundle, weights=sizes)
    numbered = spark.createDataFrame(
        [(r.cell, i, int(bundle[i]), math.ceil(held[bundle[i]] / BLOCK)) for i, r in enumerate(used)], "was INT, cell INT, bundle INT, blocks INT"
    )
    dealt = stored(
        members.withColumnRenamed("cell", "was").join(F.broadcast(numbered), "was")
        .select("bundle", "blocks", "cell", "id", "vector", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("a")),
        "dealt",
    )
    blocks = numbered.select("bundle", "blocks").distinct()
    id_arrow = kept.limit(1).select("id").toArrow().schema.field("id").type
    query_arrow = asked.limit(1).select("query").toArrow().schema.field("query").type
    out = pa.schema([("query", query_arrow), ("id", id_arrow), ("distance", pa.float64())])
    query_type, vector_type = (asked.schema[c].dataType.simpleString() for c in ("query", "vector"))
    best, visited, state = None, 0, asked.withColumn("kth", F.lit(float("inf")))
    for stage in range(3):
        # Counted first and sent then, so that nothing of it is written.
        counts = stored(
            state.mapInArrow(_visits(shared, k, stage, True), "bundle INT, n BIGINT, cells BIGINT").groupBy("bundle").agg(F.sum("n").alias("n"), F.sum("cells").alias("cells"))
            .where("n > 0").join(F.broadcast(blocks), "bundle").withColumn("asking", F.ceil(F.col("n") / ASKING).cast("int")), "counts",
        )
        visited += counts.agg(F.sum("cells")).first()[0] or 0
        sent = F.broadcast(counts.select("bundle", "blocks", "asking"))  # a row for each bundle
        asking = state.mapInArrow(
            _visits(shared, k, stage, False), f"bundle INT, query {query_type}, kth DOUBLE, vector {vector_type}, cells ARRAY<INT>"
        ).join(sent, "bundle").select(
            "bundle", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("a"), F.pmod(F.xxhash64("query"), "asking").cast("int").alias("b"),
            "query", "kth", "vector", "cells",
        )
        having = dealt.join(sent.drop("blocks"), "bundle").select(
            "bundle", "a", F.explode(F.sequence(F.lit(0), F.col("asking") - 1)).alias("b"), "cell", "id", "vector"
        )
        found = having.groupBy("bundle", "a", "b").cogroup(asking.groupBy("bundle", "a", "b")).applyInArrow(
            _nearest(k, out), f"query {query_type}, id {id_type}, distance DOUBLE"
        )
        best = stored(_ranked(found if best is None else found.unionByName(best), k).drop("rank"), "best")
        if stage < 2:
            # Fewer than k vectors in all: every cell has been visited already.
            kth = best.groupBy("query").agg(F.max("distance").alias("kth"))
            state = stored(asked.join(kth, "query").select("query", "vector", "kth"), "state")
    pairs = asked.count() * len(used)
    report = spark.createDataFrame([(pairs, visited, 1 - visited / pairs)], "pairs BIGINT, visited BIGINT, skipped DOUBLE")
    result = given.select(query_id, "query").join(_ranked(best, k), "query").select(query_id, F.col("id").alias(id_col), "distance", "rank")
    return result, report

