"""Near-duplicate vectors by an inverted multi-index.

1. A vector of length one is cut into two halves, each with its own codebook of about ``sqrt(rows / MEMBERS)`` centres, so that a cell of the product grid, a
   pair of centres, holds as many vectors whatever their number. The books are fitted by Lloyd rounds on a sample of at
   most ``SAMPLE`` vectors (smallest hashes), whose bound does not grow and which bounds the centres by a sixteenth of it; every vector is then indexed.
2. The multi-sequence traversal visits the cells of the grid in rising order of the summed squared distances of the two centres.
   How many cells reach the target recall is measured: ``PROBES_FROM`` sampled vectors are compared with all vectors, and the smallest number is taken at
   which the wanted share of their true partners is met from either side; no smaller than what as many partners drawn at exactly the threshold need.
   (Visiting until no further cell can hold a partner would make the recall 1, but on vectors without clusters that is more than
   half of all cells, so the work would grow with the square of the rows.)
3. Each vector is a member of its own cell and asks in the cells it visits; a pair is found if either visits the other's cell, and
   counted once, as the unit that finds it can tell whether the other direction finds it too. Cells are dealt over tasks; a cell with many
   members or askers is cut into blocks, and each pair of blocks is one unit: a matrix product that is verified in
   double precision and gives the number of links of each vector and a spanning forest, never pairs.

Equal vectors are one node with a multiplicity, so a third of all rows being one vector costs one row.

Defined cases: vectors that are null, of length zero, empty, or with null or non-finite components link with nothing; components may have any
other size, as vectors are scaled before they are multiplied, and a single one is a vector too; vectors of
different sizes link with nothing of each other (each size is searched by itself); rows that share an id are vectors of their own, and equal ones are linked; a
null id counts as smaller than any other; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.components import components
from vectorloom.llm.keys import NULL_ID, id_of
from vectorloom.session import stored

COSINE, MEMBERS, SAMPLE, ROUNDS, BLOCK = 0.95, 12, 20_000, 8, 2048
RECALL, PROBES_FROM = 0.995, 1000
#: Of the true partners that a sampled vector has in one batch of rows, so many are measured.
_MEASURED = 8


def _centres(points: np.ndarray, codes: int, rounds: int) -> np.ndarray:
    """Lloyd's method from spread-out starting points; deterministic."""
    centres = points[[0]]
    near = ((points - centres[0]) ** 2).sum(1)
    while len(centres) < min(codes, len(points)) and near.max() > 0:
        centres = np.vstack([centres, points[[near.argmax()]]])
        near = np.minimum(near, ((points - centres[-1]) ** 2).sum(1))
    for _ in range(rounds):
        of = _squares(points, centres).argmin(1)
        n = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, points)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)[None, :], 0)


def visited(first: np.ndarray, second: np.ndarray, count: int) -> tuple[list[tuple[int, int]], float]:
    """Multi-sequence traversal for one vector: the ``count`` cells (i, j) of smallest first[i] + second[j], in rising order, with
    all that tie with the last, and a cost between theirs and that of the next cell."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, out, last = [(first[a[0]] + second[b[0]], 0, 0)], [], 0.0
    while heap:
        cost, i, j = heapq.heappop(heap)
        if len(out) >= count and cost > last + 1e-9:
            return out, (last + cost) / 2
        last = cost
        out.append((int(a[i]), int(b[j])))
        if j + 1 < len(b):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
    return out, np.inf


def _rank(first: np.ndarray, second: np.ndarray, own: np.ndarray) -> np.ndarray:
    """How many cells each row visits before and with the one of cost ``own``, given its costs to the centres of both halves."""
    second = np.sort(second, axis=1)
    rest = own[:, None] - first
    return np.array([np.searchsorted(s, r + 1e-12, "right").sum() for s, r in zip(second, rest)], np.int64)


def _ranks(x: np.ndarray, y: np.ndarray, books) -> np.ndarray:
    """For pairs x[i], y[i]: cells to visit until one of the two visits the cell of the other."""
    half, rows = x.shape[1] // 2, np.arange(len(x))
    costs = [(_squares(v[:, :half], books[0]), _squares(v[:, half:], books[1])) for v in (x, y)]
    found = []
    for here, there in (costs, costs[::-1]):
        i, j = there[0].argmin(1), there[1].argmin(1)
        found.append(_rank(*here, here[0][rows, i] + here[1][rows, j]))
    return np.minimum(*found)


def drawn_ranks(x: np.ndarray, books, cosine: float) -> np.ndarray:
    """The same for partners drawn at exactly the threshold in directions of no preference."""
    away = np.random.default_rng(5).normal(size=x.shape)
    away -= (away * x).sum(1)[:, None] * x
    length = np.sqrt((away**2).sum(1))[:, None]
    away = np.where(length > 1e-9, away / np.maximum(length, 1e-300), 0)
    return _ranks(x, cosine * x + np.sqrt(1 - cosine**2) * away, books)


def _real_rows(held, dim: int, cosine: float):
    """Ranks of true partners of the sampled vectors among the vectors of a task, and how often each was seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, node, books = held.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 4096):
                batch = whole.slice(lo, 4096)
                y, own = _matrix(batch.column("vector"), dim), batch.column("node").to_numpy()
                near = (x @ y.T >= cosine) & (node[:, None] != own[None, :])
                # A partner is measured as often as any other of its sampled vector, so a large group does not outweigh the rest.
                near &= np.cumsum(near, axis=1) <= _MEASURED
                i, j = np.nonzero(near)
                rank, n = np.unique(_ranks(x[i], y[j], books), return_counts=True) if len(i) else (np.empty(0, np.int64),) * 2
                yield pa.RecordBatch.from_arrays([pa.array(rank.astype(np.int64)), pa.array(n.astype(np.int64))], ["rank", "n"])

    return run


def probes_for(nodes: DataFrame, dim: int, x: np.ndarray, node: np.ndarray, books, cosine: float, recall: float) -> int:
    """Cells to visit so that the wanted share of partners is met from one side or the other, of true partners and of drawn ones."""
    x, node = x[:PROBES_FROM], node[:PROBES_FROM]
    held = nodes.sparkSession.sparkContext.broadcast((x, node, books))
    seen = nodes.select("node", "vector").mapInArrow(_real_rows(held, dim, cosine), "rank long, n long").groupBy("rank").agg(F.sum("n").alias("n")).toArrow()
    most = [drawn_ranks(x, books, cosine)] if dim > 1 else []  # a single component has no other direction
    if seen.num_rows:
        most.append(np.repeat(seen.column("rank").to_numpy(), seen.column("n").to_numpy()))
    return max([int(np.quantile(r, recall, method="higher")) for r in most if len(r)], default=1) + 1


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1))[:, None]


def _cell_rows(books, dim: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = books
        for whole in batches:
            for lo in range(0, whole.num_rows, 4096):
                batch = whole.slice(lo, 4096)
                x = _matrix(batch.column("vector"), dim)
                first, second = _squares(x[:, : dim // 2], left), _squares(x[:, dim // 2 :], right)
                row, cell, reach = [], [], np.empty(len(x))
                for i in range(len(x)):
                    cells, reach[i] = visited(first[i], second[i], probes)
                    row += [i] * len(cells)
                    cell += [a * len(right) + b for a, b in cells]
                row, cell = np.array(row), np.array(cell, np.int64)
                home = first.argmin(1) * len(right) + second.argmin(1)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(home[row]), pa.array(reach[row])] + [batch.column(c).take(at) for c in ("node", "copies", "vector")],
                    ["cell", "home", "reach", "node", "copies", "vector"],
                )

    return run


def _unit(x, node, copies, role, home, reach, books, cosine: float) -> pa.RecordBatch:
    """Askers (role 0) against members (role 1) of a block pair."""
    ask, have = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
    links, x_node, y_node = np.zeros(len(node), np.int64), [], []
    if len(ask) and len(have):
        linked = x[ask] @ x[have].T >= cosine
        linked &= node[ask][:, None] != node[have][None, :]
        links[ask] = linked @ copies[have]
        # A member that does not visit the asker's cell will not find this link itself.
        half, (left, right) = x.shape[1] // 2, books
        i, j = home[ask] // len(right), home[ask] % len(right)
        cost = _squares(x[have][:, :half], left)[:, i] + _squares(x[have][:, half:], right)[:, j]
        links[have] += (linked.T & (cost > reach[have][:, None])) @ copies[ask]
        # Spanning forest of a two-sided graph: visit members through askers row by row.
        seen_m, seen_a = np.zeros(len(have), bool), np.zeros(len(ask), bool)
        for start in np.flatnonzero(linked.any(1)):
            if seen_a[start]:
                continue
            seen_a[start], stack = True, [int(start)]
            while stack:
                i = stack.pop()
                new = np.flatnonzero(linked[i] & ~seen_m)
                seen_m[new] = True
                x_node += [node[ask[i]]] * len(new)
                y_node += node[have[new]].tolist()
                for m in new:
                    more = np.flatnonzero(linked[:, m] & ~seen_a)
                    seen_a[more] = True
                    x_node += [node[have[m]]] * len(more)
                    y_node += node[ask[more]].tolist()
                    stack += more.tolist()
    some = np.flatnonzero(links)
    n = len(x_node)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([node[some], np.array(x_node, np.int64)]).astype(np.int64)),
         pa.array(np.concatenate([links[some], np.zeros(n, np.int64)]).astype(np.int64)),
         pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(y_node, pa.int64())])],
        ["node", "links", "other"],
    )


def _verified(books, dim: int, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "a", "b")], axis=1).astype(np.int64)
            x = _matrix(batch.column("vector"), dim)
            facts = [batch.column(c).to_numpy() for c in ("node", "copies", "role", "home", "reach")]
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for lo, hi in zip([0, *cut], [*cut, len(keys)]):
                if lo == hi:
                    continue
                now = tuple(keys[lo])
                if key is not None and now != key:
                    yield _unit(*[np.concatenate(p) for p in zip(*parts)], books, cosine)
                    parts = []
                key = now
                parts.append((x[lo:hi], *[f[lo:hi] for f in facts]))
        if parts:
            yield _unit(*[np.concatenate(p) for p in zip(*parts)], books, cosine)

    return run


def fit(nodes: DataFrame, dim: int, codes: int | None, sample: int, cosine: float, recall: float):
    """Codebooks of both halves and the number of cells to visit."""
    rows = nodes.orderBy(F.xxhash64("node"), "node").select("node", "vector").limit(sample).toArrow()
    x = _matrix(rows.column("vector").combine_chunks(), dim)
    codes = codes or max(1, min(math.ceil(math.sqrt(nodes.count() / MEMBERS)), sample // 16))
    books = _centres(x[:, : dim // 2], codes, ROUNDS), _centres(x[:, dim // 2 :], codes, ROUNDS)
    return books, probes_for(nodes, dim, x, rows.column("node").to_numpy(), books, cosine, recall)


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, codes: int | None = None, sample: int = SAMPLE, recall: float = RECALL,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest id reachable by links), kept."""
    rows = stored(
        vectors.select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("key"), F.col(vector_col).cast("array<double>").alias("vector")
        ).withColumn(
            "good",
            F.expr("vector is not null and forall(vector, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) and exists(vector, v -> v != 0)"),
        ).withColumn("good", F.coalesce("good", F.lit(False)))
        .withColumn("d1", F.when(F.col("good"), F.xxhash64("vector"))).withColumn("d2", F.when(F.col("good"), F.xxhash64(F.lit(7), "vector"))),
        "vectors",
    )
    nodes = stored(
        rows.where("good").groupBy("d1", "d2").agg(
            F.min("key").alias("key"), F.count("*").alias("copies"), F.first("vector").alias("vector")
        ).withColumn("node", F.col("d1")),
        "nodes",
    )
    found = None
    for (dim,) in nodes.select(F.size("vector").alias("dim")).distinct().collect():
        part = nodes.where(F.size("vector") == dim)
        books, probes = fit(part, dim, codes, sample, cosine, recall)
        cells = stored(
            part.select("node", "copies", "vector").mapInArrow(
                _cell_rows(books, dim, probes),
                "cell long, home long, reach double, node long, copies long, vector array<double>",
            ),
            "cells",
        )
        # Block numbers of a cell: members and askers by hash, as many blocks as each needs.
        sizes = cells.groupBy("cell").agg(
            F.ceil(F.count(F.when(F.col("cell") == F.col("home"), 1)) / BLOCK).cast("int").alias("mine"), F.ceil(F.count("*") / BLOCK).cast("int").alias("asking")
        ).where("mine > 0")
        dealt = cells.join(sizes, "cell")
        block = F.xxhash64("node")
        askers = dealt.select(
            "cell", F.pmod(block, "asking").cast("int").alias("a"), F.explode(F.sequence(F.lit(0), F.col("mine") - 1)).alias("b"),
            F.lit(0).alias("role"), "home", "reach", "node", "copies", "vector",
        )
        members = dealt.where("cell = home").select(
            "cell", F.explode(F.sequence(F.lit(0), F.col("asking") - 1)).alias("a"), F.pmod(block, "mine").cast("int").alias("b"),
            F.lit(1).alias("role"), "home", "reach", "node", "copies", "vector",
        )
        one = (
            askers.unionByName(members).repartition("cell", "a", "b").sortWithinPartitions("cell", "a", "b")
            .mapInArrow(_verified(books, dim, cosine), "node long, links long, other long")
        )
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "node long, links long, other long")
    found = stored(found, "links")
    reach = components(found.where("other is not null"), "node", "other")
    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    table = nodes.select("node", "d1", "d2", "key", "copies").join(reach, "node", "left").join(links, "node", "left")
    table = table.withColumn("component", F.coalesce("component", "node"))
    heads = table.groupBy("component").agg(F.min("key").alias("head"))
    facts = table.join(heads, "component").select("d1", "d2", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"))
    return rows.select("key", "d1", "d2").join(facts, ["d1", "d2"], "left").withColumn("head", F.coalesce("head", "key")).select(
        id_of().alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        id_of("head").alias("component_id"), (F.col("head") == F.col("key")).alias("kept"),
    )
