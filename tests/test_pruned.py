"""Pruned exact search against all pairs."""

import numpy as np
import pytest

from vectorloom.operators import pruned
from vectorloom.operators.pruned import top_k_pruned

SCHEMA = "id long, v array<float>"


def brute(vectors, queries, k):
    ids = [i for i, v in vectors if v is not None and np.isfinite(v).all() and np.any(v)]
    x = np.array([v for i, v in vectors if i in set(ids)], np.float32).astype(float) if ids else np.zeros((0, 1))
    x = x / np.sqrt((x * x).sum(1))[:, None]
    out = {}
    for q, v in queries:
        if v is None or not np.isfinite(v).all() or not np.any(v):
            continue
        y = np.array(v, np.float32).astype(float)
        d = np.round(1 - x @ (y / np.sqrt(y @ y)), 12)
        out[q] = [(ids[j], d[j]) for j in np.lexsort((ids, d))[:k]]
    return out


def answers(found):
    out = {}
    for r in found.orderBy("q", "rank").collect():
        out.setdefault(r.q, []).append((r.id, r.distance))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([d for _, d in got[q]], [d for _, d in want[q]], atol=1e-9)


def clustered(seed, n, dim=16, centres=20):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim)) * 3
    return [(i, (middle[rng.integers(centres)] + rng.normal(size=dim) * 0.4).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("block", [4096, 50])
def test_many_queries_from_the_table(spark, sf_dir, monkeypatch, block):
    """6,000 queries made of the vectors of the given table, against all pairs."""
    monkeypatch.setattr(pruned, "BLOCK", block)
    monkeypatch.setattr(pruned, "ASKING", 4 * block)
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    rng = np.random.default_rng(1)
    asked = [(q, (np.array(rows[q % len(rows)][1]) + rng.normal(size=64) * 0.02 * (q % 7)).astype(np.float32).tolist()) for q in range(6000 if block > 50 else 300)]
    found, report = top_k_pruned(
        spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(asked, "q long, w array<float>"), 10, "id", "v", "q", "w", cells=24
    )
    same(answers(found), brute(rows, asked, 10))
    assert report.first().pairs > 0


def test_clusters_are_skipped(spark):
    rows = clustered(3, 3000)
    asked = rows[:200]
    found, report = top_k_pruned(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(asked, "q long, w array<float>"), 5, "id", "v", "q", "w")
    same(answers(found), brute(rows, asked, 5))
    assert report.first().skipped > 0.5


def test_copies_ties_and_rows_without_direction(spark):
    rows = [(i, [1.0, 0.0]) for i in range(50)] + [(100 + i, [0.0, 1.0 + i]) for i in range(5)] + [(200, [0.0, 0.0]), (201, None), (202, [float("nan"), 1.0]), (203, [1.0, float("inf")])]
    asked = [(1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, 1.0])]
    frame = lambda r, s: spark.createDataFrame(r, s)
    found, _ = top_k_pruned(frame(rows, SCHEMA), frame(asked, "q long, w array<float>"), 7, "id", "v", "q", "w")
    same(answers(found), brute(rows, asked, 7))
    few, _ = top_k_pruned(frame(rows[:3], SCHEMA), frame(asked, "q long, w array<float>"), 7, "id", "v", "q", "w")
    same(answers(few), brute(rows[:3], asked, 7))
    for v, q in ((rows[:0], asked), (rows, asked[:0])):
        assert top_k_pruned(frame(v, SCHEMA), frame(q, "q long, w array<float>"), 7, "id", "v", "q", "w")[0].count() == 0


def test_pairs_of_vectors_and_cells_are_held_in_parts(monkeypatch):
    """The work space of a task does not rise with the number of cells."""
    from types import SimpleNamespace

    import pyarrow as pa

    monkeypatch.setattr(pruned, "PAIRS", 1 << 12)
    held, squares = [], pruned._squares

    def watched(x, centres):
        held.append(len(x) * len(centres))
        return squares(x, centres)

    monkeypatch.setattr(pruned, "_squares", watched)
    rng = np.random.default_rng(5)
    x, centres = rng.normal(size=(3000, 8)), rng.normal(size=(512, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array(x.tolist()), pa.array([0.5] * 3000)], ["id", "vector", "kth"])
    placed = pa.Table.from_batches(pruned._placed(SimpleNamespace(value=centres))(iter([batch])))
    assert placed.column("id").to_pylist() == list(range(3000))
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    assert placed.column("cell").to_pylist() == squares(unit, centres).argmin(1).tolist()
    index = (centres, np.full(512, 0.1), np.full(512, 5), np.arange(512) // 4)
    asked = batch.rename_columns(["query", "vector", "kth"])
    visits = list(pruned._visits(SimpleNamespace(value=index), 10, 0, False)(iter([asked])))
    assert len({q for b in visits for q in b.column("query").to_pylist()}) == 3000
    assert max(held) <= 1 << 12
