"""Near vectors against all pairs."""

import math

import numpy as np
import pytest

from vectorloom.llm import vector_dedup
from vectorloom.llm.vector_dedup import near_vectors, visited

SCHEMA = "vec_id long, embedding array<float>, node int"
LOWEST = -(1 << 63)


def brute(rows, cosine=0.95):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, np.float64)
        x /= np.abs(x).max()
        return x / np.sqrt((x * x).sum())

    x = [unit(v) for _, v in rows]
    n = len(rows)
    near = [[j for j in range(n) if j != i and x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]) and x[i] @ x[j] >= cosine]
            for i in range(n)]
    out = []
    for i in range(n):
        seen, stack = {i}, [i]
        while stack:
            for j in near[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        ids = [LOWEST if rows[j][0] is None else rows[j][0] for j in seen]
        own = LOWEST if rows[i][0] is None else rows[i][0]
        out.append((rows[i][0], len(near[i]), None if min(ids) == LOWEST else min(ids), min(ids) == own))
    return sorted(out, key=str)


def made(seed, n=300, dim=16):
    rng = np.random.default_rng(seed)
    bases = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        base = bases[0] if rng.random() < 0.3 else bases[rng.integers(12)]
        rows.append((i, (base + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.25, 1.5])).astype(np.float32).tolist()))
    return rows


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("block", [2048, 16])
def test_whole_recall_gives_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    monkeypatch.setattr(vector_dedup, "probes_for", lambda *a: 64)
    rows = made(1)
    assert rows_of(near_vectors(docs_of(spark, rows), codes=8)) == brute(rows)


def spread(seed, n, dim, inner=None, decay=None):
    """Vectors near a few low-dimensional sheets, or with a falling spectrum, a part of them close to another one."""
    rng = np.random.default_rng(seed)
    if inner:
        x = rng.normal(size=(n, inner)) @ rng.normal(size=(inner, dim))
    else:
        x = rng.normal(size=(n, dim)) * np.arange(1, dim + 1) ** -decay
    return x.astype(np.float32)


def recall_of(spark, x):
    x64 = x.astype(np.float64) / np.sqrt((x.astype(np.float64) ** 2).sum(1))[:, None]
    want = (x64 @ x64.T >= 0.95).sum(1) - 1
    docs = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA).repartition(4)
    got = {r.vec_id: r.n_links for r in near_vectors(docs).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= want).all() and want.sum() > 50
    return found.sum() / want.sum()


def test_recall_on_the_given_table(spark):
    """The given rows, which have few links, and shaken copies of half of them: at least the wanted share, and none that is not one."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()
    x = np.array([r.embedding for r in rows], np.float32)
    rng = np.random.default_rng(8)
    noise = rng.normal(size=(len(x) // 2, x.shape[1])) * np.sqrt((x[: len(x) // 2] ** 2).sum(1) / x.shape[1])[:, None]
    shaken = x[: len(x) // 2] + noise * rng.uniform(0.05, 0.32, len(x) // 2)[:, None]
    assert recall_of(spark, np.vstack([x, shaken]).astype(np.float32)) >= 0.99


@pytest.mark.parametrize("settings", [{"inner": 6}, {"inner": 8}, {"inner": 10}, {"decay": 1.0}])
def test_recall_on_vectors_of_few_directions(spark, settings):
    assert recall_of(spark, spread(3, 4000, 64, **settings)) >= 0.99


def test_work_for_a_vector_does_not_grow(spark):
    """Cells visited times members of a cell, from some thousand vectors to ten times as many."""
    seen = []
    for n in (4000, 40_000):
        x = spread(4, n, 32, inner=12)
        nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x.astype(float))], "node long, vector array<double>").repartition(4)
        books, probes = vector_dedup.fit(nodes, 32, None, vector_dedup.SAMPLE, 0.95, 0.995)
        seen.append(probes * n / (len(books[0]) * len(books[1])))
    assert seen[1] < 4 * seen[0]


def test_edges(spark):
    nan = float("nan")
    rows = [(None, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, nan]), (4, [1.0, None]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [2.0, 0.0]),
            (None, [1.0, 0.01]), (8, [-1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.1, 0.0]), (11, [float("inf"), 1.0]), (12, [5.0]), (13, [7.0]), (14, [-1e-320]),
            (15, [1e200, 1e200, 0.0, 1.0]), (16, [1e-200, 1e-200, 0.0, 0.0]), (17, [1e200, 0.0, 0.0, 0.0])]
    docs = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA.replace("float", "double")).repartition(3)
    assert rows_of(near_vectors(docs)) == brute(rows)
    assert near_vectors(docs_of(spark, made(1)).limit(0)).count() == 0


def test_traversal_order_and_end():
    rng = np.random.default_rng(3)
    a, b = rng.random(7), rng.random(5)
    got, reach = visited(a, b, 12)
    sums = [a[i] + b[j] for i, j in got]
    assert sums == sorted(sums) and len(got) == 12
    assert set(got) == {(i, j) for i in range(7) for j in range(5) if a[i] + b[j] <= reach}
