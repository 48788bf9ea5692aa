"""Search by codes against a plain version of the same rules, and its recall."""

import numpy as np
import pytest

from vectorloom.operators import quantised
from vectorloom.operators.approx import recall
from vectorloom.operators.quantised import Codebooks, build_quantised, encode, fit_codebooks, top_k_quantised
from vectorloom.operators.topk import top_k

SCHEMA = "id long, v array<float>"
ARGS = dict(id_col="id", vector_col="v", query_id="q", query_vector="w")


def unit(x):
    return x / np.sqrt((x * x).sum())


def plain(rows, asked, books, probes, shortlist, k):
    """A loop over vectors and queries, one at a time."""
    centres = [unit(c) for c in books.centres]
    parts, _, width = books.words.shape

    def cells(x):
        return sorted(range(len(centres)), key=lambda c: (-round(float(unit(x) @ centres[c]), 12), c))

    coded = {}
    for i, v in rows:
        cell = cells(v)[0]
        left = (unit(v) - centres[cell]).reshape(parts, width)
        coded[i] = cell, [min(range(len(books.words[p])), key=lambda c: (round(((left[p] - books.words[p, c]) ** 2).sum(), 12), c)) for p in range(parts)]
    out = {}
    for q, w in asked:
        near = []
        for cell in cells(w)[:probes]:
            left = (unit(w) - centres[cell]).reshape(parts, width)
            for i, (at, codes) in coded.items():
                if at == cell:
                    near.append((round(sum(((left[p] - books.words[p, c]) ** 2).sum() for p, c in enumerate(codes)), 12), i))
        short = [i for _, i in sorted(near)[:shortlist]]
        vectors = dict(rows)
        out[q] = sorted((round(1 - float(unit(vectors[i]) @ unit(w)), 12), i) for i in short)[:k]
    return out


def made(seed, n, dim=16, clusters=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, dim)) * 2
    return [(i, (middle[rng.integers(clusters)] + rng.normal(size=dim)).astype(np.float32).astype(float)) for i in range(n)]


def frame(spark, rows, schema):
    return spark.createDataFrame([(i, None if v is None else list(map(float, v))) for i, v in rows], schema)


@pytest.mark.parametrize("few", [True, False])
def test_equals_the_plain_loop(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(quantised, "MEMBERS", 40)  # cells and their queries in several blocks
    monkeypatch.setattr(quantised, "ASKING", 7)
    rng = np.random.default_rng(4)
    rows = made(1, 300) + [(1000 + i, np.ones(16)) for i in range(60)]
    asked = made(2, 30)
    books = Codebooks(rng.normal(size=(5, 16)), rng.normal(size=(4, 9, 4)) * 0.3)
    path = str(tmp_path / "codes")
    build_quantised(frame(spark, rows, SCHEMA), path, books, "id", "v")
    found = top_k_quantised(
        spark, path, books, frame(spark, asked, "q long, w array<float>"), 2, 25, 6, **ARGS, max_queries=4096 if few else 3
    )
    got = {}
    for r in found.orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append((r.distance, r.id))
    want = plain(rows, asked, books, 2, 25, 6)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]] and np.allclose([d for d, _ in got[q]], [d for d, _ in want[q]], atol=1e-9)


@pytest.mark.parametrize("max_queries", [4096, 10])
def test_recall_of_fitted_codes(spark, tmp_path, max_queries):
    rows = frame(spark, made(3, 3000), SCHEMA)
    asked = rows.where("id % 60 = 0").selectExpr("id AS q", "v AS w")
    books = fit_codebooks(rows, 12, 4, 64, "v")
    assert books.words.shape == (4, 64, 4)
    path = str(tmp_path / "codes")
    build_quantised(rows, path, books, "id", "v")
    found = top_k_quantised(spark, path, books, asked, 6, 100, 10, **ARGS, max_queries=max_queries)
    exact = top_k(rows, asked, 10, "id", "v", query_id="q", query_vector="w")
    assert recall(found, exact, "q", "id").first()["recall"] >= 0.95


def test_every_cell_and_a_long_list_is_the_exact_search(spark, tmp_path):
    rows = frame(spark, made(5, 200), SCHEMA)
    asked = rows.where("id % 20 = 0").selectExpr("id AS q", "v AS w")
    books = Codebooks(np.random.default_rng(6).normal(size=(3, 16)), np.zeros((2, 1, 8)))
    path = str(tmp_path / "codes")
    build_quantised(rows, path, books, "id", "v")
    found = top_k_quantised(spark, path, books, asked, 3, 200, 10, **ARGS)
    exact = top_k(rows, asked, 10, "id", "v", query_id="q", query_vector="w")
    assert {(r.q, r.id, r["rank"]) for r in found.collect()} == {(r.q, r.id, r["rank"]) for r in exact.collect()}


def test_rows_without_direction_and_empty_tables(spark, tmp_path):
    rows = [(1, [1, 0]), (2, [0, 1]), (3, [0, 0]), (4, None), (5, [float("nan"), 1]), (6, [float("inf"), 1]), (None, [1, 1])]
    asked = [(1, [1, 0.1]), (2, [0, 0]), (3, None), (None, [1, 1])]
    books = Codebooks(np.eye(2), np.zeros((1, 2, 2)))
    for number, (some, queries) in enumerate(((rows, asked), (rows[:0], asked), (rows, asked[:0]))):
        path = str(tmp_path / f"codes{number}")
        build_quantised(frame(spark, some, SCHEMA), path, books, "id", "v")
        for most in (4096, 0):
            found = top_k_quantised(spark, path, books, frame(spark, queries, "q long, w array<float>"), 2, 5, 5, **ARGS, max_queries=most)
            assert [(r.q, r.id) for r in found.orderBy("rank").collect()] == ([(1, 1), (1, 2)] if number == 0 else [])


def test_codes_take_the_first_of_equal_words_and_wrong_books_are_refused():
    books = Codebooks(np.eye(4), np.zeros((2, 3, 2)))
    assert encode(np.ones((2, 4)), books)[1].tolist() == [[0, 0], [0, 0]]
    for centres, words in ((np.eye(4), np.zeros((2, 3, 3))), (np.eye(4), np.zeros((2, 257, 2)))):
        with pytest.raises(ValueError):
            Codebooks(centres, words)
