import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectorloom.config import DIMS
from vectorloom.functions import vectors
from vectorloom.functions.encoders import HashingEncoder, encoder_udf, hashing_encoder, unit_rows
from vectorloom.operators.approx import build_cells, fit_centres, recall, top_k_cells
from vectorloom.operators.retrieval import evaluate, scores, true_ranks
from vectorloom.operators.search import embed_queries, search, search_filter
from vectorloom.operators.topk import top_k


def frame(spark, matrix, ids=None, names="arxiv_id string, embedding_384 array<float>"):
    ids = ids or [f"p{i:04d}" for i in range(len(matrix))]
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in zip(ids, matrix)], names)


def brute(matrix, ids, queries, k, dim=None):
    """Sorted by (distance, id) in plain loops."""
    out = []
    for q, query in enumerate(queries):
        found = []
        for row, key in zip(matrix, ids):
            a, b = np.float64(np.float32(row))[:dim], np.float64(query)[:dim]
            lengths = np.linalg.norm(a) * np.linalg.norm(b)
            if lengths > 0:
                found.append((round(1 - float(a @ b) / lengths, 12), key))
        out += [(q, rank + 1, key) for rank, (_, key) in enumerate(sorted(found)[:k])]
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(600, 16)).astype(np.float32)
    matrix[100:300] = matrix[100]  # a third of all rows are copies
    matrix[300] = 0
    return matrix, [f"p{i:04d}" for i in range(600)], rng.normal(size=(7, 16))


def as_queries(spark, queries):
    return spark.createDataFrame(
        [(i, [float(x) for x in q]) for i, q in enumerate(queries)], "query_id int, query_vector array<double>"
    )


def ranked(df):
    return sorted((r.query_id, r["rank"], r.arxiv_id) for r in df.collect())


def test_sizes_and_heads(spark):
    ones = frame(spark, np.ones((2, 384)))
    for d in DIMS[1:]:
        rows = ones.select(vectors.truncate_normalize(F.col("embedding_384"), d).alias("v")).collect()
        assert {len(r.v) for r in rows} == {d}
        assert np.allclose(np.linalg.norm(rows[0].v), 1)
    steps = frame(spark, [[3.0, 4.0] + [0.0] * 382, [0.0] * 384])
    first, zero = (r.v for r in steps.select(vectors.truncate_normalize(F.col("embedding_384"), 48).alias("v")).collect())
    assert np.allclose(first[:2], [0.6, 0.8]) and zero == [0.0] * 48


def test_vector_text(spark):
    df = frame(spark, [[0.5, -1.25, 3.0]]).select(vectors.to_text(F.col("embedding_384")).alias("t"))
    assert df.first().t == "[0.5,-1.25,3.0]"
    assert df.select(vectors.from_text(F.col("t")).alias("v")).first().v == [0.5, -1.25, 3.0]


def test_wrong_size_stops_the_write(spark):
    df = frame(spark, np.ones((1, 383)))
    with pytest.raises(Exception, match="expected 384 dimensions, not 383"):
        df.select(vectors.of_size(F.col("embedding_384"), 384).alias("v")).collect()


def test_zero_vector_has_no_distance(spark):
    df = frame(spark, [[0.0, 0.0], [1.0, 0.0]])
    got = [r.d for r in df.select(vectors.cosine_distance(F.col("embedding_384"), F.array(F.lit(0.0), F.lit(2.0))).alias("d")).collect()]
    assert got == [None, 1.0]


def test_encoder_sizes_and_plan(spark):
    texts = spark.createDataFrame([("Deep nets learn",), ("",), (None,), ("deep NETS learn",)], "t string")
    embed = encoder_udf(hashing_encoder(16), (16, 8, 4, 2))
    df = texts.select(embed(F.col("t")).alias("v")).select("v.*")
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    rows = df.collect()
    assert rows[0] == rows[3]
    assert np.isclose(np.linalg.norm(rows[0].embedding_16), 1)
    assert rows[1].embedding_16 == [0.0] * 16 and rows[2].embedding_8 == [0.0] * 8
    assert np.allclose(rows[0].embedding_4, unit_rows(np.array([rows[0].embedding_16[:4]]))[0], atol=1e-6)


def test_encoder_result_does_not_depend_on_batches():
    texts = [f"word{i} other{i % 7}" for i in range(50)]
    whole = HashingEncoder(32).encode(texts)
    parts = np.concatenate([HashingEncoder(32).encode([t]) for t in texts])
    assert (whole == parts).all()


def test_words_are_placed_by_their_digest():
    """Against the definition, word by word: letters of any script, every ASCII whitespace, more words than the cache holds."""
    encoder = HashingEncoder(32)
    encoder._CACHE_LIMIT = 3
    batches = [["Alpha beta\x0bgamma\x0cALPHA", "", " \t\n\r ", "été Été 漢字 beta"], ["beta new words here", "  beta\r\nnew  "], []]
    for texts in batches:
        want = np.zeros((len(texts), 32))
        for row, text in enumerate(texts):
            lowered = "".join(c.lower() if c.isascii() else c for c in text)
            for word in re.findall(r"[^ \t-\r]+", lowered):
                digest = hashlib.md5(word.encode()).hexdigest()
                want[row, int(digest[:8], 16) % 32] += 1 if int(digest[8], 16) < 8 else -1
        assert np.array_equal(encoder.encode(texts), want)


def test_wrong_encoder_size(spark):
    texts = spark.createDataFrame([("a",)], "t string")
    with pytest.raises(Exception, match="expected 32"):
        texts.select(encoder_udf(hashing_encoder(16), (32, 16))(F.col("t"))).collect()


@pytest.mark.parametrize("k", [1, 10, 250, 2000])
def test_top_k_is_exact(spark, data, k):
    matrix, ids, queries = data
    got = ranked(top_k(frame(spark, matrix).repartition(5), as_queries(spark, queries), k))
    assert got == sorted(brute(matrix, ids, queries, k))


def test_top_k_without_broadcast_is_the_same(spark, data):
    matrix, ids, queries = data
    got = ranked(top_k(frame(spark, matrix), as_queries(spark, queries), 10, max_broadcast=3))
    assert got == sorted(brute(matrix, ids, queries, 10))


def test_top_k_merged_in_groups_is_the_same(spark, data, monkeypatch):
    from vectorloom.operators import topk

    matrix, ids, queries = data
    monkeypatch.setattr(topk, "_MERGE_ROWS", 0)
    found = top_k(frame(spark, matrix).repartition(9), as_queries(spark, queries), 10)
    assert found._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 4
    assert ranked(found) == sorted(brute(matrix, ids, queries, 10))


def test_top_k_of_heads(spark, data):
    matrix, ids, queries = data
    found = top_k(frame(spark, matrix), as_queries(spark, queries), 10, dims=(16, 8, 4))
    for d in (16, 8, 4):
        assert ranked(found.where(F.col("dim") == d)) == sorted(brute(matrix, ids, queries, 10, d))


def test_top_k_small_blocks(spark, data, monkeypatch):
    from vectorloom.operators import topk

    matrix, ids, queries = data
    import pyarrow as pa

    rows = pa.array([list(map(float, r)) for r in matrix], pa.list_(pa.float32()))
    monkeypatch.setattr(topk, "_BLOCK_PRODUCTS", 50)
    best = topk._scan(iter([(pa.array(ids), rows)]), queries, (16,), 10)[16]
    order = np.lexsort((best.ids, best.distance, best.query))
    got = [(int(best.query[i]), str(best.ids[i])) for i in order]
    assert got == [(q, key) for q, _, key in brute(matrix, ids, queries, 10)]


def test_top_k_no_queries_no_vectors(spark, data):
    matrix, _, queries = data
    none = as_queries(spark, queries).where("query_id < 0")
    assert top_k(frame(spark, matrix), none).count() == 0
    assert top_k(frame(spark, matrix).where("arxiv_id < 'a'"), as_queries(spark, queries)).count() == 0


def test_top_k_wrong_size(spark, data):
    matrix, _, queries = data
    with pytest.raises(Exception, match="components"):
        top_k(frame(spark, matrix), as_queries(spark, queries[:, :8])).collect()


def test_cells(spark, tmp_path):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 16))
    matrix = np.concatenate([c + 0.15 * rng.normal(size=(100, 16)) for c in centres]).astype(np.float32)
    stored = frame(spark, matrix)
    queries = as_queries(spark, centres + 0.05 * rng.normal(size=(8, 16)))
    path = str(tmp_path / "cells")
    fitted = fit_centres(stored, 8)
    build_cells(stored, path, fitted)
    exact = top_k(stored, queries, 10)
    near = top_k_cells(spark, path, fitted, queries, 3, 10)
    assert recall(near, exact, "query_id", "arxiv_id").first().recall >= 0.9
    assert ranked(top_k_cells(spark, path, fitted, queries, len(fitted), 10)) == ranked(exact)
    # Many queries go in blocks and keep their probes.
    assert ranked(top_k_cells(spark, path, fitted, queries, 3, 10, max_queries=2)) == ranked(near)
    one = top_k_cells(spark, path, fitted, queries.where("query_id = 0"), 1, 10)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [(cell" in plan


def test_cells_find_most_neighbours_of_unclustered_vectors(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    queries = rows.where("vec_id < 50").selectExpr("vec_id AS query_id", "embedding AS query_vector")
    path = str(tmp_path / "cells")
    fitted = fit_centres(rows, 12, "embedding")
    build_cells(rows, path, fitted, "vec_id", "embedding")
    assert spark.read.parquet(path).count() == rows.count(), "every vector is stored"
    exact = top_k(rows, queries, 10, "vec_id", "embedding")
    near = top_k_cells(spark, path, fitted, queries, 8, 10, "vec_id", "embedding")
    assert recall(near, exact, "query_id", "vec_id").first().recall > 0.8


def test_search_joins_only_known_papers(spark):
    gold = frame(spark, [[1.0, 0.0], [0.9, 0.1], [0.0, 1.0]], ["a", "b", "c"]).withColumn("model_name", F.lit("m"))
    silver = spark.createDataFrame(
        [("b", "B", "x", ["cs.CV"], "text", "2023-02-01"), ("c", "C", "y", ["cs.CL", "cs.AI"], "text", "2022-02-01")],
        "arxiv_id string, title string, authors string, categories array<string>, abstract_clean string, published string",
    ).withColumn("published", F.to_timestamp("published"))
    queries = as_queries(spark, [[1.0, 0.0]])
    rows = search(gold, silver, queries, k=2).orderBy("rank").collect()
    assert [(r["rank"], r.arxiv_id, r.score) for r in rows] == [(1, "b", 0.9939), (2, "c", 0.0)]
    assert rows[0].pdf_url == "https://arxiv.org/pdf/b"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = search(gold, silver, queries, k=2, gold_within_silver=True)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, "texts must not be shuffled"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    kept = search(gold, silver, queries, k=2, where=search_filter(["cs.AI"], None)).collect()
    assert [r.arxiv_id for r in kept] == ["c"]
    kept = search(gold, silver, queries, k=2, where=search_filter(since="2023-01-01")).collect()
    assert [r.arxiv_id for r in kept] == ["b"]
    assert search(gold, silver, queries, k=2, model_name="other").count() == 0
    short = gold.withColumn("embedding_1", F.slice("embedding_384", 1, 1))
    assert [r.arxiv_id for r in search(short, silver, queries, k=5, dim=1).collect()] == ["b"]


def test_query_text_is_not_cleaned(spark):
    q = spark.createDataFrame([(1, "$x$")], "query_id int, query string")
    v = embed_queries(q, hashing_encoder(16), dims=(16, 8)).first().query_vector
    assert np.allclose(v, unit_rows(HashingEncoder(16).encode(["$x$"]))[0])


def test_scores(spark):
    ranks = spark.createDataFrame([(1, 8, 1), (2, 8, 2), (3, 8, None)], "query_id int, dim int, rank int")
    row = scores(ranks, 10, 1).first()
    assert row.queries == 3 and np.isclose(row.accuracy, 1 / 3)
    assert np.isclose(row.avg_rank, 14 / 3) and np.isclose(row.mrr, (1 + 1 / 2 + 1 / 11) / 3)
    with pytest.raises(ValueError):
        scores(ranks, 10, 11)


def test_evaluate(spark, data):
    matrix, ids, queries = data
    truth = spark.createDataFrame([(q, key) for q, rank, key in brute(matrix, ids, queries, 1)], "query_id int, true_id string")
    rows = {r.dim: r for r in evaluate(frame(spark, matrix), as_queries(spark, queries), truth, dims=(16, 4)).collect()}
    assert rows[16].accuracy == 1.0 and rows[16].mrr == 1.0 and rows[4].queries == len(queries)
    ranked_rows = top_k(frame(spark, matrix), as_queries(spark, queries), 3, dims=(16,))
    assert true_ranks(truth, ranked_rows, (16, 8)).where("dim = 8 and rank is null").count() == len(queries)


def test_long_texts_are_encoded_in_small_parts(spark):
    """A part is full by its bytes, not by the number of its texts alone."""

    class Strict:
        dim = 4

        def encode(self, texts):
            if len(texts) > 1 and sum(len(t) for t in texts) > 1 << 20:
                raise ValueError("too much text at once")
            return np.array([[len(t), 1, 0, 0] for t in texts], dtype=float)

    sizes = [0, 10, 300_000, 600_000, 2_000_000, 5, 900_000, 200_000, 7]
    texts = spark.createDataFrame([(i, "x" * n if n else None) for i, n in enumerate(sizes)], "i int, t string").coalesce(1)
    found = texts.select("i", encoder_udf(Strict, (4, 2))(F.col("t")).alias("v")).collect()
    want = unit_rows(np.array([[n, 1.0, 0, 0] for n in sizes]))
    assert len(found) == len(sizes)
    for r in found:
        assert np.allclose(r.v["embedding_4"], want[r.i], atol=1e-6)


def test_ties_of_many_copies_are_taken_in_parts(monkeypatch):
    """Copies tie at the bound; blocks of them are halved before their ids are sorted, with the same result."""
    import pyarrow as pa

    from vectorloom.operators import topk

    rng = np.random.default_rng(3)
    distance = np.round(rng.integers(0, 3, size=(400, 5)) / 4, 2)
    ids = pa.array([f"d{n}" for n in rng.permutation(400)])
    found = []
    for limit in (10**9, 50):
        monkeypatch.setattr(topk, "_BLOCK_HITS", limit)
        best = topk._Best(5, 7)
        for at in range(0, 400, 130):
            best.add(distance[at : at + 130].copy(), ids.slice(at, 130))
        found.append((best.query.tolist(), best.distance.tolist(), best.ids.tolist()))
    assert found[0] == found[1] and len(found[0][0]) == 35
