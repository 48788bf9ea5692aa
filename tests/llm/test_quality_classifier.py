"""Attention network: gradients, features by hand, accuracy on the held-out fold."""

import zlib

import numpy as np
import pyarrow as pa

from vectorloom.llm import quality as Q
from vectorloom.llm.quality import new_network, passages, score_quality

SCHEMA = "doc_id long, text string, y int"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    x, sizes, y = rng.normal(size=(14, 9)), np.array([1, 4, 6, 3]), np.array([1.0, 0, 0, 1])
    first = np.cumsum(sizes) - sizes
    net = new_network(x, 5, 4)

    def loss():
        s = net.forward(x, first)[0]
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    for name, grad in net.gradients(x, first, y).items():
        flat = np.atleast_1d(net.p[name]).astype(float)
        for i in list(np.ndindex(flat.shape))[:12]:
            values = []
            for d in (1e-5, -1e-5):
                moved = flat.copy()
                moved[i] += d
                old, net.p[name] = net.p[name], moved.reshape(np.shape(net.p[name]))
                values.append(loss())
                net.p[name] = old
            assert abs((values[0] - values[1]) / 2e-5 - np.atleast_1d(grad)[i]) < 1e-5


def test_passages_cover_the_whole_text():
    texts = pa.array([None, "", "  ", "a " * 100, "b", "x " * 48])
    x, n = passages(texts)
    assert n.tolist() == [1, 1, 1, 3, 1, 1] and x.shape == (8, Q.WIDTH) and not x[:2].any()
    alone, _ = passages(pa.array(["a " * 100]))
    assert np.allclose(x[3:6], alone)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    low = [r.score for y, r in held if y == 0]
    high = [r.score for y, r in held if y == 1]
    auc = np.mean([[(a < b) + 0.5 * (a == b) for b in high] for a in low])
    right = np.mean([r.predicted == y for y, r in held])
    print("auc", auc, "right", right, "low found", np.mean([s < 0.3 for s in low]), "high kept", np.mean([s >= 0.3 for s in high]))
    assert auc > 0.85 and right > 0.9


def test_edges(spark):
    rows = [(i, ("GOOD TEXT!! " if i % 2 else "plain words here ") * 20, 0) for i in range(60)]
    odd = [(None, None, 0), (100, "", 0), (100, "", 0), (101, "GOOD TEXT!! " * 20_000, 0)]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, 0), (3, None)], "doc_id long, quality int")
    got = score_quality(docs, labels).collect()
    assert len(got) == len(rows) + len(odd) and {r.doc_id: r.predicted for r in got}[101] == 1
    assert {r.score for r in score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in score_quality(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert score_quality(docs.limit(0), labels).count() == 0
