"""Bloom filter masks, defined cases, and accuracy on the held-out fold."""

import numpy as np
import pyarrow as pa
import zlib

from vectorloom.llm.language_id import build_filter, grams, identify, learn

SCHEMA = "doc_id long, text string, lang string, score int"


def test_grams():
    code, owner = grams(pa.array(["Ab, cd", None, "", "x", "é"]))
    shown = [c.tobytes()[::-1] for c in code]
    assert shown[:2] == [b" ab ", b"ab c"] and b" x  " not in shown and set(owner) <= {0, 3, 4}


def test_filter_returns_all_languages_and_few_others():
    rng = np.random.default_rng(1)
    code = rng.choice(1 << 32, 30_000, replace=False).astype(np.uint32)
    lang = rng.integers(0, 70, len(code))
    f = build_filter([f"l{i:02d}" for i in range(70)], np.concatenate([code, code[:500]]), np.concatenate([lang, (lang[:500] + 1) % 70]))
    masks = f.masks(code)
    bit = lambda m, i: (m[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
    assert all(bit(m, i) for m, i in zip(masks, lang)) and all(bit(m, (i + 1) % 70) for m, i in zip(masks[:500], lang[:500]))
    other = f.masks(np.setdiff1d(rng.choice(1 << 32, 20_000).astype(np.uint32), code))
    rate = np.array([[(m[i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in range(70)] for m in other[:3000]]).mean(0)
    assert abs(rate - f.false).max() < 0.01


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = identify(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_edges(spark):
    train = [(i, "the cat and the dog", "en", 0) for i in range(1, 30)] + [(i, "le chat et le chien", "fr", 0) for i in range(30, 60)]
    odd = [(None, None, None, 1), (100, None, "en", 1), (101, "", None, 1), (102, "123 !!", None, 1), (103, "the dog", None, 1), (103, "the dog", None, 1),
           (104, "le chien " * 30_000, None, 1), (105, "中文", None, 1), (106, "€ 5", None, 1)]
    docs = spark.createDataFrame(train + odd, SCHEMA)
    got = {(r.doc_id, r.lang_pred) for r in identify(docs).collect()}
    assert {(None, "und"), (100, "und"), (101, "und"), (102, "und"), (103, "en"), (104, "fr"), (105, "en"), (106, "und")} <= got
    assert identify(docs).count() == len(train) + len(odd)
    assert {r.lang_pred for r in identify(docs.where("lang is null")).collect()} == {"und"}
    assert identify(docs.limit(0)).count() == 0 and learn(docs.limit(0)).names == []
