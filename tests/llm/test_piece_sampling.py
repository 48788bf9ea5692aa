"""Sampling against an enumeration of all segmentations; exact round trips."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from vectorloom.llm import piece_sampling as P
from vectorloom.llm.piece_sampling import decode_ids, encode_slice, encode_texts, load_vocabulary, round_trip

SCHEMA = "doc_id long, text string, ids int"
TEXTS = [None, "", " ", "  ", "Hello  world", " leading and trailing ", "▁ literal ▁▁mark", "line\n\nfeeds\n", "tab\tand \x00 zero",
         "café naïve 中文 \U0001F600 ઙ", "a" * 5000, "word " * 3000, "<0x0A> <s> </s> <unk>", "ÿ�"]


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary()


def test_round_trip(spark):
    rows = [(None if i == 4 else i, t, 0) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = decode_ids(encode_texts(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.decoded == r.text and (r.ids is None) == (r.text is None)
    model = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    plain = [r for r in got if r.text and r.text.isascii() and "<" not in r.text and "\0" not in r.text and r.text.strip() == r.text]
    assert plain and all(model.decode(list(r.ids)) == r.text for r in plain)


def test_one_pass_gives_the_same(spark, monkeypatch):
    rows = [(None if i == 4 else i, t, 0) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "ids", "1 as decoded", "'x' as `a.b`").repartition(2)
    want = decode_ids(encode_texts(docs)).collect()
    got = round_trip(docs)
    assert got.columns == ["doc_id", "a.b", "ids", "decoded", "lossless"]
    got = got.collect()
    assert Counter((r.doc_id, r.ids is not None and tuple(r.ids), r.decoded) for r in got) == Counter((r.doc_id, r.ids is not None and tuple(r.ids), r.decoded) for r in want)
    assert all(r.lossless and r["a.b"] == "x" for r in got) and len(got) == len(rows)
    assert round_trip(docs.select("doc_id", "text").limit(0)).count() == 0 and round_trip(docs.select("text", F.col("doc_id").alias("k")), key_col="k").count() == len(rows)


def test_store_of_a_worker_is_bounded(vocabulary, monkeypatch):
    """The same pieces with a small store, a large one and none."""
    texts = pa.array([" ".join(f"word{i % 700} and more{i % 90}" for i in range(k, k + 400)) for k in range(0, 4000, 100)])
    results = []
    for size in (0, 1 << 10, 1 << 20):
        monkeypatch.setattr(P, "STORED", size)
        vocabulary.store = None
        results.append([encode_slice(vocabulary, texts.slice(k, 10), np.arange(k, k + 10), 5)[0].tolist() for k in range(0, 40, 10)])
    assert results[0] == results[1] == results[2] and len(vocabulary.store.data) > 1 << 10


def test_same_row_same_pieces(spark):
    docs = spark.createDataFrame([(i % 5, "some words that can be cut in many ways", 0) for i in range(40)], SCHEMA)
    a = {(r.doc_id, tuple(r.ids)) for r in encode_texts(docs.repartition(7)).collect()}
    b = {(r.doc_id, tuple(r.ids)) for r in encode_texts(docs.coalesce(1)).collect()}
    assert a == b and len(a) == 5 and len({x for _, x in a}) > 1
    assert {(r.doc_id, tuple(r.ids)) for r in encode_texts(docs, seed=99).collect()} != a


def test_shares_follow_the_weights(vocabulary):
    """Counts of drawn segmentations against the exact distribution over all of them."""
    v, text = vocabulary, "reading"
    model = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    weight = {model.id_to_piece(int(i)): w for i, w in zip(v.ids, v.weights)}
    whole = "▁" + text

    def ways(s):
        if not s:
            yield ()
        for n in range(1, len(s) + 1):
            if s[:n] in weight:
                for rest in ways(s[n:]):
                    yield (s[:n], *rest)

    exact = {w: math.exp(sum(weight[p] for p in w)) for w in ways(whole)}
    total = sum(exact.values())
    n = 40_000
    ids, counts = encode_slice(v, pa.array([text] * n), np.arange(n), 3)
    cuts = np.concatenate([[0], np.cumsum(counts)])
    drawn = Counter(tuple(model.id_to_piece(int(i)) for i in ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:]))
    assert set(drawn) <= set(exact)
    for w, c in exact.items():
        p = c / total
        assert abs(drawn[w] - n * p) < 5 * math.sqrt(n * p * (1 - p)) + 5


def test_empty(spark):
    assert decode_ids(encode_texts(spark.createDataFrame([], SCHEMA))).count() == 0


def _plain(v, text: str, key: int, seed: int) -> list[int]:
    """The same draw for one text, sign by sign and without arrays."""
    table = {bytes(v.flat[v.bounds[i] : v.bounds[i + 1]]): (int(i), float(w)) for i, w in zip(v.ids[: len(v.hashes)], v.weights)}
    data, start, end, _ = P._segments(pa.array([text]))
    row = P.mix(np.array([key]).view(np.uint64) ^ P.mix(np.array([seed], np.uint64)))
    ids = []
    for number, (a, b) in enumerate(zip(start, end)):
        s = bytes(data[a:b])
        signs = [i for i in range(len(s)) if s[i] == P._MARK or s[i] & 0xC0 != 0x80]
        into = [[] for _ in range(len(s) + 1)]
        for i, j in zip(signs, [*signs[1:], len(s)]):
            for stop in range(i + 1, min(len(s), i + v.longest) + 1):
                if s[i:stop] in table:
                    into[stop].append((i, *table[s[i:stop]]))
            if s[i:j] not in table:
                for k in range(i, j):
                    into[k + 1].append((k, int(v.byte_ids[0x20 if s[k] == P._MARK else s[k]]), float(v.weights[-1])))
        total = [0.0] + [-math.inf] * len(s)
        for stop in range(1, len(s) + 1):
            into[stop].sort(key=lambda e: -e[0])
            values = [total[e[0]] + e[2] for e in into[stop]]
            if values:
                total[stop] = max(values) + math.log(sum(math.exp(x - max(values)) for x in values))
        mine, at, state = [], len(s), P.mix(row + np.array([number], np.uint64) * P._GOLD)
        while at:
            u, below = (int(P.mix(state)[0] >> np.uint64(34)) + 0.5) / 2**30, 0.0
            for source, piece, weight in into[at]:
                below += math.exp(total[source] + weight - total[at])
                if below > u:
                    break
            mine.append(piece)
            at, state = source, state + P._GOLD
        ids += mine[::-1]
    return ids


def test_draws_equal_a_plain_form(vocabulary):
    texts = [t for t in TEXTS if t and len(t) < 100] + ["Lattices fall apart, Straße and заметка 数据 too", "\u0800" * 9, "ab\n \n  c▁d"]
    for key, text in enumerate(texts):
        ids, _ = encode_slice(vocabulary, pa.array([text]), np.array([key]), 11)
        assert ids.tolist() == _plain(vocabulary, text, key, 11), text


def test_pieces_that_share_a_slot_are_found(vocabulary, monkeypatch):
    texts = pa.array([t for t in TEXTS if t])
    keys = np.arange(len(texts))
    want = encode_slice(vocabulary, texts, keys, 11)[0].tolist()
    monkeypatch.setattr(P, "_SLOT", np.uint64(58))  # 64 slots for all pieces
    assert encode_slice(load_vocabulary(), texts, keys, 11)[0].tolist() == want


def test_bytes_are_not_hashed_anew_for_each_length(monkeypatch):
    """The bytes of a slice were hashed again for each length that a piece can have."""
    v, hashed = load_vocabulary(), []
    texts = pa.array([" ".join(f"word{i}{k}qzx" for i in range(400)) for k in range(20)])
    rolling = P.rolling
    monkeypatch.setattr(P, "rolling", lambda values, *a, **b: hashed.append(len(values)) or rolling(values, *a, **b))
    encode_slice(v, texts, np.arange(len(texts)), 11)
    size = sum(len(t) + 1 for t in texts.to_pylist())
    assert 0 < sum(hashed) <= 2 * size
