"""Similarity join against a comparison of all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from vectorloom.llm import ngram_join
from vectorloom.llm.components import components
from vectorloom.llm.ngram_join import drop_near_copies, ngram_classes, prefix_length

SCHEMA = "doc_id long, text string, lang string"
LOWEST = -(1 << 63)


def shingle_set(text):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "")) if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    n = len(rows)
    near = [[j for j in range(n) if j != i and sets[i] and sets[j]
             and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-6] for i in range(n)]
    out = []
    for i in range(n):
        seen, stack = {i}, [i]
        while stack:
            for j in near[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        low = min(LOWEST if rows[j][0] is None else rows[j][0] for j in seen)
        out.append((rows[i][0], None if low == LOWEST else low, len(near[i])))
    return sorted(out, key=str)


def made(seed, n):
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(5000)}" for _ in range(rng.randrange(30, 120))] for _ in range(5)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases[:1] if rng.random() < 0.4 else bases))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            words = [f"z{rng.randrange(10**6)}" for _ in range(rng.randrange(60))]
        rows.append((i, " ".join(words)))
    return rows


EDGES = [(None, None), (1, ""), (2, "  !! "), (3, "one two"), (4, "One, two!"), (4, "One, two!"), (5, "two one"), (None, "a b c d e f"),
         (7, "a b c d e f"), (7, "a b c d e f g"), (8, "é " * 30), (9, "é " * 31), (10, " ".join(map(str, range(30_000)))),
         (11, " ".join(map(str, range(5, 30_000)))), (12, "a b c d e f")]


def rows_of(df):
    return sorted([tuple(r) for r in df.select("doc_id", "class_id", "n_links").collect()], key=str)


@pytest.mark.parametrize("rows", [made(1, 80), EDGES], ids=["made", "edges"])
def test_against_all_pairs(spark, rows):
    docs = spark.createDataFrame([(d, t, "en") for d, t in rows], SCHEMA).repartition(3)
    assert rows_of(ngram_classes(docs)) == brute(rows)


def test_groups_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 600)
    rows = made(5, 70)
    docs = spark.createDataFrame([(d, t, "en") for d, t in rows], SCHEMA)
    assert rows_of(ngram_classes(docs)) == brute(rows)


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame([(d, t, "en", 1) for d, t in EDGES], SCHEMA + ", node int")
    left = sorted([r.doc_id for r in drop_near_copies(docs).collect()], key=str)
    # The null id counts as smallest, so it stands for its group; rows without words all stay.
    assert left == sorted([None, None, 1, 2, 3, 5, 7, 8, 10], key=str)
    assert drop_near_copies(docs).columns == docs.columns


def test_empty(spark):
    assert ngram_classes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert components(spark.createDataFrame([(1, None), (2, 2)], "x long, y long"), "x", "y").count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)] + [(1, 2)] * 5
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}}


def test_prefix_gets_shorter_until_the_recall():
    k = prefix_length(0.8, 0.9999, ngram_join.TREES, ngram_join.DEPTH)
    assert 1 - (1 - 0.8**k) ** ngram_join.TREES >= 0.9999 > 1 - (1 - 0.8 ** (k + 1)) ** ngram_join.TREES


def changed(words, places, mark):
    return [f"{mark}{i}" if i in places else w for i, w in enumerate(words)]


def close_copies():
    """Groups of copies with one changed last word: similarity 195 / 197."""
    rows = []
    for g in range(8):
        words = [f"g{g}w{i}" for i in range(200)]
        rows += [(g * 10 + c, " ".join(changed(words, {199}, f"c{c}x"))) for c in range(6)]
    return rows


def distant_copy():
    """Similarity of 196 shingles to those with five changed words far apart: 171 / 221 is none, with four 176 / 216 is one."""
    words = [f"far{i}" for i in range(200)]
    return [(1000, " ".join(words)), (1001, " ".join(changed(words, {20, 60, 100, 140}, "y")))]


def depth_of(spark, rows):
    docs = spark.createDataFrame([(d, t, "en") for d, t in rows], SCHEMA)
    keyed_rows = ngram_join.keyed(docs)
    return ngram_join.forest_links(keyed_rows, ngram_join._classed(keyed_rows, 5)[1])[1]


def test_depth_follows_the_links_of_the_data(spark):
    assert depth_of(spark, close_copies()) == ngram_join.DEPTH
    assert depth_of(spark, close_copies() + distant_copy()) < ngram_join.DEPTH


def template_rows():
    """A frame that all share and own parts: pairs near 0.5 in the same trie nodes, with true copies of some."""
    frame = [f"frame{i}" for i in range(120)]
    rows = []
    for d in range(60):
        own = [f"d{d}o{i}" for i in range(60)]
        rows.append((d, " ".join(frame + own)))
        if d % 3 == 0:
            rows.append((d + 500, " ".join(frame + changed(own, {30}, "z"))))
    return rows


@pytest.mark.parametrize("turns", [1, 3])
def test_templates_in_common_nodes(spark, monkeypatch, turns):
    monkeypatch.setattr(ngram_join, "TURNS", turns)
    rows = template_rows()
    docs = spark.createDataFrame([(d, t, "en") for d, t in rows], SCHEMA)
    assert rows_of(ngram_classes(docs)) == brute(rows)


def test_estimates_from_sketches():
    rng = np.random.default_rng(3)
    left = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for share in (0.5, 0.8, 0.95):
        common = int(round(2 * 4000 * share / (1 + share)))
        right = np.concatenate([left[:common], rng.integers(0, 1 << 63, 4000 - common, dtype=np.uint64)])
        minima = ngram_join._signatures(np.concatenate([left, right]), np.array([0, 4000]))
        sketch = ngram_join._sketches(minima)
        batch = pa.RecordBatch.from_arrays(
            [pa.array([1]), pa.array([2]), sketch.slice(0, 1), sketch.slice(1, 1)], ["node", "low", "sketch", "low_sketch"]
        )
        assert abs(next(ngram_join._estimates([batch])).column("similarity")[0].as_py() - share) < 0.13


def test_every_row_without_words_stays(spark):
    rows = [(None, None), (None, None), (None, ""), (3, None), (3, ""), (4, "!!"), (4, "!!"), (5, "a b"), (5, "a b")]
    left = drop_near_copies(spark.createDataFrame([(d, t, "en") for d, t in rows], SCHEMA)).collect()
    assert sorted([(r.doc_id, r.text) for r in left], key=str) == sorted(rows[:-1], key=str)
