"""Leak search against a comparison of every window with every item."""

import random
import re
from collections import Counter

import numpy as np

from vectorloom.llm import decontaminate
from vectorloom.llm.decontaminate import drop_leaks, find_leaks

DOCS, ITEMS = "doc_id long, text string, key int", "item_id long, text string"


def shingle_list(text):
    words = [w.lower() for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "") if w]
    if not words:
        return []
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))]


def brute(docs, items):
    out = []
    wanted = [(i, shingle_list(other)) for i, other in items]
    for d, text in docs:
        sh = shingle_list(text)
        some = set(sh)
        for i, want in wanted:
            if some.isdisjoint(want):
                continue
            best = 0
            for b in range(max(1, len(sh) - len(want) + 1)):
                a, c = Counter(sh[b : b + len(want)]), Counter(want)
                common = sum((a & c).values())
                best = max(best, common / (sum(a.values()) + len(want) - common))
            if best >= 0.8 - 1e-12:
                out.append((d, i, round(best, 9)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([(r.doc_id, r.item_id, round(r.similarity, 9)) for r in df.collect()], key=str)


def made(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(f"v{rng.randrange(3000)}" for _ in range(rng.randrange(3, 60)))) for i in range(30)]
    docs = []
    for d in range(60):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.randrange(200))]
        for _ in range(rng.randrange(3)):
            part = rng.choice(items)[1].split()
            if rng.random() < 0.5 and len(part) > 20:
                part[rng.choice([0, 1, 2, len(part) - 1, len(part) // 2])] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(words).upper() if d % 7 == 0 else " ".join(words)))
    return docs, items


def test_against_all_windows(spark):
    docs, items = made(1)
    found = find_leaks(spark.createDataFrame([(d, t, 1) for d, t in docs], DOCS), spark.createDataFrame(items, ITEMS))
    want = brute(docs, items)
    assert rows_of(found) == want and len(want) > 20


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS", 7)
    docs, items = made(2)
    found = find_leaks(spark.createDataFrame([(d, t, 1) for d, t in docs], DOCS), spark.createDataFrame(items, ITEMS))
    assert rows_of(found) == brute(docs, items)


EDGES = [(None, None), (1, ""), (2, "a b"), (3, "A, b!"), (3, "A, b!"), (4, "x " * 400), (5, "x " * 12 + "y"), (None, "é è " * 9),
         (7, " ".join(map(str, range(60_000))))]
EDGE_ITEMS = [(1, None), (2, ""), (3, "a b"), (4, "x " * 12), (5, "é è " * 9), (5, "é è " * 9), (None, "x y"),
              (8, " ".join(map(str, range(30_000, 30_050))))]


def test_edges(spark):
    found = find_leaks(spark.createDataFrame([(d, t, 1) for d, t in EDGES], DOCS), spark.createDataFrame(EDGE_ITEMS, ITEMS))
    assert rows_of(found) == brute(EDGES, EDGE_ITEMS)


def test_drop_and_empty(spark):
    docs = spark.createDataFrame([(d, t, 1) for d, t in EDGES], DOCS)
    left = drop_leaks(docs, spark.createDataFrame(EDGE_ITEMS, ITEMS))
    assert left.columns == docs.columns and sorted([r.doc_id for r in left.collect()], key=str) == [1, None]
    assert find_leaks(docs, spark.createDataFrame([], ITEMS)).count() == 0
    assert find_leaks(docs.limit(0), spark.createDataFrame(EDGE_ITEMS, ITEMS)).count() == 0


def test_long_items_with_a_run_of_one_shingle(spark):
    """A run of one word in the item or in the copy rules the shingle weights; the leak is above the threshold all the same."""
    rng = random.Random(4)
    items, docs = [], []
    for i, (n, run) in enumerate([(200, 12), (400, 25), (1000, 40), (1000, 80)] * 3):
        plain = [f"u{rng.randrange(10**6)}" for _ in range(n)]
        with_run = plain[: n // 2] + ["zero"] * (run + 4) + plain[n // 2 + run + 4 :]
        item, copy = (with_run, plain) if i % 2 else (plain, with_run)
        items.append((i, " ".join(item)))
        docs.append((i, " ".join([f"o{rng.randrange(10**6)}" for _ in range(150)] + copy + ["end"] * 90)))
    want = brute(docs, items)
    found = find_leaks(spark.createDataFrame([(d, t, 1) for d, t in docs], DOCS), spark.createDataFrame(items, ITEMS))
    assert rows_of(found) == want and len(want) == len(items)


def test_window_sums_are_those_of_each_window():
    rng = np.random.default_rng(6)
    values = rng.choice(np.array([7, 8, 1 << 60, 1 << 61], np.uint64), 90)
    for n in (1, 2, 17, 90):
        got = decontaminate._window_sums(values, n)
        for b in range(len(values) - n + 1):
            seen = Counter()
            ranks = []
            for v in values[b : b + n].tolist():
                seen[v] += 1
                ranks.append(seen[v])
            assert (got[b] == decontaminate._ranked(values[b : b + n], np.array(ranks)).sum(0)).all()
