"""Passage removal against a plain search for repeated windows."""

import hashlib
import random
import re

import pytest

from vectorloom.llm.substring_dedup import dedup_passages, factors

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string"


def brute(rows, window):
    docs = sorted({(-(1 << 63) if d is None else d, t or "") for d, t in rows})
    seen = {}
    for key, text in docs:
        words = WORD.findall(text)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            seen[w] = min(seen.get(w, (key, i)), (key, i))
    out = []
    for d, t in rows:
        key, words = (-(1 << 63) if d is None else d), WORD.findall(t or "")
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] < (key, i):
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def made(seed, n=40):
    rng = random.Random(seed)
    shared = [[rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.randrange(5, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(0, 6)):
            words += rng.choice(shared) if rng.random() < 0.6 else [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(30))]
        if rng.random() < 0.2:
            words += ["x", "y"] * rng.randrange(20)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    return rows


EDGES = [
    (None, None), (1, ""), (2, None), (3, "a " * 25), (3, "a " * 25), (4, "b c " * 11), (5, "é" * 3 + " \x0b\x0c " + "ß " * 21),
    (None, "q w e r " * 9), (7, "q w e r " * 9), (7, "other text"), (8, "\x00 \x01 " * 15), (9, " ".join(map(str, range(40_000)))),
    (10, " ".join(map(str, range(39_000, 41_000)))), (11, "  z " * 12),
]


@pytest.mark.parametrize("rows", [made(1), made(2), EDGES], ids=["one", "two", "edges"])
def test_against_brute_force(spark, rows):
    docs = spark.createDataFrame([(d, t, "en") for d, t in rows], SCHEMA).repartition(3)
    assert rows_of(dedup_passages(docs)) == brute(rows, 20)


def test_other_window_and_text(spark):
    rows = made(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = dedup_passages(docs, 8, 3, with_text=True)
    assert rows_of(got.drop("kept")) == brute(rows, 8)
    changed = got.where("n_removed > 0").collect()
    assert changed and all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in changed)


def test_factors_are_repeats(spark):
    rows = dict(made(1))
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    found = factors(docs).collect()
    assert found
    for f in found:
        a, b = rows[f.doc_id].split(), rows[f.source_id].split()
        assert a[f.start : f.start + f.n_words] == b[f.source_start : f.source_start + f.n_words]
        assert (f.source_id, f.source_start) < (f.doc_id, f.start) and f.n_words >= 20


def test_empty_table_and_clashing_names(spark):
    assert dedup_passages(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(1, "a b", 1, 2, 3)], "doc_id long, text string, key int, tag int, n int")
    assert dedup_passages(docs).first().n_words == 2
