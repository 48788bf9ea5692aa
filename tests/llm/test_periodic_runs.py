"""Grammar extensions and runs against plain loops; the query's digests; odd rows."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vectorloom.llm import periodic_runs
from vectorloom.llm.periodic_runs import extend, find_runs, grammar, runs_of
from vectorloom.llm.queries import op12_periodic_runs

SCHEMA = "doc_id long, text string, runs int, start string, collapsed int"


def plain_runs(w, least=24, times=3):
    """All maximal stretches by period; a stretch's smallest period counts."""
    n, best = len(w), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            a = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            if i + p - a >= max(least, times * p):
                best.setdefault((a, i + p - a), p)
    return sorted((s, length, p) for (s, length), p in best.items())


def planted(key, words):
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute(key, text):
    w = planted(key, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = plain_runs(w)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    facts = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (key, len(runs), *facts, sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows_of(df):
    return sorted([tuple(r) for r in df.select(*NAMES).collect()], key=str)


def padded(docs):
    codes = [c for d in docs for c in d]
    top, out, marks = max(codes, default=0) + 1, [], []
    for d in docs:
        marks.append(len(out))
        out += [top + len(marks), *d]
    marks.append(len(out))
    out.append(top + len(marks) + 1)
    return np.array(out), np.array(marks), top + len(marks) + 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=4))
def test_extensions(docs):
    s, marks, fresh = padded(docs)
    levels = grammar(s, marks, fresh)
    assert len(levels[-1].symbol) <= 2 * len(marks) - 1
    pairs = [(i, j) for i in range(len(s)) for j in range(len(s)) if i < j and not np.isin([i, j], marks).any()]
    pairs = [(i, j) for i, j in pairs if np.searchsorted(marks, i) == np.searchsorted(marks, j)]
    if not pairs:
        return
    i, j = np.array(pairs).T
    for step in (1, -1):
        want = []
        for a, b in pairs:
            n = 0
            while s[a + step * n] == s[b + step * n]:
                n += 1
            want.append(n)
        assert extend(levels, i, j, step).tolist() == want
        assert (extend(levels, j, i, step) == want).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 9)), max_size=6))
def test_runs_of_made_texts(parts):
    w = [c for unit, times in parts for c in unit * times]
    got = runs_of(np.array(w, np.int32), np.array([0, len(w)]))
    assert [tuple(r[1:]) for r in got.tolist()] == plain_runs(w)


def test_many_documents_and_small_chunks(monkeypatch):
    rng = np.random.default_rng(4)
    docs = []
    for _ in range(60):
        unit = rng.integers(0, 6, rng.integers(1, 60))
        docs.append(np.concatenate([rng.integers(0, 6, rng.integers(0, 50)), np.tile(unit, rng.integers(1, 7)), rng.integers(0, 6, rng.integers(0, 30))]))
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    codes = np.concatenate(docs).astype(np.int32)
    want = [(i, *r) for i, d in enumerate(docs) for r in plain_runs(d.tolist())]
    for chunk in (1 << 20, 50):
        monkeypatch.setattr(periodic_runs, "CHUNK", chunk)
        assert [tuple(r) for r in runs_of(codes, bounds).tolist()] == want and len(want) > 20


def rows():
    rng = np.random.default_rng(9)
    out = [(None, None), (None, "a " * 30), (1, ""), (2, " \t\n"), (3, "x"), (4, "a " * 23), (5, "a " * 24), (6, "é ü\n" * 20), (7, "b c d " * 7 + "b"), (7, "b c d " * 7 + "b"),
           (8, "p q r s t u v w " * 3), (9, "p q r s t u v w " * 2 + "p q r s t u v"), (10, "w " * 30_000), (11, "x" * 100_000), (12, "z\0 z\0 " * 20),
           (13, ("a " * 30 + "b ") * 4 + "c " * 40), (14, "A a " * 20)]
    for i in range(20, 260):
        unit = rng.integers(0, 30, rng.integers(1, 25))
        w = np.concatenate([rng.integers(0, 30, rng.integers(0, 40)), np.tile(unit, rng.integers(1, 6)), rng.integers(0, 30, rng.integers(0, 40))])
        out.append((i, " ".join(f"w{c}" for c in w)))
    return out


def test_query(spark, tmp_path):
    made = rows()
    spark.createDataFrame([(i, t, 1, "s", 2) for i, t in made], SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(op12_periodic_runs(spark, str(tmp_path)))
    assert got == sorted([brute(i, t) for i, t in made], key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in made) > 10


def test_query_on_the_smallest_tables(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    short = {i for i, t in docs if len((t or "").split()) < 400}
    got = [r for r in rows_of(op12_periodic_runs(spark, sf_dir))]
    assert len(got) == len(docs)
    assert [r for r in got if r[0] in short] == sorted([brute(i, t) for i, t in docs if i in short], key=str)


def test_operator(spark):
    docs = spark.createDataFrame([(1, "s " + "a b " * 12 + "t", 0, "", 0), (2, None, 0, "", 0)], SCHEMA)
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(docs).collect()}
    assert got == {1: (26, [(1, 24, 2)], "s a b t"), 2: (0, [], "")}
    assert find_runs(docs.limit(0)).count() == 0
    assert find_runs(docs, least=4, times=2).where("doc_id = 1").first().runs[0].start == 1


@pytest.mark.parametrize("unit", [1, 2, 7, 997])
def test_long_text_is_one_run(unit):
    w = np.tile(np.arange(unit), 60_000 // unit).astype(np.int32)
    assert runs_of(w, np.array([0, len(w)])).tolist() == [[0, 0, len(w), unit]]
