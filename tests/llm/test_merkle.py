"""Roots, proofs and folded roots against a plain tree; exchange rounds with ragged last partitions."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from vectorloom.llm.merkle import butterfly, leaf, manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, grp int, pos int, leaf string"


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    i, text, lang, source, n = row[:5]
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text))


def tree(nodes, fanout):
    """Root, and for each node the runs and places on its way up."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        for p, a in zip(paths, at):
            p.append((runs[a // fanout], a % fanout))
        at = [a // fanout for a in at]
        level = [h(r) for r in runs]
    return level[0], paths


def brute(rows, fanout, tampered):
    groups = {}
    for r in rows:
        groups.setdefault("" if r[2] is None else "=" + r[2], []).append(r)
    names = sorted(groups, key=lambda g: g.encode())
    made = {}
    for g in names:
        own = sorted(groups[g], key=lambda r: (-(1 << 63) if r[0] is None else r[0], plain_leaf(r)))
        made[g] = (own, *tree([plain_leaf(r) for r in own], fanout))
    root, upper = tree([made[g][1] for g in names], fanout)
    out = []
    for g, up in zip(names, upper):
        own, subroot, paths = made[g]
        for r, p in zip(own, paths):
            now = plain_leaf(tampered(r))
            for run, at in p + up:
                now = h(run[:at] + [now] + run[at + 1 :])
            out.append((r[0], plain_leaf(r), subroot, root, h(d for run, at in p + up for i, d in enumerate(run) if i != at), now, now == root))
    return sorted(out, key=str)


def rows_for(sizes):
    rows = []
    for lang, n in sizes.items():
        rows += [((len(rows) * 7919) % 100_003, f"Text é {len(rows)} of {lang}", lang, None if k % 5 == 0 else "web", k) for k in range(n)]
    return rows


def lowered(row):
    return (row[0], row[1].lower() if row[1] and row[0] is not None and row[0] % 3 == 0 else row[1], *row[2:])


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(5)


def altered():
    return F.when(F.col("doc_id") % 3 == 0, leaf([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.lower("text")]))


def rows_of(df):
    return sorted([tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()], key=str)


@pytest.mark.parametrize("fanout, height", [(2, 1), (3, 1), (2, 2), (8, 4)])
def test_manifest(spark, fanout, height):
    rows = rows_for({"en": 70, "fr": 23, None: 9, "zz": 1, "ä": 2, "de": 16})
    rows += [(None, None, "en", None, None), (None, "", "en", None, None), (5, "Same", "fr", "a", 4), (5, "Same", "fr", "a", 4), (5, "Long " * 60_000, "fr", "a", 1)]
    got = manifest(docs_of(spark, rows), altered=altered(), fanout=fanout, height=height)
    assert rows_of(got) == brute(rows, fanout, lowered)


def test_default_settings_over_several_partitions(spark):
    rows = rows_for({"en": 9000, "fr": 4097, None: 4096})
    assert rows_of(manifest(docs_of(spark, rows), altered=altered())) == brute(rows, 8, lowered)


def test_proof_folds_to_root(spark):
    rows = rows_for({"en": 30, "fr": 1})
    for r in manifest(docs_of(spark, rows), fanout=2, height=2, with_proof=True).collect():
        now = r.leaf
        for step in r.proof:
            assert step.digests[step.place] == now
            now = h(step.digests)
        assert now == r.root and r.verified


@pytest.mark.parametrize("parts", [1, 2, 8, 9, 10, 27, 65])
def test_every_partition_learns_the_root(spark, parts):
    nodes = [h([str(i)]) for i in range(parts)]
    frame = spark.createDataFrame([("g", i, parts, d) for i, d in enumerate(nodes)], "grp string, part long, parts long, digest string")
    root, paths = tree(nodes, 3)
    got = {r.part: (r.digest, [(list(s.digests), s.place) for s in r.path]) for r in butterfly(frame, 3).collect()}
    assert got == {i: (root, p) for i, p in enumerate(paths)}


def test_one_row_and_none(spark):
    one = docs_of(spark, rows_for({"en": 1}))
    r = manifest(one).first()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == h([])
    assert manifest(one.limit(0)).count() == 0
