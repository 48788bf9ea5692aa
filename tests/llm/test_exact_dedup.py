"""Exact groups against plain grouping, with hot groups, weak digests and odd rows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from vectorloom.llm.exact_dedup import drop_copies, exact_groups

SCHEMA = "doc_id long, text string, best string, hot int, norm int"
LOWEST = -(1 << 63)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), LOWEST if i is None else i))
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        own = groups[norm]
        best = min(own)
        out.append((i, None if best[1] == LOWEST else best[1], len(own), best == (-len(t or ""), LOWEST if i is None else i),
                    hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def docs_of(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, "b", 1, 2) for i, t in rows], SCHEMA).repartition(parts)


def rows_of(df):
    return sorted([tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=str)


ROWS = [(i, "hot  text" if i % 3 else f"own {i % 40}\n") for i in range(400)] + [
    (None, None), (None, ""), (1000, " \t\n"), (1001, ""), (5, "hot\ttext"), (5, "hot\ttext"), (1002, "hottext"), (1003, " h o t t e x t "),
    (1004, "a b"), (1005, "ab"), (1006, "é" * 40_000 + " "), (1007, "é" * 40_000), (1008, "x" * 300_000), (None, "own 3"), (1009, "AB"),
]


@pytest.mark.parametrize("hot_rows", [1000, 2])
@pytest.mark.parametrize("weak", [False, True])
def test_groups(spark, hot_rows, weak):
    settings = {"digest": lambda c: F.pmod(F.xxhash64(c), F.lit(7)).cast("string").cast("binary")} if weak else {}
    docs = docs_of(spark, ROWS)
    assert rows_of(exact_groups(docs, hot_rows=hot_rows, salts=3, **settings)) == brute(ROWS)


def test_kept_rows(spark):
    docs = docs_of(spark, ROWS)
    got = [(r.doc_id, r.text) for r in drop_copies(docs, hot_rows=2).collect()]
    want = {(i, t) for (i, t) in ROWS for b in brute(ROWS) if b[0] == i and b[3] and b[4] == hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()}
    assert len(got) == len({b[4] for b in brute(ROWS)}) and set(got) <= want
    assert drop_copies(docs).columns == docs.columns


def test_empty_table(spark):
    assert exact_groups(docs_of(spark, ROWS).limit(0)).count() == 0
    assert drop_copies(docs_of(spark, ROWS).limit(0)).count() == 0
