"""WARC round trip, foreign archives and pushed conditions."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from vectorloom.llm.warc import read_pages, register, write_pages

SCHEMA = "page_id long, url string, html string, digest int"
ROWS = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2\r\nX: y", "<p>é</p>"), (3, None, None), (4, "u", ""), (None, "u", "<p>é</p>"),
        (None, None, "solo"), (7, "u", "twice"), (7, "u", "twice"), (8, "u", "x" * 3_000_000), (9, "u", "WARC/1.1\r\n\r\n" * 30)]


def want(rows):
    heads = {}
    for i, _, h in rows:
        if i is not None:
            heads[h or ""] = max(heads.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        head = heads.get(h or "")
        again = head is not None and i != head
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", head if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*r, 0) for r in ROWS], SCHEMA).repartition(3)
    write_pages(pages, f"file://{tmp_path}/w")
    assert sorted([tuple(r) for r in read_pages(spark, f"file://{tmp_path}/w").collect()], key=str) == want(ROWS)
    plain = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("*.gz"))
    assert plain.count(b"WARC-Record-ID") == len(ROWS)
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.warc").write_bytes(plain)
    assert sorted([tuple(r) for r in read_pages(spark, f"{tmp_path}/p").collect()], key=str) == want(ROWS)
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in split_records(plain)))
    assert sorted([tuple(r) for r in read_pages(spark, f"{tmp_path}/g").collect()], key=str) == want(ROWS)


def split_records(plain):
    out = []
    while plain:
        head, _, rest = plain.partition(b"\r\n\r\n")
        n = int([x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")][0].split(b":")[1])
        out.append(head + b"\r\n\r\n" + rest[: n + 4])
        plain = rest[n + 4 :]
    return out


@pytest.mark.parametrize("condition", ["record_type = 'revisit'", "record_type in ('response') and target_uri like 'http%'",
                                       "target_uri is null", "not record_type = 'revisit'", "refers_to is not null and payload_length > '1'"])
def test_pushed_conditions(spark, tmp_path, condition):
    write_pages(spark.createDataFrame([(*r, 0) for r in ROWS], SCHEMA), f"{tmp_path}/w")
    for body in ("true", "false"):
        df = register(spark).read.format("warc").option("payload", body).load(f"{tmp_path}/w")
        whole = [r for r in df.collect()]
        kept = spark.createDataFrame(whole, df.schema).where(condition).drop("payload").collect() if whole else []
        found = df.where(condition)
        assert sorted(found.drop("payload").collect(), key=str) == sorted(kept, key=str)
        assert found.where(F.col("payload").isNotNull()).count() == (0 if body == "false" else len(kept))


def test_broken_and_empty(spark, tmp_path):
    write_pages(spark.createDataFrame([], SCHEMA), f"{tmp_path}/e")
    assert read_pages(spark, f"{tmp_path}/e").count() == 0
    write_pages(spark.createDataFrame([(1, "u", "h" * 1000, 0)], SCHEMA), f"{tmp_path}/w")
    (file,) = (tmp_path / "w").glob("*.gz")
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc.gz").write_bytes(file.read_bytes()[:-30])
    with pytest.raises(Exception, match="cut-off record"):
        read_pages(spark, f"{tmp_path}/cut").count()


def test_attempts_that_did_not_commit_are_not_read(spark, tmp_path):
    write_pages(spark.createDataFrame([(1, "u", "h", 0)], SCHEMA), f"{tmp_path}/w")
    (file,) = (tmp_path / "w").glob("*.gz")
    (tmp_path / "w" / "part-lost.warc.gz").write_bytes(file.read_bytes())
    assert read_pages(spark, f"{tmp_path}/w").count() == 1
