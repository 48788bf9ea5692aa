"""Every stage on its own input, against brute force or against what it must leave alone."""

import pytest

import corpus_pipeline
from corpus_pipeline import STAGES, run
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_ngram_join import brute as classes
from tests.llm.test_secrets import base


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables with planted rows: nulls, copies, repeated rows."""
    out = str(tmp_path_factory.mktemp("tables"))
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    some = docs.where("doc_id < 30")
    large = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id >= 1000 and n_chars < 3000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    for value, most in ((1, 120), (0, 500)):
        some = some.unionByName(large.join(labels.where(f"toxic = {value}").select("doc_id"), "doc_id").orderBy("doc_id").limit(most))
    more = spark.createDataFrame([(None, None, "en", "x", 0), (900_001, "", "en", "x", 0), (900_002, "token = abcdefghijklmnop tail", "en", "x", 29),
                                  (900_003, "You idiot moron scum stupid loser clown trash " * 3, None, None, 130)], docs.schema)
    docs.unionByName(some).unionByName(more).write.parquet(f"{out}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{'/root/testdata/sf0.1' if name == 'labels' else source}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    return out


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        kept = [(r.doc_id, r.text) for r in after.collect()] if name != "pieces" else None
        if name != "pieces":
            assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "near_copies":
            heads = {c for _, c, _ in classes(rows)}
            assert {k for k, _ in kept} == heads and len(kept) == len(set(kept))
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            hit = {d for d, _, _ in leaks(rows, items)}
            assert sorted(kept, key=str) == sorted([x for x in rows if x[0] not in hit], key=str)
        elif name == "secrets":
            assert len(kept) == len(rows) and all(base(t)[:3] == (0, 0, 0) for _, t in kept)
            clean = {(d, t) for d, t in rows if t and base(t)[:3] == (0, 0, 0)}
            assert len(clean & set(kept)) >= 0.97 * len(clean)
        elif name == "toxicity":
            assert 900_003 not in {k for k, _ in kept} and len(kept) >= 0.8 * len(rows)
        else:
            got = after.collect()
            assert len(got) == len(rows) and all(r.lossless for r in got)
        docs = after


def test_run(spark, folder):
    out = run(spark, folder)
    assert out.count() > 100 and [n for n, _ in STAGES] == ["toxicity", "near_copies", "decontamination", "secrets", "pieces"]
    assert corpus_pipeline.PIPELINE == {"pipeline": run}
