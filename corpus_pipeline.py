"""From documents to training ids in five stages, each one of the operators over all rows that its predecessor kept.

1. toxicity: documents that are predicted toxic go.
2. near_copies: of each group of near copies (five-word shingles, similarity 0.8 or more) the smallest id stays.
3. decontamination: documents that hold a benchmark passage go.
4. secrets: secrets are masked in the text; all documents stay.
5. pieces: sampled SentencePiece ids, with a digest of the text that they decode to.

Each result is written as Parquet in the shared folder and read back for the next stage.

Defined cases: null ids and texts are rows like any other; a null, empty or wordless text is never toxic by its words, a near copy, or a leak; of rows
that share id and text one stays in near_copies and all stay elsewhere; ties go to the smallest id; a very long text is one slice of its task;
columns beyond those of documents pass all stages but the last, whatever their names; empty tables give an empty result, and without labels nothing is toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.llm.decontaminate import drop_leaks
from vectorloom.llm.ngram_join import drop_near_copies
from vectorloom.llm.piece_sampling import round_trip
from vectorloom.llm.secrets import mask_secrets
from vectorloom.llm.toxicity import drop_toxic
from vectorloom.session import new_folder, ship_package


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, ship_package(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, ship_package(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return mask_secrets(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    coded = round_trip(docs.select("doc_id", "lang", "source", "text"))
    return coded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_ids"), F.sha2("decoded", 256).alias("decoded_sha256"), "lossless",
    )


STAGES = [
    ("toxicity", toxicity), ("near_copies", near_copies), ("decontamination", decontamination), ("secrets", secrets), ("pieces", pieces),
]

#: SQL can state neither the toxicity model nor the sampling.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


PIPELINE = {"pipeline": run}
PIPELINE_SQL: dict[str, str] = {}
