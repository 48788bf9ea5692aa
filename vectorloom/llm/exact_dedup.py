"""Exact dedup of texts by skew-safe combining; equality is decided on full content, never by a digest alone.

Two texts are equal when they are identical after every character of ``[\\x20\\x09-\\x0D]`` is deleted. Of equal texts the one
with the most code points before that, then of the smallest id, stays.

1. Digests: one pass gives each row the digest of its normalised text. Digests with at least ``HOT_ROWS`` rows, and at
   least one ten-thousandth of all rows, are hot; there are 10,000 of them at most, so their list is broadcast.
2. Local: every task combines its own rows of equal digest and content before anything is shuffled, so a group sends one row per task.
3. Salted: those rows meet by digest, salt and content. A hot digest has ``SALTS`` salts, dealt by task, so
   a group with a third of all rows is spread; other digests have one.
4. Global: the salt winners of the hot digests meet by digest and content. The full text is part of the key in each of these stages.
5. Back to the rows: a digest with one content, as shown by 2 to 4, stands for that content, so rows find their group by it. Where contents share
   a digest, the rows of that digest find their group by the full text.

A text is shuffled once for each task that holds it; digests come back by a join in which hot ones are broadcast.

Defined cases: a null text counts as empty; a null id counts as smaller than any other and comes back as null; rows that agree in id, length and
normalised text are one row given several times: each counts in ``group_size`` and is ``kept`` or not as the others (``drop_copies`` returns one);
a very long text is one sort row of its task; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.keys import NULL_ID, id_of
from vectorloom.session import stored

HOT_ROWS, SALTS = 1000, 64
_MOST_HOT = 10_000
_SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _SPACE, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rows(docs: DataFrame, digest: Callable[[Column], Column], *more: Column) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key"), F.length(F.coalesce("text", F.lit(""))).alias("chars"),
        digest(normalised(F.col("text"))).alias("digest"), *more,
    )


def _best() -> Column:
    """The row that stays: most code points, then smallest id."""
    return F.min(F.struct((-F.col("chars")).alias("minus"), "key")).alias("best")


def _combined(texts: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """(digest, best, n): one row per distinct content, by the local, salted and global stage."""
    marked = texts.join(F.broadcast(hot), "digest", "left").withColumn("hot", F.col("total").isNotNull())
    salted = (
        marked.withColumn("salt", F.when(F.col("hot"), F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(-1))
        .groupBy("digest", "hot", "salt", "norm").agg(_best(), F.count("*").alias("n"))
    )
    # Texts are needed further by hot digests alone.
    winners = stored(salted.select("digest", "hot", F.when(F.col("hot"), F.col("norm")).alias("norm"), "best", "n"), "winners")
    merged = winners.where("hot").groupBy("digest", "norm").agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    return winners.where("not hot").select("digest", "best", "n").unionByName(merged.select("digest", "best", "n"))


def exact_groups(docs: DataFrame, hot_rows: int = HOT_ROWS, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and internal key, digest and chars."""
    own = digest is sha256
    more = [] if own else [sha256(normalised(F.col("text"))).alias("sha")]
    facts = stored(_rows(docs, digest, *more), "digests")
    n = facts.count()
    hot = stored(
        facts.groupBy("digest").agg(F.count("*").alias("total")).where(F.col("total") >= max(hot_rows, -(-n // _MOST_HOT))), "hot"
    )
    texts = _rows(docs, digest, normalised(F.col("text")).alias("norm"))
    contents = stored(_combined(texts, hot, salts), "contents")
    groups = stored(
        contents.groupBy("digest").agg(F.count("*").alias("contents"), F.min("best").alias("best"), F.sum("n").alias("n"))
        .join(F.broadcast(hot.select("digest", F.lit(True).alias("hot"))), "digest", "left"),
        "groups",
    )
    one = groups.where("contents = 1")
    rows = facts.join(F.broadcast(hot.select("digest", F.lit(True).alias("hot"))), "digest", "left")
    # Hot digests are 10,000 at most: their rows are not shuffled.
    found = rows.where("hot").drop("hot").join(F.broadcast(one.where("hot").select("digest", "best", "n")), "digest").unionByName(
        rows.where("hot is null").drop("hot").join(one.where("hot is null").select("digest", "best", "n"), "digest")
    )
    several = groups.where("contents > 1").select("digest")
    if several.limit(1).count():
        shared = _rows(docs, digest, normalised(F.col("text")).alias("norm"), *more).join(several, "digest")
        best = shared.groupBy("digest", "norm").agg(_best(), F.count("*").alias("n"))
        found = found.unionByName(shared.join(best, ["digest", "norm"]).drop("norm"))
    return found.select(
        id_of().alias("doc_id"), id_of("best.key").alias("keep_id"), F.col("n").alias("group_size"),
        ((F.col("key") == F.col("best.key")) & (F.col("chars") == -F.col("best.minus"))).alias("kept"),
        F.lower(F.hex("digest" if own else "sha")).alias("text_sha256"), "key", "digest", "chars",
    )


def drop_copies(docs: DataFrame, **settings) -> DataFrame:
    """The documents that stay, one of each group, with all their columns."""
    kept = exact_groups(docs, **settings).where("kept").select("key", "digest", "chars").distinct()
    marked = _rows(docs, settings.get("digest", sha256), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return marked.join(kept, ["key", "digest", "chars"]).dropDuplicates(["key", "digest", "chars"]).select("row.*")
