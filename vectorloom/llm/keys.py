"""Row keys and column handling shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands for a null id where ids are compared: smaller than any other.
NULL_ID = -(1 << 63)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, tag, text): the id, smallest for null, and a hash of the text.

    Both together find a row again after a shuffle, also where an id is given
    to several rows. Only these columns are read, so further columns of any
    name cannot clash.
    """
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("key"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def id_of(key: str = "key"):
    """The id back from a key."""
    return F.when(F.col(key) != NULL_ID, F.col(key))
