"""Landed Atom and RSS feed files as records, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vectorloom.config import FETCH_PAGE
from vectorloom.functions.fields import submitted_between
from vectorloom.functions.text import comma_list, id_from_url, strip, strip_html
from vectorloom.session import stored
from vectorloom.sources.lines import FILE_COLUMNS, ROW_BITS, with_position

# Elements are matched without their namespace prefix.
_ATOM = (
    "id STRING, title STRING, summary STRING, published STRING, doi STRING, journal_ref STRING, "
    "author ARRAY<STRUCT<name: STRING>>, category ARRAY<STRUCT<_term: STRING>>"
)
_RSS = "title STRING, link STRING, description STRING, creator STRING"
_PLACE_COLUMNS = ("source_path", "source_file", "file_size", "source_pos")


def _xml(reader, row_tag: str, schema: str):
    return (
        reader.format("xml")
        .option("rowTag", row_tag)
        .option("ignoreNamespace", "true")
        .option("attributePrefix", "_")
        .schema(schema)
    )


def scan_atom(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    reader = _xml(spark.readStream if stream else spark.read, "entry", _ATOM)
    return reader.load(path).selectExpr("*", *FILE_COLUMNS)


def scan_rss(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Items of both dialects: RSS 1.0 with a namespaced root, and plain items."""
    reader = _xml(spark.readStream if stream else spark.read, "item", _RSS)
    return reader.load(path).selectExpr("*", *FILE_COLUMNS)


def _or_empty(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit(""))


def _filled(items: Column) -> Column:
    """Without missing and empty elements; a missing list is an empty one."""
    kept = F.filter(items, lambda x: x.isNotNull() & (x != F.lit("")))
    return F.coalesce(kept, F.array().cast("array<string>"))


def atom_records(entries: DataFrame) -> DataFrame:
    """Feed entries to records; an entry without a usable id is left out."""
    names = F.transform(_filled(F.col("author.name")), strip)
    return with_position(entries).select(
        id_from_url(F.col("id")).alias("id"),
        _or_empty(F.col("title")).alias("title"),
        _or_empty(F.col("summary")).alias("abstract"),
        names.alias("authors"),
        _filled(F.col("category._term")).alias("categories"),
        strip(F.col("doi")).alias("doi"),
        strip(F.col("journal_ref")).alias("journal-ref"),
        strip(F.col("published")).alias("published"),
        *_PLACE_COLUMNS,
    ).where(F.col("id").isNotNull())


def rss_records(items: DataFrame, category: str, max_papers: int | None = None) -> DataFrame:
    """Feed items to records, all of them unless ``max_papers`` of each feed file are asked for.

    Those are the first usable items in document order. Each
    task drops surplus items before the shuffle.
    """
    records = with_position(items).select(
        id_from_url(strip(F.col("link"))).alias("id"),
        _or_empty(F.col("title")).alias("title"),
        F.coalesce(strip_html(strip(F.col("description"))), F.lit("")).alias("abstract"),
        F.coalesce(comma_list(F.col("creator")), F.array().cast("array<string>")).alias("authors"),
        F.array(F.lit(category)).alias("categories"),
        F.lit(None).cast("string").alias("doi"),
        F.lit(None).cast("string").alias("journal-ref"),
        F.lit(None).cast("string").alias("published"),
        *_PLACE_COLUMNS,
    ).where(F.col("id").isNotNull())
    if max_papers is None:
        return records
    in_order = Window.partitionBy("source_path").orderBy("source_pos")
    place = F.row_number().over(in_order)
    return records.withColumn("_place", place).where(F.col("_place") <= max_papers).drop("_place")


def record_lines(records: DataFrame) -> DataFrame:
    """Records as JSON text lines, the input of the bronze stage."""
    names = ["id", "title", "abstract", "authors", "categories", "doi", "`journal-ref`", "published"]
    value = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return records.select(value.alias("value"), *[c for c in _PLACE_COLUMNS if c in records.columns])


def fetch(
    records: DataFrame,
    published: str = "published",
    since: str | None = None,
    until: str | None = None,
    where: Column | None = None,
    page_size: int = FETCH_PAGE,
    max_total: int | None = None,
    tie: str = "id",
) -> DataFrame:
    """Records of a day range, oldest first, numbered in pages.

    Without ``max_total`` all records: they are dealt by range of time, and the
    sizes of the parts give each row its place, so no task sees all rows. With
    it, ordering with a limit keeps that many rows per task.
    """
    when = F.col(published)
    found = records.where(submitted_between(when, since, until))
    if where is not None:
        found = found.where(where)
    order = [when.asc(), F.col(tie).asc()]
    if max_total is None:
        return _all_pages(found, order, page_size)
    capped = found.orderBy(*order).limit(max_total)
    place = F.row_number().over(Window.orderBy(*order))
    return capped.withColumn("page", F.floor((place - 1) / F.lit(page_size)).cast("long"))


def _all_pages(found: DataFrame, order: list[Column], page_size: int) -> DataFrame:
    """Pages over a global order: row number in the part plus the rows of the parts before."""
    placed = stored(
        found.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))),
        "pages",
    )
    # One row per part.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    page = F.floor((F.col("_start") + F.col("_row")) / F.lit(page_size)).cast("long")
    return placed.join(starts, "_part").withColumn("page", page).drop("_part", "_row", "_start")
