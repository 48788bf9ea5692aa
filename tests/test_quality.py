from datetime import datetime, timezone

from pyspark.sql import functions as F

from vectorloom.operators import quality

MIDNIGHT = datetime(2024, 1, 3, tzinfo=timezone.utc)


def value(df):
    return df.first()["value"]


def test_completeness(spark):
    papers = spark.range(10).select(F.col("id").cast("string").alias("k"))
    vectors = spark.range(9).select(F.col("id").cast("string").alias("k"), F.array(F.lit(1.0)).alias("v"))
    twice = vectors.unionByName(vectors)
    row = quality.verdict(quality.embedding_completeness(papers, twice, "k", "v"), quality.COMPLETENESS).first()
    assert row.value == 90.0 and row.passed is False and row.threshold == "> 98"
    nulls = vectors.withColumn("v", F.lit(None).cast("array<double>"))
    assert value(quality.embedding_completeness(papers, nulls, "k", "v")) == 0.0


def test_freshness(spark):
    runs = spark.createDataFrame(
        [(datetime(2024, 1, 1, 12), "success"), (datetime(2024, 1, 2, 12), "failed")], "at timestamp, status string"
    )
    assert value(quality.freshness_hours(runs, "at", F.lit(MIDNIGHT))) == 12.0
    only = quality.freshness_hours(runs, "at", F.lit(MIDNIGHT), F.col("status") == "success")
    assert value(only) == 36.0 and quality.verdict(only, quality.FRESHNESS).first().passed is True
    assert quality.verdict(quality.freshness_hours(runs.limit(0), "at", F.lit(MIDNIGHT)), quality.FRESHNESS).first().passed is False


def test_validity_and_dimensions(spark):
    rows = spark.createDataFrame(
        [("0704.0001", "t", "a"), ("quant-ph/0202022", "t", "a"), ("2301.1", "t", "a"), ("2501.12345", None, "a"), (None, "t", "a")],
        "id string, title string, abstract string",
    )
    assert value(quality.schema_validity(rows, "id", "title", "abstract")) == 40.0
    sizes = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,), ([3.0, 4.0],)], "v array<double>")
    row = quality.verdict(quality.dimension_consistency(sizes, "v", 2), quality.DIMENSIONS).first()
    assert row.value == 50.0 and row.passed is False


def test_empty_tables_have_no_value(spark):
    empty = spark.createDataFrame([], "id string, title string, abstract string")
    assert value(quality.schema_validity(empty, "id", "title", "abstract")) is None


def test_profile_rules_lists(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", -1), ("c", 5)], "k string, n int")
    row = quality.column_profile(df, "k", ["n"]).first()
    assert (row.row_count, row.unique_pct, row.n_filled_pct) == (4, 75.0, 75.0)
    assert quality.rule_validity(df, positive=F.col("n") > 0).first().positive == 50.0
    allowed = spark.createDataFrame([("a",), ("a",), ("c",)], "code string")
    assert value(quality.list_consistency(df, "k", allowed, "code")) == 75.0
