"""File-arrival messages ``{filepath, filename}``, from Kafka or any other stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MESSAGE = "filepath STRING, filename STRING"


def kafka_messages(
    spark: SparkSession, servers: str = "localhost:9092", topic: str = "incoming-files"
) -> DataFrame:
    """Message stream from the earliest offset; needs the Kafka connector on the cluster."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def parse_messages(messages: DataFrame, value: Column | str = "value") -> DataFrame:
    column = F.col(value) if isinstance(value, str) else value
    fields = F.from_json(column, _MESSAGE)
    return messages.select(fields.alias("m")).select("m.*").where(F.col("filepath").isNotNull())


def arrival_messages(lines: DataFrame) -> DataFrame:
    """Messages for the files of a scan or stream: one per file name.

    Spark gives the path percent-encoded; a message carries it as it is.
    """
    path = F.url_decode(F.replace("source_path", F.lit("+"), F.lit("%2B")))
    body = F.to_json(F.struct(path.alias("filepath"), F.col("source_file").alias("filename")))
    return lines.select(body.alias("value")).distinct()
