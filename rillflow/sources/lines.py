"""Readers that yield one ``value string`` row per log line."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def text_stream(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def rows(spark: SparkSession, data: Iterable, schema: StructType | str) -> DataFrame:
    """A small literal collection; single values are allowed for one-column schemas."""
    data = [r if isinstance(r, (tuple, list, dict)) else (r,) for r in data]
    return spark.createDataFrame(data, schema)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    return (
        spark.readStream.format("socket").option("host", host).option("port", port).load()
    )


def kafka_options(
    servers: str, topic: str, group_id: str | None = None, start: str = "latest"
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if group_id is not None:
        options["kafka.group.id"] = group_id
    return options


def kafka_values(records: DataFrame) -> DataFrame:
    """The UTF-8 payload of Kafka records."""
    return records.selectExpr("CAST(value AS STRING) AS value")


def kafka_lines(
    spark: SparkSession,
    servers: str,
    topic: str,
    group_id: str | None = None,
    start: str = "latest",
) -> DataFrame:
    """Stream of a topic's string values; needs Spark's Kafka connector on the class path."""
    options = kafka_options(servers, topic, group_id, start)
    return kafka_values(spark.readStream.format("kafka").options(**options).load())
