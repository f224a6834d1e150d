"""Supplied tables, and log lines derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators.transforms import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def cents() -> Column:
    """``events.value`` as a whole number, so that sums do not depend on their order."""
    return F.round(F.col("value") * 100).cast("bigint").alias("cents")


def order_log(spark: SparkSession, folder: str) -> DataFrame:
    """Creates and pays, one each at most, in days since 1970.

    An order is created on its order date and paid when its first line ships.
    """
    epoch = F.lit("1970-01-01").cast("date")
    creates = (
        table(spark, folder, "orders")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.lit("create").alias("event_type"),
            F.datediff("o_orderdate", epoch).cast("bigint").alias("event_time"),
        )
    )
    pays = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.min("l_shipdate").alias("paid"))
        .select(
            "order_id",
            F.lit("pay").alias("event_type"),
            F.datediff("paid", epoch).cast("bigint").alias("event_time"),
        )
    )
    return creates.unionByName(pays)


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    texts = spread(table(spark, folder, "documents").select("text"))
    return texts.select(F.explode(F.split("text", "\n")).alias("value"))


def _line(separator: str, *parts: Column | str) -> Column:
    return F.concat_ws(separator, *parts).alias("value")


def _id(name: str) -> Column:
    return F.col(name).cast("string")


def sensor_lines(spark: SparkSession, folder: str) -> DataFrame:
    level = F.floor("value").cast("string")
    return events(spark, folder).select(
        _line(",", F.concat(F.lit("sensor_"), _id("user_id")), _id("event_id"), level)
    )


def behavior_lines(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).select(
        _line(
            ",",
            _id("user_id"),
            _id("event_id"),
            (F.col("event_id") % 10).cast("string"),
            "event_type",
            (F.col("event_id") * 7).cast("string"),
        )
    )


def ad_click_lines(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).select(
        _line(
            ",",
            _id("user_id"),
            (F.col("event_id") % 10).cast("string"),
            "event_type",
            F.upper("event_type"),
            (F.col("event_id") * 7).cast("string"),
        )
    )


def login_lines(spark: SparkSession, folder: str) -> DataFrame:
    address = F.concat(F.lit("10.0.0."), (F.col("event_id") % 256).cast("string"))
    return events(spark, folder).select(
        _line(",", _id("user_id"), address, "event_type", _id("event_id"))
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    create = F.col("event_id") % 2 == 0
    return events(spark, folder).select(
        _line(
            ",",
            _id("event_id"),
            F.when(create, "create").otherwise("pay"),
            F.when(create, "").otherwise(F.concat(F.lit("tx"), _id("event_id"))),
            (F.col("event_id") * 7).cast("string"),
        )
    )


def access_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    return events(spark, folder).select(
        _line(
            " ",
            F.concat(F.lit("10.0.0."), (F.col("event_id") % 256).cast("string")),
            F.concat(F.lit("u"), _id("user_id")),
            F.lit("-"),
            F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
            F.lit("+0000"),
            F.lit("GET"),
            F.concat(F.lit("/"), "event_type"),
            F.lit(""),
        )
    )
