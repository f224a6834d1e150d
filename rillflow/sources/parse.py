"""Positional parsers from ``value string`` lines to typed columns.

Strict parsers fail the query on a missing field or a bad number, lenient ones
give null. All of them work on batch and streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rillflow import schemas
from rillflow.functions.text import fields


def _or_raise(value: Column, wrong: Column, what: str, kind: str) -> Column:
    """``value``, or an error where ``wrong``, also outside ANSI mode."""
    error = F.raise_error(F.lit(f"bad line: {what}")).cast(kind)
    return F.when(wrong, error).otherwise(value)


def _field(parts: Column, position: int, strict: bool) -> Column:
    found = F.get(parts, position)
    if not strict:
        return found
    return _or_raise(found, F.size(parts) <= position, f"no field {position}", "string")


def _typed(lines: DataFrame, schema: StructType, strict: bool) -> DataFrame:
    split = lines.select(fields("value").alias("parts"))
    columns = []
    for position, field in enumerate(schema.fields):
        text = _field(F.col("parts"), position, strict)
        typed = text.try_cast(field.dataType)
        if strict:
            wrong = typed.isNull() & text.isNotNull()
            typed = _or_raise(typed, wrong, field.name, field.dataType.simpleString())
        columns.append(typed.alias(field.name))
    return split.select(*columns)


def parse_sensor(lines: DataFrame, strict: bool = True) -> DataFrame:
    return _typed(lines, schemas.SENSOR, strict)


def parse_user_behavior(lines: DataFrame, strict: bool = True) -> DataFrame:
    return _typed(lines, schemas.USER_BEHAVIOR, strict)


def parse_ad_click(lines: DataFrame, strict: bool = True) -> DataFrame:
    return _typed(lines, schemas.AD_CLICK, strict)


def parse_login(lines: DataFrame, strict: bool = True) -> DataFrame:
    return _typed(lines, schemas.LOGIN_EVENT, strict)


def parse_order(lines: DataFrame, strict: bool = True) -> DataFrame:
    """An empty transaction id stays an empty string."""
    return _typed(lines, schemas.ORDER_EVENT, strict)


def parse_access_log(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Web-server lines; the time is read as UTC and the zone token is ignored."""
    split = lines.select(fields("value", " ").alias("parts"))

    def part(position: int) -> Column:
        return _field(F.col("parts"), position, strict)

    pattern = "dd/MM/yyyy:HH:mm:ss Z"
    zoned = F.concat(part(3), F.lit(" +0000"))
    time = F.try_to_timestamp(zoned, F.lit(pattern))
    if strict:
        wrong = time.isNull() & zoned.isNotNull()
        time = _or_raise(time, wrong, "event_time", "timestamp")
    return split.select(
        part(0).alias("ip"),
        part(1).alias("user_id"),
        time.alias("event_time"),
        part(5).alias("method"),
        part(6).alias("url"),
    )
