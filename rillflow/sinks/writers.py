"""Batch and streaming writers.

Every class here has ``write(batch, batch_id)`` and can be handed to
``writeStream.foreachBatch``. File targets keep one folder per batch id and
overwrite it, so a replayed batch leaves the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

Writer = Callable[[DataFrame, int], None]


def show(df: DataFrame, label: str | None = None, n: int | None = None) -> None:
    """Print every row, or the first ``n``, optionally with a label in front.

    Rows come to the driver partition by partition.
    """
    start = "" if label is None else f"{label}> "
    rows = df if n is None else df.limit(n)
    for row in rows.toLocalIterator():
        print(f"{start}{', '.join(str(v) for v in row)}")


def console(stream: DataFrame, label: str, mode: str = "append") -> DataStreamWriter:
    """Print every row of each micro-batch."""
    return (
        stream.writeStream.queryName(label)
        .outputMode(mode)
        .foreachBatch(lambda batch, _: show(batch, label))
    )


def kafka_records(df: DataFrame, value: Column | str) -> DataFrame:
    """One string record per row."""
    value = F.col(value) if isinstance(value, str) else value
    return df.select(value.cast("string").alias("value"))


def write_kafka(df: DataFrame, value: Column | str, servers: str, topic: str):
    """Save a batch, or return the stream writer; needs Spark's Kafka connector."""
    records = kafka_records(df, value)
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if df.isStreaming:
        return records.writeStream.format("kafka").options(**options)
    return records.write.format("kafka").options(**options).save()


def _order(order_by: list[str]) -> Column:
    if len(order_by) == 1:
        return F.col(order_by[0])
    return F.struct(*[F.col(c) for c in order_by])


def latest_per_key(
    df: DataFrame, key: str, value: str, order_by: Iterable[str]
) -> DataFrame:
    """The value written last for each key."""
    newest = F.max_by(F.col(value), _order(list(order_by)))
    return df.groupBy(key).agg(newest.alias(value))


@dataclass
class KeyedUpsert:
    """Last-write-wins table: a change log per batch, folded when it is read."""

    path: str
    key: str
    value: str
    order_by: list[str]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(self.key, self.value, _order(self.order_by).alias("_order"))
        (
            rows.groupBy(self.key)
            .agg(
                F.max_by(self.value, "_order").alias(self.value),
                F.max("_order").alias("_order"),
            )
            .write.mode("overwrite")
            .parquet(f"{self.path}/batch_id={batch_id}")
        )

    def read(self, spark: SparkSession) -> DataFrame:
        changes = spark.read.parquet(self.path)
        return latest_per_key(changes, self.key, self.value, ["batch_id", "_order"])

    def compact(self, spark: SparkSession, target: str) -> KeyedUpsert:
        """Fold the log into one folder of a fresh path; later batches go on there."""
        changes = spark.read.parquet(self.path)
        newest = changes.agg(F.max("batch_id")).first()[0]
        place = F.struct("batch_id", "_order")
        (
            changes.groupBy(self.key)
            .agg(F.max_by(F.struct(self.value, "_order"), place).alias("_last"))
            .select(self.key, f"_last.{self.value}", "_last._order")
            .write.mode("errorifexists")
            .parquet(f"{target}/batch_id={newest}")
        )
        return KeyedUpsert(target, self.key, self.value, self.order_by)


@dataclass
class HashSink:
    """Set fields of a remote hash, for example through a Redis client.

    ``connect`` runs once per partition on the executors and returns an object
    with ``hset(name, field, value)``; a ``close()`` is called when there is one.
    """

    name: str
    key: str
    value: str
    order_by: list[str]
    connect: Callable[[], object]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        name, key, value, connect = self.name, self.key, self.value, self.connect

        def send(rows: Iterable) -> None:
            client = connect()
            try:
                for row in rows:
                    client.hset(name, str(row[key]), str(row[value]))
            finally:
                close = getattr(client, "close", None)
                if close is not None:
                    close()

        latest_per_key(batch, key, value, self.order_by).foreachPartition(send)


def to_documents(df: DataFrame, value: str, name: str = "data") -> DataFrame:
    """One JSON document ``{"data": ...}`` per row."""
    entry = F.create_map(F.lit(name), F.col(value).cast("string"))
    return df.select(F.to_json(entry).alias("value"))


@dataclass
class DocumentSink:
    """Append JSON documents to an index folder, one document per line."""

    path: str
    value: str = "value"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        to_documents(batch, self.value).write.mode("overwrite").text(
            f"{self.path}/batch_id={batch_id}"
        )


@dataclass
class JdbcInsert:
    """Insert rows into a table. A replayed batch inserts its rows again."""

    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.jdbc(
            self.url, self.table, mode="append", properties=dict(self.properties)
        )


def fan_out(writers: Mapping[str | None, Writer], tag: str = "tag") -> Writer:
    """Send the rows of each tag to its own writer; ``None`` takes the main rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for name, writer in writers.items():
                writer(batch.where(F.col(tag).eqNullSafe(F.lit(name))).drop(tag), batch_id)
        finally:
            batch.unpersist()

    return write
