"""Starting streams and collecting what they write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rillflow.operators.topn import top_n
from rillflow.sinks import KeyedUpsert
from rillflow.sinks.writers import Writer

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BOUNDED = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
_MEMORY = "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB"
_MEMORY_MB = "256"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep stream state in RocksDB, which the custom processors need.

    Its stores on an executor share a bounded memory, where the session says nothing else.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    if spark.conf.get(_BOUNDED, None) is None:
        spark.conf.set(_BOUNDED, "true")
        spark.conf.set(_MEMORY, _MEMORY_MB)


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process all data that is there now, going on from the checkpoint, and stop."""
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def folder_sink(path: str) -> Writer:
    """Write each batch to its own folder; a replayed batch replaces its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def upsert_sink(table: KeyedUpsert) -> Writer:
    return table.write


def top_n_sink(
    writer: Writer,
    n: int,
    measure: str,
    ties: Sequence[str],
    window: str = "window_end",
) -> Writer:
    """Rank final window counts before they are written.

    For a stream of window aggregates in append mode. All rows of a window turn
    final in the same micro-batch, so ranking within the batch is exact and no
    further state is kept.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(top_n(batch, n, measure, ties, window), batch_id)

    return write
