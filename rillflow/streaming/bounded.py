"""What a stream that has ended leaves behind: windows still open, rows dropped as late."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillflow.operators.windows import COUNT, Aggregates, OwnAggregate


def open_windows(
    spark: SparkSession, checkpoint: str, keys: Sequence[str], aggregates: Aggregates = COUNT
) -> DataFrame:
    """The windows that :func:`rillflow.streaming.tumbling` has not closed when its query stopped, as in its result.

    A stream closes a window when the watermark passes its end, which the end of the input does not bring about. The
    state that the last batch left at ``checkpoint`` holds what is open: with the rows that were written it makes the
    result of the whole input. The query must have stopped.
    """
    if any(isinstance(a, OwnAggregate) for a in aggregates.values()):
        raise ValueError("the state of an own aggregate cannot be read as its result")
    state = spark.read.format("statestore").load(checkpoint)
    values = state.schema["value"].dataType.names
    return state.select(
        *[F.col(f"key.`{k}`").alias(k) for k in keys],
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        *[F.col("value").getField(v).alias(name) for v, name in zip(values, aggregates)],
    )


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """(batch_id, watermark, operator, name, rows_dropped) of a query's recent batches, one row per stateful operator.

    ``rows_dropped`` are the rows that an operator left out because they were behind the watermark; an aggregate counts
    them after folding the rows of a task. Spark keeps ``spark.sql.streaming.numRecentProgressUpdates`` batches.
    """
    rows = []
    for report in query.recentProgress:
        batch = json.loads(report.json)
        watermark = batch.get("eventTime", {}).get("watermark")
        for place, operator in enumerate(batch["stateOperators"]):
            rows.append(
                (batch["batchId"], watermark, place, operator["operatorName"], operator["numRowsDroppedByWatermark"])
            )
    table = spark.createDataFrame(
        rows, "batch_id bigint, watermark string, operator int, name string, rows_dropped bigint"
    )
    return table.withColumn("watermark", F.col("watermark").cast("timestamp"))

