"""Connected components of a graph of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import stored as checkpointed
from rillflow.operators.checkpoints import Scratch

#: So few different links are contracted by one task; more are dealt out by their ends, round after round.
FEW_LINKS = 100_000


def _state(edges: DataFrame) -> tuple[int, int]:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest id that each end of at most ``FEW_LINKS`` links reaches."""
    table = pa.Table.from_batches(batches, pa.schema([("u", pa.int64()), ("v", pa.int64())]))
    ids, ends = np.unique(np.concatenate([table[c].to_numpy() for c in ("u", "v")]), return_inverse=True)
    one, two = ends.reshape(2, -1)
    least = np.arange(len(ids))
    while (apart := least[one] != least[two]).any():
        a, b = least[one[apart]], least[two[apart]]
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while ((further := least[least]) != least).any():
            least = further
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[least])], ["id", "component"])


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(``id``, ``component``) for every end of a link (``u``, ``v``) between different ids.

    ``component`` is the smallest id reachable. Links are turned into stars around ever smaller ids: in one half of
    a round each id hands its larger neighbours to its smallest one, in the other its smaller ones. Both halves take a
    minimum per id, which Spark adds up before the shuffle, and a join that it can split where an id has many links.
    The number of rounds grows with the logarithm of the longest path. ``FEW_LINKS`` need no rounds. Links are kept in ``scratch``
    where it is given, else as checkpoints.
    """

    def stored(df: DataFrame) -> DataFrame:
        return checkpointed(df) if scratch is None else scratch.written(df, "links")

    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(edges)
    state = _state(edges)
    if state[0] <= FEW_LINKS:
        return edges.coalesce(1).mapInArrow(_contracted, "id bigint, component bigint")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).union(small.where("v <> m").select("v", "m")).distinct()
        edges = stored(small)
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
