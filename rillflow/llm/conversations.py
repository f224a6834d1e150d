"""Prefix trie of conversations: which prefixes are shared, by how many, and what sharing them saves.

A node is a distinct sequence of first turns; the root is the empty one. Turns are hashed where they are read
(SHA-256 of role and text, 128 bits kept), so texts are not shuffled. A prefix has a 128-bit digest: the sum over its
turns of a hash of place and turn. Sums can be made in parts, so that a conversation with very many turns lies in many
tasks (:func:`rillflow.operators.running_reduce`).

A count-min sketch over all prefix digests screens them. Its estimate is never below the count, so an estimate of
one proves that a prefix has a single member; what follows it in that conversation is a chain of nodes with one
member each, whose rows are made where they are, without a shuffle. Only the other prefixes, which may be shared, are
grouped by their digests, and wrong suspicions are settled there: the result does not depend on the sketch.

Sums over subtrees need no walk: every node has a representative, its smallest member, and a node's ancestors are
prefixes of its representative. What the nodes of one representative add to an ancestor is a sum over the deeper
places of one conversation, and an ancestor adds that up over its members.

Nulls and odd rows: a null role or text counts as empty; rows without a conversation id take no part; null turns
come first; turns with the same number are ordered by their hashes, and repeated rows are turns of their own; an
empty table has no nodes, not even a root. Further columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import written
from rillflow.operators import running_reduce
from rillflow.operators.arrow import groups
from rillflow.operators.checkpoints import Scratch

#: Turns that a conversation may take over from another.
MOST_TAKEN = 5
#: Cells of a row of the sketch per prefix, and at most. The broadcast takes a bit per cell of both rows: 32 MiB at most.
CELLS_PER_PREFIX, LEAST_CELLS, MOST_CELLS = 8, 1 << 16, 1 << 27
#: Cells of a shard, in which the sketch is added up.
SHARD = 1 << 16
#: Cells that a task counts before it sends them on, and ids that are packed into a row.
COUNTED, PACKED = 1 << 20, 8_192
WRAP = 1 << 64

NODE = ["depth", "p1", "p2"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, chars, row) of every turn; ``row`` only tells equal turns apart."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16).alias("digest"),
        F.char_length(text).cast("bigint").alias("chars"),
        F.monotonically_increasing_id().alias("row"),
    )


def rebuilt(conversations: DataFrame, donor: Column, taken: Column, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Every conversation with the first ``taken`` (0 to 5) turns of the conversation ``donor`` in place of its own.

    Both are made of ``conv_id``; a donor that is a conversation itself gives its original turns. Returns the turns
    (conv_id, depth, digest, chars, last), counted from 1, and the conversations (conv_id, n_turns).
    """
    own = scratch.written(turns(conversations), "turns")
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    sizes = sizes.select("conv_id", "n_own", donor.alias("donor"), taken.cast("bigint").alias("h"))
    # Spark keeps the first rows of each conversation in every task before it shuffles them.
    order = ["turn", "digest", "row"]
    first = own.join(sizes.select(F.col("donor").alias("conv_id")).distinct(), "conv_id", "left_semi")
    first = first.selectExpr(
        "*", f"row_number() over (partition by conv_id order by {', '.join(order)}) as place"
    ).where(F.col("place") <= MOST_TAKEN)
    heads = first.groupBy(F.col("conv_id").alias("donor")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("head")
    )
    convs = sizes.join(heads, "donor", "left").withColumn(
        "head", F.when(F.col("h") > 0, F.slice("head", 1, F.col("h").cast("int")))
    )
    n_head = F.coalesce(F.size("head"), F.lit(0)).cast("bigint")
    n_head = F.when(F.col("head").isNull(), 0).otherwise(n_head).cast("bigint")
    convs = convs.withColumn("n_head", n_head)
    convs = convs.withColumn("n_turns", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    convs = scratch.written(convs.select("conv_id", "h", "head", "n_head", "n_turns"), "conversations")

    # A conversation's row comes before its turns, which take over what they need of it: places taken, turns in their place, length.
    none = F.lit(None)
    sorted_rows = convs.select(
        "conv_id", F.lit(0).alias("kind"), none.cast("bigint").alias("turn"), none.cast("binary").alias("digest"),
        none.cast("bigint").alias("row"), none.cast("bigint").alias("chars"), "h", "n_head", "n_turns",
        F.lit(0).cast("bigint").alias("place"),
    ).unionByName(
        own.select(
            "conv_id", F.lit(1).alias("kind"), "turn", "digest", "row", "chars", none.cast("bigint").alias("h"),
            none.cast("bigint").alias("n_head"), none.cast("bigint").alias("n_turns"), F.lit(1).cast("bigint").alias("place"),
        )
    )
    placed = running_reduce(
        sorted_rows, ["conv_id"], ["kind", *order], ["h", "n_head", "n_turns", "place"], _taken_over,
        folder=scratch.folder("places"),
    )
    rest = placed.where("kind = 1 and place > h").select(
        "conv_id", (F.col("n_head") + F.col("place") - F.col("h")).alias("depth"), "digest", "chars", "n_turns"
    )
    head = convs.select("conv_id", "n_turns", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.place").cast("bigint").alias("depth"), "t.digest", "t.chars", "n_turns"
    )
    both = rest.unionByName(head)
    return both.withColumn("last", F.col("depth") == F.col("n_turns")).drop("n_turns"), convs.select("conv_id", "n_turns")


def _taken_over(left, right):
    first = left if right[0] is None else right
    return (*first[:3], left[3] + right[3])


def _added(left, right):
    """Two 64-bit sums, wrapped to signed numbers."""
    return tuple((a + b + (1 << 63)) % WRAP - (1 << 63) for a, b in zip(left, right))


def prefixes(turns: DataFrame, folder: str | None = None) -> DataFrame:
    """Turns with their hashes (h1, h2) and the digest of the prefix that they end (p1, p2)."""
    marks = [F.xxhash64(F.lit(k), "depth", "digest") for k in (1, 2)]
    rows = turns.select("conv_id", "depth", "chars", "last", marks[0].alias("h1"), marks[1].alias("h2"))
    rows = rows.withColumns({"p1": F.col("h1"), "p2": F.col("h2")})
    summed = running_reduce(rows, ["conv_id"], ["depth"], ["p1", "p2"], _added, folder=folder)

    return summed.select("conv_id", "depth", "chars", "last", "h1", "h2", "p1", "p2")


def sketch(rows: DataFrame, cells: int) -> list[bytes]:
    """The cells of a count-min sketch of two rows that are above one, as bits, for all digests (p1, p2).

    Tasks send the cells that they met with a mark for those met twice, two bytes each, by shard; a shard's task adds
    them up. What comes back has a bit per cell.
    """
    shards = 2 * (cells // SHARD)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            cell, n = np.unique(np.concatenate(held), return_counts=True)
            starts = np.flatnonzero(np.diff(cell // SHARD, prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(cell)]):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(cell[a] // SHARD)], pa.int32()),
                        pa.array([(cell[a:b] % SHARD).astype("<u2").tobytes()], pa.binary()),
                        pa.array([np.packbits(n[a:b] > 1).tobytes()], pa.binary()),
                    ],
                    ["shard", "cells", "twice"],
                )

        for batch in batches:
            held.append(_cells(batch.column(0).to_numpy(), cells))
            held.append(_cells(batch.column(1).to_numpy(), cells) + cells)
            size += 2 * batch.num_rows
            if size >= COUNTED:
                yield from sent()
                held, size = [], 0
        if size:
            yield from sent()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard,), parts in groups(batches, [0]):
            n = np.zeros(SHARD, np.uint8)
            for batch in parts:
                for cell, twice in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    cell = np.frombuffer(cell, "<u2")
                    more = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(cell))
                    n[cell] = np.minimum(n[cell] + 1 + more, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([np.packbits(n > 1).tobytes()], pa.binary())],
                ["shard", "bits"],
            )

    parts = rows.select("p1", "p2").mapInArrow(counted, "shard int, cells binary, twice binary")
    parts = parts.repartition("shard").sortWithinPartitions("shard")
    bits = [bytes(SHARD // 8)] * shards
    # A bit per cell, whatever the input.
    for r in parts.mapInArrow(added, "shard int, bits binary").collect():
        bits[r.shard] = bytes(r.bits)
    return bits


def _cells(digests: np.ndarray, cells: int) -> np.ndarray:
    return (digests.view(np.uint64) >> np.uint64(7)).astype(np.int64) % cells


def screened(rows: DataFrame) -> DataFrame:
    """Prefixes with the digest of the one before them (q1, q2).

    ``alone``: the sketch proves a single member; ``before``: it proves that of the prefix before.
    """
    spark, n = rows.sparkSession, rows.count()
    cells = LEAST_CELLS
    while cells < min(MOST_CELLS, CELLS_PER_PREFIX * n):
        cells *= 2
    bits = spark.sparkContext.broadcast(np.frombuffer(b"".join(sketch(rows, cells)), np.uint8))
    kept = ["conv_id", "depth", "chars", "last", "p1", "p2"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = bits.value

        def proven(p1, p2):
            alone = np.zeros(len(p1), bool)
            for k, digests in enumerate((p1, p2)):
                cell = _cells(digests, cells) + k * cells
                alone |= (shared[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 0
            return alone

        for batch in batches:
            p1, p2, h1, h2 = (batch.column(c).to_numpy() for c in ("p1", "p2", "h1", "h2"))
            q1, q2 = p1 - h1, p2 - h2  # wraps around, as the sums did
            before = proven(q1, q2) & (batch.column("depth").to_numpy() > 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *map(pa.array, (q1, q2, proven(p1, p2), before))],
                [*kept, "q1", "q2", "alone", "before"],
            )

    return rows.mapInArrow(
        look,
        "conv_id bigint, depth bigint, chars bigint, last boolean, p1 bigint, p2 bigint, q1 bigint, q2 bigint, "
        "alone boolean, before boolean",
    )


def digests_of_ids(ends: DataFrame, keys: list[str]) -> DataFrame:
    """SHA-256 of the ids of each key in rising order, as decimals with commas between them.

    Ids are sorted in ranges and packed, so that a key with very many of them is one short list of long texts when it
    comes to one task, which hashes them one after another.
    """
    fields = [f"{n} {t}" for n, t in ends.dtypes if n in keys]
    schema = ", ".join(fields)
    n = len(keys)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, parts in groups(batches, range(n)):
            for batch in parts:
                ids = batch.column(n).to_pylist()
                for at in range(0, len(ids), PACKED):
                    some = ids[at : at + PACKED]
                    row = [pa.array([k], batch.schema.field(c).type) for c, k in enumerate(key)]
                    row += [pa.array([some[0]], pa.int64()), pa.array([",".join(map(str, some)).encode()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(row, [*keys, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, parts in groups(batches, range(n)):
            digest, begun = hashlib.sha256(), False
            for batch in parts:
                for ids in batch.column(n + 1):
                    digest.update((b"," if begun else b"") + ids.as_py())
                    begun = True
            row = [pa.array([k], batch.schema.field(c).type) for c, k in enumerate(key)]
            yield pa.RecordBatch.from_arrays([*row, pa.array([digest.hexdigest()])], [*keys, "ends"])

    ranged = ends.select(*keys, "conv_id").repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    packs = ranged.mapInArrow(packed, f"{schema}, first bigint, ids binary")
    packs = packs.repartition(*keys).sortWithinPartitions(*keys, "first")
    return packs.mapInArrow(hashed, f"{schema}, ends string")


def trie(conversations: DataFrame, donor: Column, taken: Column) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    with Scratch(conversations.sparkSession) as scratch:
        return _trie(conversations, donor, taken, scratch)


def _trie(conversations: DataFrame, donor: Column, taken: Column, scratch: Scratch) -> DataFrame:
    rows, convs = rebuilt(conversations, donor, taken, scratch)
    convs = convs.select("conv_id", "n_turns")
    rows = scratch.written(prefixes(rows, scratch.folder("sums")), "prefixes")
    rows = scratch.written(screened(rows), "screened")
    single = F.col("alone") | F.col("before")
    tails, shared = rows.where(single), rows.where(~single)

    nodes = shared.groupBy(*NODE, "q1", "q2").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if("last").alias("n_ends"),
        F.max("chars").alias("chars"),
    )
    nodes = scratch.written(nodes, "nodes")

    # What is added to all ancestors: leaves, and tokens saved, at the place of each node in its representative's conversation.
    zero = F.lit(0).cast("bigint")
    weights = nodes.select(
        "conv_id", "depth", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"),
        (F.col("n_ends") == F.col("n_convs")).cast("bigint").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    ).where("leaf > 0 or saved > 0")
    # The first node of a tail brings its conversation's one leaf. It may be met twice, so leaves are a maximum, not a sum.
    heads = tails.where("not before")
    marks = heads.where("depth > 1").select(
        "conv_id", "depth", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"),
        F.lit(1).cast("bigint").alias("leaf"), zero.alias("saved"),
    )
    members = shared.select("conv_id", "depth", F.lit(1).alias("kind"), "p1", "p2", zero.alias("leaf"), zero.alias("saved"))
    below = weights.unionByName(marks).unionByName(members).withColumn("up", -F.col("depth"))
    below = running_reduce(
        below, ["conv_id"], ["up", "kind", "leaf", "saved"], ["leaf", "saved"],
        lambda a, b: (max(a[0], b[0]), a[1] + b[1]), folder=scratch.folder("below"),
    )
    below = below.where("kind = 1").groupBy(*NODE).agg(
        F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )

    inner = nodes.select("conv_id", *NODE, "q1", "q2", "n_convs", "n_ends", F.lit(True).alias("grouped"), F.lit(False).alias("last"))
    first = heads.select("conv_id", *NODE, "q1", "q2", zero.alias("n_convs"), zero.alias("n_ends"), F.lit(False).alias("grouped"), "last")
    children = inner.unionByName(first).withColumn("over", F.col("depth") - 1)
    counts = children.groupBy(F.col("over").alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    parents = nodes.select(
        F.col("depth").alias("over"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent")
    )
    # A parent that was not grouped is one of the conversation's own tail.
    linked = children.join(parents, ["over", "q1", "q2"], "left").withColumn(
        "parent_conv_id", F.when(F.col("depth") > 1, F.coalesce("parent", "conv_id"))
    )
    ends = digests_of_ids(shared.where("last").select(*NODE, "conv_id"), NODE)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    own_id = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    grouped = (
        linked.where("grouped").select("conv_id", *NODE, "parent_conv_id", "n_convs")
        .join(counts, NODE, "left").join(below, NODE, "left").join(ends, NODE, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends", nothing).alias("ends_sha256"),
        )
    )
    one = F.lit(1).cast("bigint")
    alone = [
        "conv_id", "depth", "parent_conv_id", one.alias("n_convs"), (~F.col("last")).cast("bigint").alias("n_children"),
        one.alias("n_leaves"), zero.alias("saved_tokens"), F.when(F.col("last"), own_id).otherwise(nothing).alias("ends_sha256"),
    ]
    tail = tails.where("before").withColumn("parent_conv_id", F.col("conv_id")).select(*alone)
    tail = tail.unionByName(linked.where(~F.col("grouped")).select(*alone))
    nodes = scratch.written(grouped.unionByName(tail), "trie")
    root = _root(nodes, convs)
    if root is None:
        return nodes.limit(0)
    # The first turns' parent is the root, whose id is the smallest of all.
    above = F.when(F.col("depth") == 1, F.lit(root[0])).otherwise(F.col("parent_conv_id"))
    nodes = nodes.withColumn("parent_conv_id", above.cast("bigint"))
    return written(nodes.union(conversations.sparkSession.createDataFrame([root], nodes.schema)), "trie")


def _root(nodes: DataFrame, convs: DataFrame) -> tuple | None:
    first, n = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    if not n:
        return None
    top = nodes.where("depth = 1").agg(F.count(F.lit(1)), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    turnless = convs.where("n_turns = 0").select(F.lit(0).alias("root"), "conv_id")
    ends = digests_of_ids(turnless, ["root"]).first()
    ends = ends.ends if ends else hashlib.sha256().hexdigest()
    return (first, 0, None, n, top[0], top[1] or 1, top[2] or 0, ends)
