"""Embedding near-duplicates by dual traversal of cover trees.

On unit vectors, cosine >= t is distance <= sqrt(2 - 2t). Vectors are gathered around a bounded number of pivots, cells are
cut into blocks, and each block holds a cover tree: nested levels of centres with halving radii, where each centre also
knows the farthest vector it stands for. Two trees are descended together. A pair of nodes whose centres are farther apart
than both radii and the limit is dropped; a pair so close that all its vectors must be linked is taken whole; the rest goes
down to single vectors, which are compared in double precision. The same bounds first drop pairs of cells and of blocks. All
pairs over the limit are found, and none is sent anywhere: a task returns a count per vector and a spanning forest.

Nulls and odd rows: a vector that is null, empty, zero or has a null or non-finite component, and one without a label or
id, links with nothing; vectors of different lengths do not link; rows that share an id are one vertex, whose links to other
ids are counted row by row; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import stored, written
from rillflow.llm.components import components

#: Vectors of a block, about, and pivots at most.
BLOCK_ROWS, MOST_PIVOTS = 512, 1_024
#: Bounds are widened by this, far above rounding errors of distances.
SLACK = 1e-7


def unit(raw: np.ndarray) -> np.ndarray:
    raw = raw / np.abs(raw).max(1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def cover_tree(points: np.ndarray, finest: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels (centres, each point's centre, covering radii) from one node down to single points.

    Every centre of a level is one of the next. Within a node, a point that is farther than the level's radius from all
    centres so far becomes a centre; then each point goes to the nearest one. Radii halve until ``finest``.
    """
    far = distances(points, points)
    n = len(points)
    centres, owner = np.zeros(1, np.int32), np.zeros(n, np.int32)
    reach = far[0]
    levels = [(centres, owner, np.array([reach.max()]))]
    radius = levels[0][2][0]
    while len(centres) < n and radius > finest:
        radius = radius / 2
        new, of = list(centres), list(range(len(centres)))
        open_ = reach > radius
        for k in range(n):
            if open_[k]:
                new.append(k)
                of.append(int(owner[k]))
                open_ &= ~((owner == owner[k]) & (far[k] <= radius))
        new, of = np.array(new, np.int32), np.array(of, np.int32)
        near = np.where(owner[:, None] == of[None, :], far[:, new], np.inf)
        owner = near.argmin(1).astype(np.int32)
        owner[new] = np.arange(len(new), dtype=np.int32)
        reach = far[np.arange(n), new[owner]]
        radii = np.zeros(len(new))
        np.maximum.at(radii, owner, reach)
        centres = new
        levels.append((centres, owner, radii))
    if len(centres) < n:
        everyone = np.arange(n, dtype=np.int32)
        levels.append((everyone, everyone, np.zeros(n)))
    return levels


def linked(a: np.ndarray, tree_a: list, b: np.ndarray, tree_b: list, threshold: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (unit vectors) have a cosine of ``threshold`` or more."""
    limit = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    out = np.zeros((len(a), len(b)), bool)
    alive, before = np.ones((1, 1), bool), None
    last = max(len(tree_a), len(tree_b)) - 1
    for depth in range(last + 1):
        (ca, own_a, ra), (cb, own_b, rb) = tree_a[min(depth, len(tree_a) - 1)], tree_b[min(depth, len(tree_b) - 1)]
        if before:
            alive = alive[before[0][ca]][:, before[1][cb]]
        rows, cols = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        cosine = a[ca[rows]] @ b[cb[cols]].T
        if depth == last:  # single vectors on both sides
            found = np.zeros_like(alive)
            found[np.ix_(rows, cols)] = cosine >= threshold
            out |= (found & alive)[own_a][:, own_b]
            break
        gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))
        reach = ra[rows][:, None] + rb[cols][None, :]
        some = np.zeros_like(alive)
        some[np.ix_(rows, cols)] = gap <= reach + limit + SLACK
        alive &= some
        whole = np.zeros_like(alive)
        whole[np.ix_(rows, cols)] = gap + reach <= limit - SLACK
        whole &= alive
        if whole.any():
            out |= whole[own_a][:, own_b]
            alive &= ~whole
        if not alive.any():
            break
        before = own_a, own_b
    return out


def _forest(rows: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each linked id the smallest id that its links reach here."""
    low_a = ids_a.copy()
    low_b = ids_b.copy()
    top = np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(low_a, np.where(rows, low_b[None, :], top).min(1))
        new_b = np.minimum(low_b, np.where(rows, new_a[:, None], top).min(0))
        if (new_a == low_a).all() and (new_b == low_b).all():
            break
        low_a, low_b = new_a, new_b
    u, v = np.concatenate([ids_a, ids_b]), np.concatenate([low_a, low_b])
    return u[u != v], v[u != v]


def _compare(row: dict, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids_a, a, tree_a = _unpacked(row, "a")
    same = row["a"] == row["b"]
    ids_b, b, tree_b = (ids_a, a, tree_a) if same else _unpacked(row, "b")
    rows = linked(a, tree_a, b, tree_b, threshold) & (ids_a[:, None] != ids_b[None, :])
    if not rows.any():
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing
    ids, n = ids_a, rows.sum(1)
    if not same:
        ids, n = np.concatenate([ids_a, ids_b]), np.concatenate([n, rows.sum(0)])
    u, v = _forest(rows, ids_a, ids_b)
    return ids[n > 0], n[n > 0], u, v


def _packed_block(table: pa.Table, finest: float) -> pa.Table:
    ids = np.array(table.column("id").to_pylist(), np.int64)
    order = np.lexsort((ids, np.array(table.column("away").to_pylist())))
    raw = np.array([np.frombuffer(v, "<f8") for v in table.column("vector").to_pylist()])[order]
    points = unit(raw)
    tree = cover_tree(points, finest)
    first = table.slice(0, 1)
    return pa.table(
        {
            "cell": first.column("cell"),
            "block": pa.array([f"{first.column('cell')[0].as_py()}/{first.column('chunk')[0].as_py()}"]),
            "size": pa.array([len(ids)], pa.int32()),
            "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
            "points": pa.array([points.astype("<f8").tobytes()], pa.binary()),
            "sizes": pa.array([[len(c) for c, _, _ in tree]], pa.list_(pa.int32())),
            "tree": pa.array(
                [b"".join(c.astype("<i4").tobytes() + o.astype("<i4").tobytes() + r.astype("<f8").tobytes() for c, o, r in tree)],
                pa.binary(),
            ),
        }
    )


def _unpacked(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, list]:
    n = row[f"{side}_size"]
    ids = np.frombuffer(row[f"{side}_ids"], "<i8")
    points = np.frombuffer(row[f"{side}_points"], "<f8").reshape(n, -1)
    data, at, tree = row[f"{side}_tree"], 0, []
    for k in row[f"{side}_sizes"]:
        centres = np.frombuffer(data, "<i4", k, at)
        owner = np.frombuffer(data, "<i4", n, at + 4 * k)
        radii = np.frombuffer(data, "<f8", k, at + 4 * (k + n))
        at += 4 * (k + n) + 8 * k
        tree.append((centres, owner, radii))
    return ids, points, tree


def _cell_pairs(cells: list, pivots: dict[int, np.ndarray], limit: float) -> list[tuple[int, int]]:
    """Cells (``cell``, ``group``, ``radius``) of one group that may hold a pair within the limit."""
    groups: dict[str, list] = {}
    for c in cells:
        groups.setdefault(c.group, []).append(c)
    out = []
    for own in groups.values():
        named = [c for c in own if c.cell in pivots]
        # A group that has no pivot is one cell, which is compared with itself.
        out += [(c.cell, c.cell) for c in own if c.cell not in pivots]
        if named:
            gap = distances(*[np.stack([pivots[c.cell] for c in named])] * 2)
            reach = np.array([c.radius for c in named])
            near = gap <= reach[:, None] + reach[None, :] + limit + SLACK
            np.fill_diagonal(near, True)
            out += [(named[i].cell, named[j].cell) for i, j in zip(*np.nonzero(np.triu(near)))]
    return out


def link_vectors(
    vectors: DataFrame,
    *,
    threshold: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, ``n_links``, ``component_id``, ``kept``) for every row; links join equal labels only."""
    spark = vectors.sparkSession
    limit = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    everything = vectors.select(F.col(id_column).cast("bigint").alias("id"))
    value = F.col("v")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (
        vectors.select(
            F.col(id_column).cast("bigint").alias("id"),
            F.col(vector_column).cast("array<double>").alias("v"),
            F.col(label_column).cast("string").alias("label"),
        )
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & value.isNotNull())
        .where(~bad & F.exists(value, lambda x: x != 0))
        .select("id", "v", F.concat_ws(":", F.size("v").cast("string"), "label").alias("group"))
    )

    total = usable.count()
    share = min(1.0, min(MOST_PIVOTS, total / block_rows) / max(total, 1))
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))
    found = usable.where(drawn).limit(2 * MOST_PIVOTS).collect()
    found = sorted(found, key=lambda r: (r.group, r.id))
    pivots = {k: unit(np.array([r.v]))[0] for k, r in enumerate(found)}
    by_group: dict[str, list[int]] = {}
    for k, r in enumerate(found):
        by_group.setdefault(r.group, []).append(k)
    centres = {g: (np.array(k), np.stack([pivots[i] for i in k])) for g, k in by_group.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_024):
                batch = whole.slice(at, 1_024)
                groups = np.array(batch.column(2).to_pylist(), object)
                vectors = batch.column(1).to_pylist()
                cells, away = np.zeros(len(groups), np.int64), np.zeros(len(groups))
                for g in set(groups):
                    rows = np.flatnonzero(groups == g)
                    if g not in centres:
                        cells[rows] = -1
                        continue
                    ids, points = centres[g]
                    gap = distances(unit(np.array([vectors[i] for i in rows])), points)
                    cells[rows], away[rows] = ids[gap.argmin(1)], gap.min(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(2),
                        pa.array(cells),
                        pa.array(away),
                        pa.array([np.array(v, "<f8").tobytes() for v in vectors], pa.binary()),
                    ],
                    ["id", "group", "cell", "away", "vector"],
                )

    placed = usable.mapInArrow(assign, "id bigint, group string, cell bigint, away double, vector binary")
    # A group without a pivot is a cell of its own, with a number that no pivot has.
    own = -1 - F.abs(F.xxhash64("group") % (1 << 62))
    placed = written(placed.withColumn("cell", F.when(F.col("cell") < 0, own).otherwise(F.col("cell"))), "vectors")
    cells = placed.groupBy("group", "cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n"))
    cells = stored(cells.withColumn("chunks", F.ceil(F.col("n") / block_rows)))

    chunk = F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks"))
    blocks = placed.join(cells.select("group", "cell", "chunks"), ["group", "cell"]).withColumn("chunk", chunk)
    blocks = blocks.groupBy("group", "cell", "chunk").applyInArrow(
        lambda table: _packed_block(table, limit / 4),
        "cell bigint, block string, size int, ids binary, points binary, sizes array<int>, tree binary",
    )
    blocks = written(blocks, "blocks")

    with_pivot = cells.where("cell >= 0").collect()
    pairs = _cell_pairs(with_pivot, pivots, limit)
    pairs = spark.createDataFrame(pairs, "cell_a bigint, cell_b bigint")
    pairs = pairs.union(cells.where("cell < 0").select("cell", "cell"))
    heads = blocks.select("cell", "block")
    pairs = (
        pairs.join(heads.select(F.col("cell").alias("cell_a"), F.col("block").alias("a")), "cell_a")
        .join(heads.select(F.col("cell").alias("cell_b"), F.col("block").alias("b")), "cell_b")
        .where((F.col("cell_a") != F.col("cell_b")) | (F.col("a") <= F.col("b")))
        .select("a", "b")
    )

    def side(name: str) -> DataFrame:
        return blocks.select(
            F.col("block").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("size", "ids", "points", "sizes", "tree")]
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}
                ids, n, u, v = _compare(row, threshold)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([ids, u])),
                        pa.array(np.concatenate([n, np.zeros(len(u), np.int64)])),
                        pa.array(np.concatenate([ids, v])),
                    ],
                    ["id", "n", "other"],
                )

    found = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(compare, "id bigint, n bigint, other bigint")
    found = written(found, "links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n_links"))
    groups = components(found.where("id <> other").select(F.col("id").alias("u"), F.col("other").alias("v")))
    component = F.coalesce("component", "id")
    return (
        everything.join(counts, "id", "left")
        .join(groups, "id", "left")
        .select(
            F.col("id").alias(id_column),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
        )
    )
