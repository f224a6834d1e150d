"""Hard negatives of anchors, read from Hilbert-ordered blocks that zone maps choose.

All vectors are sorted along a Hilbert curve per label and written as Parquet rows of ``BLOCK_ROWS`` vectors each,
with the least and largest value of every dimension: the zone map. By interval arithmetic a zone map bounds the inner
product of an anchor with any vector of the block from above and below. Anchors are packed in the same order into
tiles. For each tile the zone maps alone, without the vectors, decide which blocks are read:

- for positives, those of the anchor's label whose upper bound reaches the last place that the anchor's own block
  already fills;
- for negatives, those of other labels whose bounds meet one of the anchor's windows of scores.

A block is sent once to each tile that needs it, in slices of ``SLICE_BLOCKS``; the slices' best rows are then ranked
together. Results are exact: bounds only leave out what cannot be in them. Work is at most anchors times vectors. In
many dimensions without clusters no bound is tight and every block is read, in matrix products.

Components are scaled by a factor and rounded down; scores are integer inner products of these. Missing components of
a shorter vector count as 0. Scores are exact; those beyond 64 bits are set to the nearest 64-bit number.

Nulls and odd rows: rows with a null id, label or vector, or with null or non-finite components, take no part. Every
row that is an anchor has results of its own, also where rows share an id; rows with the anchor's id are none of its
positives or negatives, and other repeated rows are found as often as they occur. Ties go to the smaller id. Empty
tables, and anchors without positives, give no rows. Further columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import written
from rillflow.operators.arrow import groups
from rillflow.operators.checkpoints import Scratch

#: Vectors of a block, anchors of a tile, blocks that one task reads for a tile at a time.
BLOCK_ROWS, TILE_ANCHORS, SLICE_BLOCKS = 128, 4_096, 64
#: The curve runs through the widest dimensions, with so many bits of each.
CURVE_DIMENSIONS, CURVE_BITS = 16, 8
#: Anchors whose scores with a block are held at a time.
CHUNK = 1_024
LEAST, MOST = -(1 << 63) + 2, (1 << 63) - 2

BLOCK, TILE = 0, 1
PACKED = (
    "kind int, id bigint, label bigint, n int, type string, matrix binary, ids binary, low binary, high binary, "
    "labels binary, reach binary"
)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` (unsigned, below ``2 ** bits``) on a Hilbert curve, as bytes that sort.

    From the top bit down, the axes of each sub-cube are exchanged or reflected in the way that the curve turns there
    (Skilling, "Programming the Hilbert curve", 2004); all rows go through the steps at once.
    """
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for axis in range(n):
            turned = (x[axis] >> level) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[axis]) & low).astype(np.uint32)
            x[0] ^= np.where(turned, low, swap).astype(np.uint32)
            if axis:
                x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> level) & 1, (1 << level) - 1, 0).astype(np.uint32)
    x ^= flip
    planes = [(x >> level) & 1 for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


@dataclass
class _Space:
    """Dimensions of a table's vectors and the cells of the curve."""

    dimensions: int
    curve: np.ndarray
    low: np.ndarray
    step: np.ndarray

    def keys(self, matrix: np.ndarray) -> np.ndarray:
        cells = (matrix[:, self.curve] - self.low) / self.step
        return hilbert_keys(np.clip(cells, 0, (1 << CURVE_BITS) - 1), CURVE_BITS)


def _matrix(vectors: pa.Array, dimensions: int, scale: float) -> np.ndarray:
    """Rows of scaled, rounded components, 0 where a vector is shorter."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), dimensions))
    row = np.repeat(np.arange(len(vectors)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.floor(scale * flat)
    return out


def _space(rows: DataFrame, scale: float) -> _Space | None:
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(0)
            m = _matrix(vectors, pc.max(pc.list_value_length(vectors)).as_py(), scale)
            own = np.stack([m.min(0), m.max(0), m.sum(0), (m * m).sum(0)]) if m.size else np.zeros((4, 0))
            if total is None:
                total = own
                continue
            wide = max(total.shape[1], own.shape[1])
            a, b = (np.pad(t, ((0, 0), (0, wide - t.shape[1]))) for t in (total, own))
            total = np.stack([np.minimum(a[0], b[0]), np.maximum(a[1], b[1]), a[2] + b[2], a[3] + b[3]])
        if total is not None:
            arrays = [pa.array(np.arange(total.shape[1])), *map(pa.array, total)]
            yield pa.RecordBatch.from_arrays(arrays, ["d", "low", "high", "s", "ss"])

    parts = rows.select("vector").mapInArrow(measured, "d bigint, low double, high double, s double, ss double")
    # A row per dimension.
    found = parts.groupBy("d").agg(F.min("low"), F.max("high"), F.sum("s"), F.sum("ss")).orderBy("d").collect()
    if not found:
        return None
    _, low, high, s, ss = np.array([tuple(r) for r in found], float).T
    n = max(rows.count(), 1)
    spread = ss / n - (s / n) ** 2
    curve = np.argsort(-spread, kind="stable")[:CURVE_DIMENSIONS]
    step = np.maximum((high - low)[curve] / (1 << CURVE_BITS), 1e-9)
    return _Space(len(found), curve, low[curve], step)


def _pack(matrix: np.ndarray) -> tuple[str, bytes]:
    """The smallest type that holds the numbers, and their bytes."""
    size = np.abs(matrix).max(initial=0)
    kind = "<i2" if size < 1 << 15 else "<i4" if size < 1 << 31 else "<f8"
    return kind, matrix.astype(kind).tobytes()


def _unpack(kind: str, data: bytes, dimensions: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, dimensions).astype(float)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    size = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1)
    if size < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a).dot(whole(b).T) if a.size and b.size else np.zeros((len(a), len(b)), object)
    return np.clip(exact, LEAST, MOST).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of each row of ``a`` with anything in each box (rows of ``low``, ``high``).

    A little wider than the interval arithmetic says, for rounding.
    """
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    far = np.maximum(np.abs(low), np.abs(high)) if len(low) else low
    slack = 1 + 1e-9 * (np.abs(a) @ far.T)
    return least - slack, most + slack


class _Best:
    """The best rows of each of some windows of scores: higher scores first, then smaller ids."""

    def __init__(self, low: np.ndarray, high: np.ndarray, n: int):
        self.low, self.high = low, high
        self.score = np.full((len(low), n), LEAST - 1, np.int64)
        self.id = np.zeros((len(low), n), np.int64)
        self.filled = np.zeros(len(low), np.int64)

    def least(self) -> np.ndarray:
        """Scores below this can be left out."""
        last = self.score[:, -1]
        return np.where(self.filled == self.score.shape[1], np.maximum(self.low, last), self.low)

    def add(self, windows: np.ndarray, found: np.ndarray, ids: np.ndarray, usable: np.ndarray) -> None:
        """``found[k]`` are the scores of ``ids`` for window ``windows[k]``."""
        least, most = self.least()[windows, None], self.high[windows, None]
        r, c = np.nonzero(usable & (found >= least) & (found <= most))
        if not len(r):
            return
        w = windows[r]
        touched = np.unique(w)
        n = self.score.shape[1]
        kept = np.arange(n) < self.filled[touched, None]
        at = np.concatenate([w, np.repeat(touched, n)[kept.ravel()]])
        score = np.concatenate([found[r, c], self.score[touched][kept]])
        own = np.concatenate([ids[c], self.id[touched][kept]])
        order = np.lexsort((own, -score, at))
        at, score, own = at[order], score[order], own[order]
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        rank = np.arange(len(at)) - np.repeat(starts, np.diff([*starts, len(at)]))
        first = rank < n
        self.score[at[first], rank[first]] = score[first]
        self.id[at[first], rank[first]] = own[first]
        self.filled[touched] = np.minimum(np.diff([*starts, len(at)]), n)


def _packs(batches: Iterator[pa.RecordBatch], dimensions: int, scale: float, n_positives: int) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted rows (label, key, id, vector, anchor), and tiles of the anchors among them."""
    part = TaskContext.get().partitionId()
    n_blocks = n_tiles = 0
    tile: list[tuple] = []  # (id, label, vector, least score that may be among the first positives)

    def packed(kind, number, label, matrix, ids, labels=None, reach=None):
        low, high = (matrix.min(0), matrix.max(0)) if kind == BLOCK else (None, None)
        held, data = _pack(matrix)
        values = [kind, part << 32 | number, label, len(ids), held, data, ids.astype("<i8").tobytes()]
        values += [None if x is None else x.tobytes() for x in (low, high, labels, reach)]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), *[pa.binary()] * 6]
        names = [f.split()[0] for f in PACKED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    def packed_tile():
        ids, labels, rows, reach = zip(*tile)
        return packed(
            TILE, n_tiles, None, np.stack(rows), np.array(ids), np.array(labels, "<i8"), np.array(reach, "<i8")
        )

    for (label,), parts in groups(batches, [0]):
        rest = None
        for batch in _ended(parts):
            if batch is not None:
                rest = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            while rest is not None and rest.num_rows and (batch is None or rest.num_rows >= BLOCK_ROWS):
                some, rest = rest.slice(0, BLOCK_ROWS), rest.slice(BLOCK_ROWS)
                matrix, ids = _matrix(some.column(3), dimensions, scale), some.column(2).to_numpy()
                yield packed(BLOCK, n_blocks, label, matrix, ids)
                n_blocks += 1
                for k in np.flatnonzero(some.column(4).to_numpy(zero_copy_only=False)):
                    near = scores(matrix[k : k + 1], matrix)[0][ids != ids[k]]
                    reach = LEAST if len(near) < n_positives else np.sort(near)[-n_positives]
                    tile.append((ids[k], label, matrix[k], reach))
                    if len(tile) == TILE_ANCHORS:
                        yield packed_tile()
                        n_tiles, tile = n_tiles + 1, []
    if tile:
        yield packed_tile()


def _ended(parts: Iterator) -> Iterator:
    yield from parts
    yield None


@dataclass
class _Tile:
    """Anchors, and windows of scores that they look through: which anchor, from, to."""

    id: int
    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool  # whether the windows are of the anchor's label or of all others

    @staticmethod
    def positives(row: dict, dimensions: int) -> _Tile:
        ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        reach = np.frombuffer(row["reach"], "<i8")
        matrix = _unpack(row["type"], row["matrix"], dimensions)
        return _Tile(row["tile"], ids, labels, matrix, np.arange(len(ids)), reach, np.full(len(ids), MOST), True)

    @staticmethod
    def negatives(row: dict, dimensions: int, low: int, high: int) -> _Tile:
        tile = _Tile.positives(row, dimensions)
        found = [p["score"] for p in row["positives"]]
        tile.anchor = np.array([p["anchor"] for p in row["positives"]], np.int64)
        tile.low = np.array([-(-low * s // 100) for s in found], np.int64)
        tile.high = np.array([high * s // 100 for s in found], np.int64)
        tile.same = False
        return tile

    def fits(self, labels: np.ndarray) -> np.ndarray:
        """Windows by blocks: whether the labels suit."""
        same = self.labels[self.anchor][:, None] == labels
        return same if self.same else ~same

    def needs(self, labels: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Blocks that a window must read."""
        out = np.zeros(len(labels), bool)
        for at in range(0, len(self.anchor), CHUNK):
            some = slice(at, at + CHUNK)
            least, most = bounds(self.matrix[self.anchor[some]], low, high)
            meets = (most >= self.low[some, None]) & (least <= self.high[some, None])
            out |= (meets & self.fits(labels)[some]).any(0)
        return out


def _dealt(right: DataFrame, tiles: DataFrame) -> DataFrame:
    """Tiles (with ``tile`` and ``slice``), each in front of the blocks (``block``) of its slice."""
    none = F.lit(None)
    first = tiles.withColumn("block", none.cast(right.schema["block"].dataType))
    rest = right.select(
        *[F.col(c) if c in right.columns else none.cast(tiles.schema[c].dataType).alias(c) for c in first.columns]
    )
    both = first.unionByName(rest)
    return both.repartition("tile", "slice").sortWithinPartitions("tile", "slice", F.col("block").isNotNull())


def _slice_of(block: str, n_slices: int) -> Column:
    return F.pmod(F.xxhash64(block), F.lit(n_slices)).cast("int").alias("slice")


def _rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in parts:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def needed(blocks: DataFrame, tiles: DataFrame, make, n_slices: int) -> DataFrame:
    """(tile, block): which blocks a tile's windows must read, by the zone maps alone."""
    zones = blocks.select(_slice_of("id", n_slices), F.struct("id", "label", "low", "high").alias("block"))
    # The stated queries, in tiles, look at all zone maps, a slice at a time.
    tiles = tiles.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))
    zones = zones.join(tiles.select("tile", "slice"), "slice")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _), parts in groups(batches, [at["tile"], at["slice"]]):
            tile, zones = None, []

            def chosen():
                ids, labels, low, high = zip(*((z["id"], z["label"], z["low"], z["high"]) for z in zones))
                boxes = (np.stack([np.frombuffer(x) for x in side]) for side in (low, high))
                keep = np.array(ids)[tile.needs(np.array(labels), *boxes)]
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keep), tile.id)), pa.array(keep)], ["tile", "block"]
                )

            for row in _rows(parts):
                if row["block"] is None:
                    tile = make(row)
                    continue
                zones.append(row["block"])
                if len(zones) == 512:
                    yield chosen()
                    zones = []
            if zones:
                yield chosen()

    dealt = _dealt(zones, tiles)
    at = {c: k for k, c in enumerate(dealt.columns)}
    return dealt.mapInArrow(choose, "tile bigint, block bigint")


def best(blocks: DataFrame, tiles: DataFrame, need: DataFrame, make, dimensions: int, n_slices: int, n: int) -> DataFrame:
    """(tile, window, id, score): the first ``n`` rows of each window in each slice of the blocks that it needs."""
    payload = blocks.select(
        F.col("id").alias("key"), F.struct("id", "label", "type", "matrix", "ids", "low", "high").alias("block")
    )
    need = need.select("tile", _slice_of("block", n_slices), F.col("block").alias("key"))
    read = payload.join(need, "key").select("tile", "slice", "block")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _), parts in groups(batches, [at["tile"], at["slice"]]):
            tile = found = None
            for row in _rows(parts):
                if row["block"] is None:
                    tile = make(row)
                    found = _Best(tile.low, tile.high, n)
                    continue
                _look_through(tile, found, row["block"], dimensions)
            w, rank = np.nonzero(np.arange(n) < found.filled[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(w), tile.id)), *map(pa.array, (w, found.id[w, rank], found.score[w, rank]))],
                ["tile", "window", "id", "score"],
            )

    dealt = _dealt(read, tiles.join(need.select("tile", "slice").distinct(), "tile"))
    at = {c: k for k, c in enumerate(dealt.columns)}
    rows = dealt.mapInArrow(look, "tile bigint, window bigint, id bigint, score bigint")
    rank = "row_number() over (partition by tile, window order by score desc, id)"
    return rows.selectExpr("*", f"{rank} as rank").where(F.col("rank") <= n)


def _look_through(tile: _Tile, found: _Best, block: dict, dimensions: int) -> None:
    """Take in a block's rows, for the windows that it can still better."""
    low, high = (np.frombuffer(block[c])[None] for c in ("low", "high"))
    label = np.array([block["label"]])
    least, most = bounds(tile.matrix, low, high)
    least, most = least[tile.anchor, 0], most[tile.anchor, 0]
    open_windows = np.flatnonzero(tile.fits(label)[:, 0] & (most >= found.least()) & (least <= tile.high))
    if not len(open_windows):
        return
    rows = _unpack(block["type"], block["matrix"], dimensions)
    ids = np.frombuffer(block["ids"], "<i8")
    anchors = np.unique(tile.anchor[open_windows])
    for begin in range(0, len(anchors), CHUNK):
        some = anchors[begin : begin + CHUNK]
        products = scores(tile.matrix[some], rows)
        place = np.searchsorted(some, tile.anchor[open_windows])
        inside = (place < len(some)) & (some[np.minimum(place, len(some) - 1)] == tile.anchor[open_windows])
        windows, place = open_windows[inside], place[inside]
        other = tile.ids[tile.anchor[windows]][:, None] != ids
        found.add(windows, products[place], ids, other)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    label: Column | str = "label",
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 256,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Per anchor, the ``n_positives`` best other rows of its label are its positives; per positive, the first
    ``n_negatives`` rows of other labels whose score is between ``low`` and ``high`` per cent of the positive's.
    ``is_anchor`` and ``label`` are columns of ``vectors``.
    """
    with Scratch(vectors.sparkSession) as scratch:
        return _mined(
            vectors, is_anchor, F.col(label) if isinstance(label, str) else label, id_column, vector_column,
            scale, n_positives, n_negatives, low, high, scratch,
        )


def _mined(vectors, is_anchor, label, id_column, vector_column, scale, n_positives, n_negatives, low, high, scratch):
    spark = vectors.sparkSession
    result = (
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    )
    rows = vectors.select(
        label.cast("bigint").alias("label"),
        F.col(id_column).cast("bigint").alias("id"),
        F.col(vector_column).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.where("label is not null and id is not null and vector is not null").where(finite)
    space = _space(rows, scale)
    if space is None:
        return spark.createDataFrame([], result)
    dimensions = space.dimensions

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = space.keys(_matrix(batch.column(2), dimensions, scale))
            key = pa.array([k.tobytes() for k in keys], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), key, *batch.columns[1:]], ["label", "key", "id", "vector", "anchor"]
            )

    kind = rows.schema["vector"].dataType.simpleString()
    rows = rows.mapInArrow(keyed, f"label bigint, key binary, id bigint, vector {kind}, anchor boolean")
    order = ["label", "key", "id"]
    packs = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    packs = packs.mapInArrow(lambda b: _packs(b, dimensions, scale, n_positives), PACKED)
    path = scratch.folder("blocks")
    packs.write.partitionBy("kind").parquet(path)
    stored = spark.read.schema(packs.schema).parquet(path)
    blocks = stored.where(F.col("kind") == BLOCK)
    tiles = stored.where(F.col("kind") == TILE).select(F.col("id").alias("tile"), "type", "matrix", "ids", "labels", "reach")
    n_slices = max(1, -(-blocks.count() // SLICE_BLOCKS))

    def first(row):
        return _Tile.positives(row, dimensions)

    need = scratch.written(needed(blocks, tiles, first, n_slices), "needed")
    near = best(blocks, tiles, need, first, dimensions, n_slices, n_positives)
    # At most ``n_positives`` per anchor of a tile.
    lists = near.groupBy("tile").agg(
        F.sort_array(F.collect_list(F.struct(F.col("window").alias("anchor"), "rank", "id", "score"))).alias("positives")
    )
    tiles = scratch.written(tiles.join(lists, "tile"), "tiles")

    def second(row):
        return _Tile.negatives(row, dimensions, low, high)

    need = scratch.written(needed(blocks, tiles, second, n_slices), "needed")
    found = best(blocks, tiles, need, second, dimensions, n_slices, n_negatives)
    windows = tiles.select("tile", "ids", F.posexplode("positives").alias("window", "p"))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids").dictionary_encode()
            ids = [np.frombuffer(x, "<i8") for x in lists.dictionary.to_pylist()]
            own = [ids[k][a] for k, a in zip(lists.indices.to_pylist(), batch.column("anchor").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tile"), batch.column("window"), pa.array(own, pa.int64()), *batch.columns[4:]],
                ["tile", "window", "anchor_id", "positive_id", "positive_score"],
            )

    windows = windows.select(
        "tile", F.col("window").cast("bigint").alias("window"), "ids", F.col("p.anchor").alias("anchor"),
        F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"),
    )
    windows = windows.mapInArrow(
        named, "tile bigint, window bigint, anchor_id bigint, positive_id bigint, positive_score bigint"
    )
    found = found.join(windows, ["tile", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
    return written(found, "negatives")
