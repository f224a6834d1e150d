"""Benchmark decontamination by SimHash of item-sized windows.

Each benchmark item of m words is held against the windows of m words of every document (the whole document where that is
shorter). Items and windows have a 64-bit SimHash of their word shingles, each occurrence weighing one. Items are listed by the
value of each of ``BLOCKS`` blocks of their fingerprint. Fingerprints within ``RADIUS`` differ in at most RADIUS // BLOCKS bits of
some block, so the lists of all values that near to a window's hold every item within the radius. One item in seven that has
nothing to do with a window is in some such list; one in a thousand is within the radius. These are verified by exact weighted
similarity: the shingle counts' minima against their maxima.

A window that shares no shingle with any item has similarity 0 whatever its fingerprint, so fingerprints are taken only of
windows that hold a shingle of some item.

Items go to the tasks in slices of bounded size, one broadcast at a time. With several slices, documents are numbered and
stored once, and each slice adds the rows in which it finds something.

Nulls and odd rows: null or blank documents and items match nothing; an item of fewer words than a shingle is one shingle and
matches only itself; a null item id is a match without a name; repeated items count once per id; repeated document ids are
judged row by row; without items every document is clean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import filled, mixed, shingles, slices, word_hashes, written

SHINGLE, PERCENT = 5, 80
#: At similarity 0.8 about 9.7 of 64 bits differ, with a deviation of 2.9. 20 bits are 5 in each of 4 blocks at least, so up to 19
#: bits leave 4 or fewer in one.
RADIUS, BLOCKS = 19, 4
#: Items are sent to all tasks in slices of so much text; each slice is one pass over the documents.
SLICE_BYTES = 8 << 20
#: Windows whose fingerprints are taken at a time.
AT_ONCE = 4_096
#: Pairs of a window's and the items' block values that are looked at together.
VALUES_AT_ONCE = 1 << 21

_BITS = np.arange(64, dtype=np.uint64)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 per bit."""
    bits = (mixed(hashes)[:, None] >> _BITS[None, :]) & np.uint64(1)
    return bits.astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BITS[None, :]).sum(1, dtype=np.uint64)


def simhash(hashes: np.ndarray) -> np.uint64:
    return _packed(_signs(hashes).sum(0)[None, :])[0]


def weighted_similar(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sum of minima and of maxima of the counts of two bags of hashes."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    least = int(np.minimum(n[i], m[j]).sum())
    return least, len(a) + len(b) - least


def _each(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which stretch, position) of every element of stretches that start at ``first``."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, first[which] + np.arange(len(which)) - (np.cumsum(sizes) - sizes)[which]


class _Index:
    """Items of one length, listed by the values of each block of bits."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.blocks = []
        for b in range(BLOCKS):
            part = self._block(prints, b)
            items = np.argsort(part, kind="stable").astype(np.int32)
            values, first, sizes = np.unique(part[items], return_index=True, return_counts=True)
            self.blocks.append((values, first.astype(np.int32), sizes.astype(np.int32), items))

    @staticmethod
    def _block(prints: np.ndarray, b: int) -> np.ndarray:
        width = 64 // BLOCKS
        return ((prints >> np.uint64(b * width)) & np.uint64((1 << width) - 1)).astype(np.uint16)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, in rising order."""
        found = [np.zeros(0, np.int64)]
        for b, (values, first, sizes, items) in enumerate(self.blocks):
            part = self._block(prints, b)
            step = max(1, VALUES_AT_ONCE // len(values))
            for at in range(0, len(part), step):
                bits = np.bitwise_count(part[at : at + step, None] ^ values[None, :])
                window, value = np.nonzero(bits <= RADIUS // BLOCKS)
                which, place = _each(first[value], sizes[value])
                window, item = window[which] + at, items[place]
                close = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
                found.append(window[close] * len(items) + item[close])
        return np.divmod(np.unique(np.concatenate(found)), len(self.prints))


class Matcher:
    """Finds a slice of items in texts."""

    def __init__(self, items: list[tuple[int, str]], size: int = SHINGLE, percent: int = PERCENT):
        self.percent = percent
        groups: dict[int, list] = {}
        for item, text in items:
            words = word_hashes(text or "")
            if len(words):
                groups.setdefault(len(words), []).append((item, shingles(words, size)))
        self.lengths: dict[int, tuple] = {}
        by_size: dict[int, list[int]] = {}
        for length, own in groups.items():
            index = _Index(np.array([simhash(s) for _, s in own], np.uint64))
            self.lengths[length] = ([i for i, _ in own], [s for _, s in own], index)
            by_size.setdefault(min(size, length), []).append(length)
        #: By shingle size: the sorted shingles of all its items, where the lengths of items that have each are listed, these
        #: lists, and which first 16 bits there are.
        self.sizes: dict[int, tuple] = {}
        for k, lengths in by_size.items():
            found = [np.unique(np.concatenate(self.lengths[n][1])) for n in lengths]
            hashes, of = np.concatenate(found), np.repeat(np.array(lengths), [len(f) for f in found])
            order = np.lexsort((of, hashes))
            known, first = np.unique(hashes[order], return_index=True)
            filter_ = np.zeros(1 << 16, bool)
            filter_[known >> np.uint64(48)] = True
            self.sizes[k] = known, np.append(first, len(order)), of[order], filter_

    def __call__(self, text: str) -> list[tuple[int, int, int, float]]:
        """The best window for each item found: (item, first word, words, similarity)."""
        words = word_hashes(text)
        best: dict[int, tuple] = {}
        for k, (known, bounds, listed, filter_) in self.sizes.items():
            if len(words) < k:
                continue
            own = shingles(words, k)
            maybe = np.flatnonzero(filter_[own >> np.uint64(48)])
            if not len(maybe):
                continue
            at = np.minimum(np.searchsorted(known, own[maybe]), len(known) - 1)
            hit = known[at] == own[maybe]
            places, at = maybe[hit], at[hit]
            which, place = _each(bounds[at], bounds[at + 1] - bounds[at])
            lengths = listed[place]
            for length in np.unique(lengths).tolist():
                self._windows(own, k, len(words), length, places[which[lengths == length]], best)
        return [(item, *found) for item, (_, *found) in sorted(best.items(), key=lambda b: (b[0] is None, b[0] or 0))]

    def _windows(self, own, k, n_words, length, hits, best) -> None:
        """Windows of ``length`` words that hold one of ``hits``."""
        ids, bags, index = self.lengths[length]
        length = min(length, n_words)
        span = length - k + 1
        first, last = np.maximum(hits - span + 1, 0), np.minimum(hits, n_words - length)
        marks = np.zeros(n_words - length + 2, np.int64)
        np.add.at(marks, first, 1)
        np.add.at(marks, last + 1, -1)
        starts = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
        for part in np.split(starts, np.flatnonzero(np.diff(starts) > span) + 1):
            for at in range(0, len(part), AT_ONCE):
                some = part[at : at + AT_ONCE]
                begin = int(some[0])
                sums = np.zeros((int(some[-1]) - begin + span + 1, 64), np.int32)
                np.cumsum(_signs(own[begin : int(some[-1]) + span]), axis=0, out=sums[1:])
                prints = _packed(sums[some - begin + span] - sums[some - begin])
                for w, i in zip(*index.near(prints)):
                    start = int(some[w])
                    least, most = weighted_similar(own[start : start + span], bags[i])
                    if 100 * least >= self.percent * most:
                        found = (-least / most, start, length, least / most)
                        if ids[i] not in best or found < best[ids[i]]:
                            best[ids[i]] = found


def matchers(
    items: DataFrame,
    id_column: str = "item_id",
    text_column: str = "text",
    slice_bytes: int | None = None,
    **options,
) -> tuple[int, Iterator[Broadcast]]:
    """How many slices the items have, and a broadcast matcher for each of them, made when it is asked for."""
    spark = items.sparkSession
    items = items.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    items = items.where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, -(-total // (slice_bytes or SLICE_BYTES)))

    def each() -> Iterator[Broadcast]:
        for k in range(slices):
            own = items.where(F.pmod(F.xxhash64("text", "id"), F.lit(slices)) == k) if slices > 1 else items
            yield spark.sparkContext.broadcast(Matcher([(r.id, r.text) for r in own.collect()], **options))

    return slices, each()


def _mapped(docs: DataFrame, matcher: Broadcast, row: Callable, schema: str) -> DataFrame:
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = matcher.value
        for batch in slices(batches):
            found = [find(t) for t in filled(batch.column(at)).to_pylist()]
            yield row(batch, found)

    return docs.mapInArrow(run, schema)


def _union_of_slices(docs: DataFrame, matching: Iterator[Broadcast], row: Callable, schema: str, purpose: str) -> DataFrame:
    """What each slice of the items finds, stored slice by slice, so that the driver and the tasks hold one at a time."""
    out = None
    for matcher in matching:
        found = written(_mapped(docs, matcher, row, schema), purpose)
        matcher.destroy()
        out = found if out is None else out.union(found)
    return out


def find_items(docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", **options) -> DataFrame:
    """(id, ``item_id``, ``first_word``, ``words``, ``similarity``): the best window of each item in each document."""

    def rows(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        which = np.repeat(np.arange(len(found)), [len(f) for f in found])
        item, first, words, similarity = zip(*[x for f in found for x in f]) if len(which) else ((),) * 4
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(which, pa.int64())),
                pa.array(item, pa.int64()),
                pa.array(first, pa.int64()),
                pa.array(words, pa.int64()),
                pa.array(similarity, pa.float64()),
            ],
            [id_column, "item_id", "first_word", "words", "similarity"],
        )

    texts = docs.select(F.col(id_column).cast("bigint").alias(id_column), "text")
    schema = f"`{id_column}` bigint, item_id bigint, first_word bigint, words bigint, similarity double"
    count, matching = matchers(items, **options)
    if count == 1:
        return _mapped(texts, next(matching), rows, schema)
    return _union_of_slices(texts, matching, rows, schema, "items-found")


def judge(docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", **options) -> DataFrame:
    """(id, ``n_items``, ``best_item``, ``best_similarity``, ``contaminated``, ``kept``), one row per document.

    ``best_item`` is the most similar one, the smaller id of equals.
    """

    def judged(batch: pa.RecordBatch, found: list) -> list[pa.Array]:
        best = [min(f, key=lambda x: (-x[3], x[0] is None, x[0] or 0), default=(None, 0, 0, None)) for f in found]
        return [
            batch.column(0),
            pa.array([len(f) for f in found], pa.int64()),
            pa.array([b[0] for b in best], pa.int64()),
            pa.array([b[3] for b in best], pa.float64()),
        ]

    def rows(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(judged(batch, found), [id_column, *names])

    def hits(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        some = pa.array([bool(f) for f in found], pa.bool_())
        return pa.RecordBatch.from_arrays(judged(batch, found), ["row", *names]).filter(some)

    names = ["n_items", "best_item", "best_similarity"]
    schema = "n_items bigint, best_item bigint, best_similarity double"
    texts = docs.select(F.col(id_column).cast("bigint").alias(id_column), "text")
    count, matching = matchers(items, **options)
    if count == 1:
        out = _mapped(texts, next(matching), rows, f"`{id_column}` bigint, {schema}")
    else:
        held = written(texts.select(F.monotonically_increasing_id().alias("row"), id_column, "text"), "numbered")
        found = _union_of_slices(held.select("row", "text"), matching, hits, f"row bigint, {schema}", "judged")
        best = F.min(F.struct(-F.col("best_similarity"), F.col("best_item").isNull(), "best_item", "best_similarity"))
        found = found.groupBy("row").agg(F.sum("n_items").alias("n_items"), best.alias("b"))
        found = found.select("row", "n_items", "b.best_item", "b.best_similarity")
        out = held.select("row", id_column).join(found, "row", "left")
        out = out.select(id_column, F.coalesce("n_items", F.lit(0)).alias("n_items"), "best_item", "best_similarity")
    hit = F.col("n_items") > 0
    return out.withColumns({"contaminated": hit, "kept": ~hit})


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents (all their columns) in which no item is found."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def clean(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        return batch.filter(pa.array([not f for f in found], pa.bool_()))

    count, matching = matchers(items, **options)
    if count == 1:
        return _mapped(docs, next(matching), clean, schema)
    for matcher in matching:
        docs = written(_mapped(docs, matcher, clean, schema), "clean-of-slice")
        matcher.destroy()
    return docs
