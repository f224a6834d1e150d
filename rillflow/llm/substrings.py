"""Removal of byte strings that occur in an earlier document, by a hash-compared suffix sort.

Every window of ``LENGTH`` bytes has an anchor: the K-gram in it with the least hash, the first of equals. As that depends on
the window's bytes alone, equal windows have equal anchors at equal places, and it is enough to compare windows of one anchor.
A run is a stretch of neighbouring windows of one anchor occurrence.

1. Documents are dealt into groups of about ``GROUP_BYTES`` by id and stored in a bucketed table, so that later passes join
   on the group without moving texts again. Each group sends its anchors once each, with the number of its documents that
   have them; anchors of one document only go no further.
2. Each group sends the runs of the other anchors, one per different run, to the anchor's bucket; all but the first document
   of equal runs in a group are settled there, byte by byte. Runs of one anchor overlap those of the next, so what is sent to a
   bucket is compressed. Anchors of more than ``HOT_DOCS`` documents send single windows, keyed by
   their bytes, so that nothing that many documents hold meets in one task more than once per group.
3. A bucket settles equal runs by the smallest document, then sorts the suffixes that start at the windows of the remaining
   runs: a mergesort whose comparisons find the common extension by binary search over polynomial prefix hashes. Neighbours
   that share ``LENGTH`` bytes are verified byte by byte; the smallest document of such a class keeps the bytes.
4. Each group cuts the covered bytes out of its documents.

Nulls and odd rows: a null or empty text is empty bytes; a row without an id neither gives nor loses bytes; rows that share an
id do not cover each other; documents shorter than the window keep all bytes; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import mixed, utf8, written

LENGTH, K = 50, 24
GROUP_BYTES = 4 << 20
#: Anchors, or runs, that meet in a bucket, about.
BUCKET_ROWS = 200_000
HOT_DOCS = 400
#: Bytes whose arrays are held at a time; longer documents are cut, with windows across cuts kept whole.
PIECE = 1 << 18

_POSITION = np.uint64((1 << 24) - 1)
#: Two primes below 2**31 and a base for each: sums of 2**24 products stay below 2**63.
_PRIMES, _BASES = (2147483647, 2147483629), (1103515245, 48271)


class Prefix:
    """Polynomial prefix hashes of bytes modulo a prime."""

    def __init__(self, data: np.ndarray, which: int = 0):
        self.p = np.uint64(_PRIMES[which])
        up = _powers(_BASES[which], len(data) + 1, _PRIMES[which])
        self.down = _powers(pow(_BASES[which], -1, _PRIMES[which]), len(data) + 1, _PRIMES[which])[: len(data) + 1]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of each stretch, the same wherever it stands."""
        return (self.sums[end] - self.sums[begin]) % self.p * self.down[begin] % self.p


def _powers(base: int, size: int, prime: int) -> np.ndarray:
    """At least ``size`` powers; those for a piece are kept."""
    return _piece_powers(base, prime) if size <= 2 * PIECE else _all_powers(base, size, prime)


@functools.cache
def _piece_powers(base: int, prime: int) -> np.ndarray:
    return _all_powers(base, 2 * PIECE, prime)


def _all_powers(base: int, size: int, prime: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    done = 1
    while done < size:
        step = np.uint64(pow(base, done, prime))
        out[done : 2 * done] = out[: min(done, size - done)] * step % np.uint64(prime)
        done *= 2
    return out


def _eights(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a number."""
    x = data.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    return x


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, number of windows, place of the anchor in the first window) of concatenated texts."""
    nothing = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return nothing.astype(np.uint64), nothing, nothing, nothing
    x = _eights(data)
    size = len(data) - K + 1
    grams = np.full(size, K, np.uint64)
    for at in range(0, K, 8):
        grams = mixed(grams * np.uint64(0x9E3779B97F4A7C15) + x[at : at + size])
    keys = (grams & ~_POSITION) | np.arange(size, dtype=np.uint64)
    owner = (_sliding_min(keys, LENGTH - K + 1) & _POSITION).astype(np.int64)
    marks = np.zeros(len(data) + 1, np.int32)
    long = np.diff(ends) >= LENGTH
    np.add.at(marks, ends[:-1][long], 1)
    np.add.at(marks, ends[1:][long] - LENGTH + 1, -1)
    valid = np.cumsum(marks)[: len(owner)] > 0
    joined = valid[1:] & valid[:-1] & (owner[1:] == owner[:-1])
    first, last = valid.copy(), valid.copy()
    first[1:] &= ~joined
    last[:-1] &= ~joined
    begin, stop = np.flatnonzero(first), np.flatnonzero(last)
    anchor = owner[begin]
    return grams[anchor], begin, stop - begin + 1, anchor - begin


def _cut(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of texts: bytes, bounds, and for each bounded stretch its row and its first byte's place in the row."""
    data, ends = utf8(texts)
    rows, begins, stops = [], [], []
    size = 0
    for row in range(len(ends) - 1):
        begin, stop = int(ends[row]), int(ends[row + 1])
        for at in range(begin, max(begin + 1, stop - LENGTH + 1), PIECE):
            end = min(at + PIECE + LENGTH - 1, stop)
            if size and size + end - at > PIECE:
                yield _piece(data, ends, rows, begins, stops)
                rows, begins, stops, size = [], [], [], 0
            rows.append(row)
            begins.append(at)
            stops.append(end)
            size += end - at
    if rows:
        yield _piece(data, ends, rows, begins, stops)


def _piece(data, ends, rows, begins, stops):
    rows, begins, stops = np.array(rows), np.array(begins), np.array(stops)
    if (begins[1:] == stops[:-1]).all():
        part = data[begins[0] : stops[-1]]
    else:
        part = np.concatenate([data[b:s] for b, s in zip(begins, stops)])
    return part, np.append(0, np.cumsum(stops - begins)), rows, begins - ends[rows]


def _sorted_group(table: pa.Table) -> tuple[np.ndarray, pa.Array]:
    table = table.sort_by([("id", "ascending"), ("text", "ascending")]).combine_chunks()
    texts = table.column("text")
    texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.string())
    return table.column("id").to_numpy(), texts


def _all_runs(table: pa.Table):
    """Per piece: ids by row, the runs with row and place, and the piece's bytes."""
    ids, texts = _sorted_group(table)
    for data, ends, rows, places in _cut(texts):
        anchors, begin, n, off = runs(data, ends)
        which = np.searchsorted(ends, begin, side="right") - 1
        yield ids, data, anchors, begin, n, off, rows[which], begin - ends[which] + places[which]


def _in_bucket(anchors: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of an anchor, and 32 more bits of it."""
    return ((anchors >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), anchors.astype(np.uint32)


def _by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each key."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        yield int(keys[rows[0]]), rows


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the stretches of ``size`` bytes, eight at least, at ``a`` and at ``b`` are equal: compared eight bytes at a time."""
    same = np.ones(len(a), bool)
    if not len(a):
        return same
    eight = _eights(data)
    for at in range(0, len(a), 1 << 16):
        some = slice(at, at + (1 << 16))
        steps = (size[some] + 7) // 8
        first = np.cumsum(steps) - steps
        place = 8 * (np.arange(int(steps.sum())) - np.repeat(first, steps))
        place = np.minimum(place, np.repeat(size[some] - 8, steps))
        equal = eight[np.repeat(a[some], steps) + place] == eight[np.repeat(b[some], steps) + place]
        same[some] = np.logical_and.reduceat(equal, first)
    return same


def _binary(values: list) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


# --- 1: anchors ---------------------------------------------------------------------


def _anchors_of_group(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        found, docs = [], []
        for ids, _, anchors, _, _, _, rows, _ in _all_runs(table):
            found.append(anchors)
            docs.append(ids[rows])
        anchors = np.concatenate(found) if found else np.zeros(0, np.uint64)
        docs = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        order = np.lexsort((docs, anchors))
        anchors, docs = anchors[order], docs[order]
        new = np.ones(len(anchors), bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (docs[1:] != docs[:-1])
        anchors, count = np.unique(anchors[new], return_counts=True)
        bucket, low = _in_bucket(anchors, buckets)
        out = [(b, low[r], np.minimum(count[r], 255).astype(np.uint8)) for b, r in _by(bucket)]
        group = table.column("g")[0].as_py() if table.num_rows else 0
        return pa.table(
            {
                "bucket": pa.array([b for b, _, _ in out], pa.int32()),
                "g": pa.array([group] * len(out), pa.int32()),
                "anchors": _binary([a for _, a, _ in out]),
                "docs": _binary([c for _, _, c in out]),
            }
        )

    return run


def _shared_anchors(table: pa.Table, hot_docs: int) -> pa.Table:
    """For each group the anchors of a bucket that several documents have, those of many documents apart."""
    groups = table.column("g").to_pylist()
    lists = [np.frombuffer(x, np.uint32) for x in table.column("anchors").to_pylist()]
    anchors = np.concatenate(lists)
    docs = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("docs").to_pylist()])
    of = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    _, back = np.unique(anchors, return_inverse=True)
    total = np.bincount(back, docs)[back]
    shared = total > 1
    out = {}
    for k, rows in _by(of[shared]):
        own = np.flatnonzero(shared)[rows]
        hot = total[own] > hot_docs
        out[k] = np.sort(anchors[own][~hot]), np.sort(anchors[own][hot])
    bucket = table.column("bucket")[0].as_py()
    return pa.table(
        {
            "g": pa.array([groups[k] for k in out], pa.int32()),
            "bucket": pa.array([bucket] * len(out), pa.int32()),
            "shared": _binary([a for a, _ in out.values()]),
            "hot": _binary([h for _, h in out.values()]),
        }
    )


# --- 2: runs ------------------------------------------------------------------------

_ITEM = np.dtype([("key", "<u8"), ("mark", "<u8"), ("doc", "<i8"), ("row", "<u4"), ("at", "<u4"), ("n", "u1"), ("off", "u1")])


def _packed_items(items: np.ndarray, texts: list[bytes]) -> tuple[bytes, bytes]:
    """Items field by field and their bytes, each compressed."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    return squeeze(b"".join(items[f].tobytes() for f in _ITEM.names)), squeeze(b"".join(texts))


def _unpacked_items(packed: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(packed) if packed else b""
    items = np.zeros(len(data) // _ITEM.itemsize, _ITEM)
    at = 0
    for f in _ITEM.names:
        items[f] = np.frombuffer(data, _ITEM[f], len(items), at)
        at += items[f].nbytes
    return items


def _spans(rows: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of rows, with those that touch joined."""
    order = np.lexsort((begin, rows))
    rows, begin, end = rows[order], begin[order], end[order]
    if not len(rows):
        return rows, begin, end
    # The farthest end so far within a row: rows are set far apart for one running maximum.
    far = np.int64(1) << 40
    reach = np.maximum.accumulate(end + rows * far)
    new = np.append(True, (begin + rows * far)[1:] > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    return rows[first], begin[first], reach[last] - rows[first] * far


def _interval_row(group: int, rows, begin, end, bucket: int = -1) -> dict:
    rows, begin, end = _spans(rows.astype(np.int64), begin.astype(np.int64), end.astype(np.int64))
    packed = np.stack([rows, begin, end], 1).astype("<i8").tobytes()
    return {"bucket": bucket, "g": group, "items": b"", "bytes": b"", "spans": packed}


_RUN_ROW = "bucket int, g int, items binary, bytes binary, spans binary"


def _runs_of_group(buckets: int, targets: int):
    """``buckets``: of the shared anchors; ``targets``: where runs are sent."""

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        group = table.column("g")[0].as_py() if table.num_rows else 0
        known = {}
        for name in ("shared", "hot"):
            parts = [
                np.frombuffer(x, np.uint32).astype(np.uint64) | np.uint64(b << 32)
                for b, x in zip(replies.column("bucket").to_pylist(), replies.column(name).to_pylist())
            ]
            known[name] = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
        items, texts, settled = [], [], []
        pieces = _all_runs(table) if replies.num_rows else ()
        for ids, data, anchors, begin, n, off, rows, places in pieces:
            bucket, low = _in_bucket(anchors, buckets)
            code = (bucket.astype(np.uint64) << np.uint64(32)) | low
            hot = _member(code, known["hot"])
            plain = np.flatnonzero(_member(code, known["shared"]))
            # Runs of hot anchors become windows.
            wide = np.flatnonzero(hot)
            which = np.repeat(wide, n[wide])
            step = np.arange(len(which)) - np.repeat(np.cumsum(n[wide]) - n[wide], n[wide])
            src = np.concatenate([plain, which])
            shift = np.concatenate([np.zeros(len(plain), np.int64), step])
            count = np.concatenate([n[plain], np.ones(len(which), np.int64)])
            start = begin[src] + shift
            one, two = Prefix(data, 0), Prefix(data, 1)
            stop = start + count - 1 + LENGTH
            mark = one(start, stop) | (two(start, stop) << np.uint64(31))
            item = np.zeros(len(src), _ITEM)
            item["mark"] = mark
            item["key"] = np.where(np.arange(len(src)) < len(plain), anchors[src], mixed(mark))
            item["doc"], item["row"], item["at"] = ids[rows[src]], rows[src], places[src] + shift
            item["n"] = count
            item["off"] = np.where(np.arange(len(src)) < len(plain), off[src], 0)
            # Settled here, or one of this piece and group for all; the bytes go with it.
            items.append(item)
            texts.append((data, start, stop))
        out = []
        if items:
            sizes = [len(i) for i in items]
            item = np.concatenate(items)
            piece = np.repeat(np.arange(len(items)), sizes)
            start = np.concatenate([t[1] for t in texts])
            stop = np.concatenate([t[2] for t in texts])
            order = np.lexsort((item["doc"], item["off"], item["n"], item["mark"], item["key"]))
            least, one = _least_doc(item[order], ("key", "mark", "n", "off"))
            later = np.flatnonzero(item["doc"][order] > least)
            # Equal hashes only propose: a run is settled when its bytes are those of the first document's run.
            base = np.cumsum([0, *(len(t[0]) for t in texts)])[piece]
            size = (stop - start)[order[later]]
            a, b = ((base + start)[order[x]] for x in (later, one[later]))
            later = later[_same_bytes(np.concatenate([t[0] for t in texts]), a, b, size)]
            done = order[later]
            settled.append((item["row"][done], item["at"][done], item["at"][done].astype(np.int64) + stop[done] - start[done]))
            rest = np.sort(np.delete(order, later))
            target = (mixed(item["key"][rest]) % np.uint64(targets)).astype(np.int64)
            for t, rows in _by(target):
                own = rest[rows]
                sent = [texts[p][0][b:e].tobytes() for p, b, e in zip(piece[own], start[own], stop[own])]
                packed, sent = _packed_items(item[own], sent)
                out.append({"bucket": t, "g": group, "items": packed, "bytes": sent, "spans": b""})
            # Past the buckets, in a row of the group's own.
            out.append(_interval_row(group, *[np.concatenate(x) for x in zip(*settled)], bucket=targets + group))
        return pa.Table.from_pylist(out, _run_schema())

    return run


def _run_schema() -> pa.Schema:
    return pa.schema(
        [("bucket", pa.int32()), ("g", pa.int32()), ("items", pa.binary()), ("bytes", pa.binary()), ("spans", pa.binary())]
    )


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _least_doc(items: np.ndarray, fields: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """For sorted items: the smallest document of those with equal ``fields``, and where it stands."""
    new = np.ones(len(items), bool)
    new[1:] = False
    for f in fields:
        new[1:] |= items[f][1:] != items[f][:-1]
    first = np.flatnonzero(new)
    at = first[np.cumsum(new) - 1]
    return items["doc"][at], at


# --- 3: suffix sort -----------------------------------------------------------------


class Suffixes:
    """Suffixes of bytes, of which ``LENGTH`` bytes count, compared by prefix hashes."""

    def __init__(self, data: np.ndarray):
        self.data, self.hash = data, Prefix(data)
        self.head = _eights(data).byteswap()

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The length of the common extension of suffixes at ``a`` and ``b``, by binary search."""
        out = np.full(len(a), LENGTH, np.int64)
        differ = np.flatnonzero(self.hash(a, a + LENGTH) != self.hash(b, b + LENGTH))
        a, b = a[differ], b[differ]
        low, high = np.zeros(len(a), np.int64), np.full(len(a), LENGTH - 1, np.int64)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.hash(a, a + mid) == self.hash(b, b + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        out[differ] = low
        return out

    def before(self, a: np.ndarray, b: np.ndarray, equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at ``a`` is less than that at ``b``, or equal where ``equal`` allows it."""
        # Suffixes whose first eight bytes differ need no search.
        x, y = self.head[a], self.head[b]
        out = x < y
        tied = np.flatnonzero(x == y)
        a, b = a[tied], b[tied]
        length = self.common(a, b)
        step = np.minimum(length, LENGTH - 1)
        out[tied] = np.where(length == LENGTH, equal[tied], self.data[a + step] < self.data[b + step])
        return out

    def sort(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """An order of suffixes by group and, within a group, by bytes: a stable mergesort of all groups at once.

        A suffix's place in a merged run is its own place plus the number of the other run's suffixes before it,
        which a binary search finds.
        """
        order = np.argsort(group, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(group[order]) != 0)) if len(order) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(first, len(order)))
        base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        width = 1
        while len(sizes) and width < sizes.max():
            place = np.arange(len(order)) - base
            move = np.flatnonzero(size > (place // (2 * width)) * 2 * width + width)  # those with two runs to merge
            pair = base[move] + place[move] // (2 * width) * (2 * width)
            right = place[move] // width % 2 == 1
            begin = np.where(right, pair, pair + width)
            stop = np.where(right, pair + width, np.minimum(pair + 2 * width, base[move] + size[move]))
            low, high = begin.copy(), stop.copy()
            while (open_ := np.flatnonzero(low < high)).size:
                mid = (low[open_] + high[open_]) // 2
                # Equal suffixes of the left run stay before those of the right one.
                less = self.before(at[order[mid]], at[order[move[open_]]], right[open_])
                low[open_] = np.where(less, mid + 1, low[open_])
                high[open_] = np.where(less, high[open_], mid)
            own = np.arange(len(order))[move] - np.where(right, pair + width, pair)
            to = pair + own + (low - begin)
            merged = order.copy()
            merged[to] = order[move]
            order = merged
            width *= 2
        return order

    def classes(self, at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order, and a number per suffix in that order that equal suffixes of a group share; verified by bytes."""
        order = self.sort(at, group)
        a, b = at[order[:-1]], at[order[1:]]
        near = np.flatnonzero(group[order[:-1]] == group[order[1:]])
        same = np.zeros(len(a), bool)
        same[near] = self.common(a[near], b[near]) == LENGTH
        claimed = np.flatnonzero(same)
        for k in range(0, len(claimed), 1 << 16):
            some = claimed[k : k + (1 << 16)]
            step = np.arange(LENGTH)
            truly = (self.data[a[some][:, None] + step] == self.data[b[some][:, None] + step]).all(1)
            if not truly.all():  # a collision of hashes: the groups it is in are sorted by their bytes
                return self._by_bytes(at, group)
        return order, np.cumsum(np.append(True, ~same))[: len(order)] if len(order) else order

    def _by_bytes(self, at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = [(int(g), self.data[p : p + LENGTH].tobytes()) for p, g in zip(at, group)]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__))
        new = [True] + [keys[i] != keys[j] for i, j in zip(order[:-1], order[1:])]
        return order, np.cumsum(new)


def _settle(table: pa.Table) -> pa.Table:
    """The covered intervals that a bucket's runs show, by group; a group's own intervals go through."""
    if not any(table.column("items").to_pylist()):
        return table.select(["g", "spans"])
    groups = np.array(table.column("g").to_pylist(), np.int64)
    lists = [_unpacked_items(x) for x in table.column("items").to_pylist()]
    item = np.concatenate(lists)
    group = np.repeat(groups, [len(x) for x in lists])
    open_ = zstandard.ZstdDecompressor().decompress
    data = np.frombuffer(b"".join(open_(x) if x else b"" for x in table.column("bytes").to_pylist()), np.uint8)
    size = item["n"].astype(np.int64) - 1 + LENGTH
    start = np.cumsum(size) - size
    order = np.lexsort((item["doc"], item["off"], item["n"], item["mark"], item["key"]))
    item, group, size, start = item[order], group[order], size[order], start[order]

    least, at = _least_doc(item, ("key", "mark", "n", "off"))
    later = np.flatnonzero(item["doc"] > least)
    later = later[_same_bytes(data, start[later], start[at[later]], size[later])]
    covered = [(group[later], item["row"][later], item["at"][later], size[later])]

    # Runs that are no such copies, of keys that several documents and different runs have.
    rest = np.ones(len(item), bool)
    rest[later] = False
    first = np.flatnonzero(np.append(True, item["key"][1:] != item["key"][:-1]))
    sizes = np.diff(np.append(first, len(item)))
    several = np.minimum.reduceat(item["doc"], first) != np.maximum.reduceat(item["doc"], first)
    own = np.flatnonzero(rest & np.repeat(several, sizes) & (item["n"] > 0))
    n = item["n"][own].astype(np.int64)
    which = np.repeat(own, n)
    step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    window = start[which] + step
    if len(which):
        # Only windows with equal anchors at equal places can be equal; the sort tells which are.
        code = mixed(item["key"][which] + (item["off"][which].astype(np.int64) - step).astype(np.uint64))
        _, of = np.unique(code, return_inverse=True)
        low = np.full(of.max() + 1, np.iinfo(np.int64).max)
        high = np.full(of.max() + 1, np.iinfo(np.int64).min)
        np.minimum.at(low, of, item["doc"][which])
        np.maximum.at(high, of, item["doc"][which])
        some = np.flatnonzero(low[of] != high[of])
        which, step, window, of = which[some], step[some], window[some], of[some]
    if len(which):
        suffixes = Suffixes(data)
        by, number = suffixes.classes(window, of)
        doc = item["doc"][which[by]]
        low = np.full(number.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, number, doc)
        hit = by[doc > low[number]]
        src = which[hit]
        covered.append((group[src], item["row"][src], item["at"][src] + step[hit], np.full(len(src), LENGTH)))
    group, row, begin, length = (np.concatenate(x).astype(np.int64) for x in zip(*covered))
    out = [_interval_row(g, row[r], begin[r], begin[r] + length[r]) for g, r in _by(group)]
    return pa.Table.from_pylist(out, _run_schema()).select(["g", "spans"])


# --- 4: what is kept ----------------------------------------------------------------


def _kept(table: pa.Table, found: pa.Table, keep_bytes: bool) -> pa.Table:
    ids, texts = _sorted_group(table)
    spans = [np.frombuffer(x, "<i8").reshape(-1, 3) for x in found.column("spans").to_pylist()]
    spans = np.concatenate(spans) if spans else np.zeros((0, 3), np.int64)
    rows, begin, end = _spans(spans[:, 0], spans[:, 1], spans[:, 2])
    bounds = np.searchsorted(rows, np.arange(len(ids) + 1))
    data, ends = utf8(texts)
    out = []
    for k, doc in enumerate(ids.tolist()):
        text = data[ends[k] : ends[k + 1]].tobytes()
        own = [(int(begin[i]), int(end[i])) for i in range(bounds[k], bounds[k + 1])]
        rest, last = [], 0
        for b, e in own:
            rest.append(text[last:b])
            last = e
        rest = b"".join([*rest, text[last:]])
        row = {
            "id": doc,
            "n_bytes": len(text),
            "n_removed": len(text) - len(rest),
            "n_spans": len(own),
            "kept_sha256": hashlib.sha256(rest).hexdigest(),
        }
        if keep_bytes:
            row |= {"spans": [{"begin": b, "end": e} for b, e in own], "kept": rest}
        out.append(row)
    fields = [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
    fields += [("kept_sha256", pa.string())]
    if keep_bytes:
        fields += [("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
    return pa.Table.from_pylist(out, pa.schema(fields))


def remove_repeats(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_bytes: bool = False,
    group_bytes: int = GROUP_BYTES,
    bucket_rows: int = BUCKET_ROWS,
    hot_docs: int = HOT_DOCS,
) -> DataFrame:
    """(id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``), one row per document.

    With ``keep_bytes`` also the removed ``spans`` and the ``kept`` bytes, which need not be valid UTF-8.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.coalesce(text_column, F.lit("")).alias("text")
    )
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    stored_in = max(1, -(-total // (4 * group_bytes)))
    groups = 4 * stored_in
    buckets = max(1, total // 13 // bucket_rows + 1)

    named = texts.where("id is not null")
    grouped = named.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    name = f"repeats_{uuid.uuid4().hex}"
    table = grouped.repartition(stored_in, "g").write.option("compression", "zstd")
    table.bucketBy(stored_in, "g").saveAsTable(name)
    try:
        held = spark.table(name)
        anchors = held.groupBy("g").applyInArrow(
            _anchors_of_group(buckets), "bucket int, g int, anchors binary, docs binary"
        )
        shared = anchors.groupBy("bucket").applyInArrow(
            lambda rows: _shared_anchors(rows, hot_docs), "g int, bucket int, shared binary, hot binary"
        )
        shared = written(shared, "anchors")
        found = held.groupBy("g").cogroup(shared.groupBy("g")).applyInArrow(_runs_of_group(buckets, buckets), _RUN_ROW)
        spans = written(found.groupBy("bucket").applyInArrow(_settle, "g int, spans binary"), "spans")
        schema = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
        if keep_bytes:
            schema += ", spans array<struct<begin: bigint, end: bigint>>, kept binary"
        out = held.groupBy("g").cogroup(spans.groupBy("g")).applyInArrow(lambda a, b: _kept(a, b, keep_bytes), schema)
        out = written(out, "kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    none = F.lit(0).cast("bigint")
    unnamed = texts.where("id is null").select(
        "id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        none.alias("n_removed"),
        none.alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
        F.array().cast("array<struct<begin: bigint, end: bigint>>").alias("spans"),
        F.col("text").cast("binary").alias("kept"),
    )
    unnamed = unnamed.select(*out.columns)
    return out.union(unnamed).withColumnRenamed("id", id_column)
