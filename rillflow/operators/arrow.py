"""Sorted rows as Arrow batches, split where their key changes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

Key = tuple


def same_key(a: Key, b: Key) -> bool:
    """Equality in which nulls equal nulls and NaN equals NaN, as in ``groupBy``."""
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def key_at(batch: pa.RecordBatch, columns: Sequence[int], row: int) -> Key:
    return tuple(batch.column(c)[row].as_py() for c in columns)


def key_starts(batch: pa.RecordBatch, columns: Sequence[int]) -> np.ndarray:
    """Rows whose key differs from the row before, the first row included."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for c in columns:
        column = batch.column(c)
        if pa.types.is_struct(column.type):
            codes = [pa.DictionaryArray.dictionary_encode(x, "encode") for x in column.flatten()]
        else:
            codes = [column.dictionary_encode("encode")]
        for code in codes:
            values = code.indices.to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def groups(
    batches: Iterator[pa.RecordBatch], columns: Sequence[int]
) -> Iterator[tuple[Key, Iterator[pa.RecordBatch]]]:
    """(key, its batches) of rows sorted by key; a group's batches are read as they are asked for."""
    ahead: list[pa.RecordBatch] = []  # the part of a batch that was not handed out yet

    def following() -> pa.RecordBatch | None:
        if ahead:
            return ahead.pop()
        return next((b for b in batches if b.num_rows), None)

    def of_key(key: Key) -> Iterator[pa.RecordBatch]:
        while (batch := following()) is not None:
            if not same_key(key_at(batch, columns, 0), key):
                ahead.append(batch)
                return
            starts = key_starts(batch, columns)
            if len(starts) == 1:
                yield batch
                continue
            cut = int(starts[1])
            ahead.append(batch.slice(cut))
            yield batch.slice(0, cut)
            return

    while (batch := following()) is not None:
        key = key_at(batch, columns, 0)
        ahead.append(batch)
        group = of_key(key)
        yield key, group
        for _ in group:  # what the caller left
            pass
