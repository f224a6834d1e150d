"""Hard negatives against a loop over all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, tile int, slice string, id string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b", 2) for r in rows], SCHEMA).repartition(4)


def found(df, every=10, **options):
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % every == 0, **options).collect()))


def expected(rows, every=10, n_positives=5, n_negatives=10, low=30, high=90):
    usable = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for i, v, label in usable:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in usable if j != i)
        for s, j, _ in [t for t in scored if t[2] == label][:n_positives]:
            fits = [(t, k) for t, k, other in scored if other != label and low * -s <= -100 * t <= high * -s]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(fits[:n_negatives], 1)]
    return sorted(out)


def vectors(seed, n, size=6, labels=3, clusters=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, size))
    pick = random.Random(seed)
    return [
        (k, (centres[pick.randrange(clusters)] + rng.normal(scale=0.3, size=size)).round(2).tolist(), pick.randrange(labels))
        for k in range(n)
    ]


@pytest.mark.parametrize(("seed", "block", "tile"), [(1, 8, 4), (2, 32, 1000), (3, 1, 1)])
def test_equals_all_pairs(spark, monkeypatch, seed, block, tile):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "TILE_ANCHORS", tile)
    monkeypatch.setattr(negatives, "SLICE_BLOCKS", 3)
    rows = vectors(seed, 120 if block == 1 else 300)
    assert found(frame(spark, rows)) == expected(rows)


def test_other_numbers(spark):
    rows = vectors(5, 150)
    options = {"n_positives": 2, "n_negatives": 3, "low": 10, "high": 60}
    assert found(frame(spark, rows), every=7, **options) == expected(rows, 7, **options)


def test_one_label_has_nearly_all_rows_and_one_vector_many_copies(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)
    rows = [(i, v, 0 if i % 9 else 1) for i, v, _ in vectors(6, 200)]
    rows += [(i, rows[3][1], i % 2) for i in range(200, 320)]
    assert found(frame(spark, rows)) == expected(rows)


def test_nulls_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (1, [0.9, 0.1], 0), (2, [0.9, 0.1], 0), (3, [0.5, 0.5], 1), (4, [0.5, 0.5], 1),
        (5, None, 1), (6, [0.5, None], 1), (7, [nan, 0.5], 1), (8, [inf, 0.5], 1), (9, [0.5, 0.5], None),
        (10, [], 0), (20, [0.25], 1), (30, [0.0, 0.0], 1), (None, [0.5, 0.5], 1), (11, [-1.0, -1.0], 0),
    ]
    assert found(frame(spark, rows)) == expected(rows)


def test_repeated_rows_are_rows(spark):
    rows = vectors(8, 60)
    once = found(frame(spark, rows), n_positives=1, n_negatives=1)
    twice = found(frame(spark, [*rows, rows[10]]), n_positives=1, n_negatives=1)
    assert sorted(set(twice)) == once
    assert [r for r in twice if r[0] == 10] == 2 * [r for r in once if r[0] == 10]


def test_empty_tables(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(0, [1.0], 0)])) == []
    assert found(frame(spark, [(0, [1.0], 0), (1, [1.0], 0)])) == []


def test_huge_components_are_exact(spark):
    rows = [(0, [3e6, 1.0], 0), (1, [2e6, 1.0], 0), (2, [1e6, 3.0], 1), (3, [1e6, 2.0], 1), (4, [1e30, 1.0], 2)]
    got = [r for r in found(frame(spark, rows)) if r[3] != 4 and r[1] != 4]
    assert got == expected(rows[:4]) and got


def test_the_curve_visits_neighbours():
    for n, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
        keys = [k.tobytes() for k in negatives.hilbert_keys(cells, bits)]
        path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert len(set(keys)) == len(cells)
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_leave_blocks_out(spark, monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-99, 99, (5, 4)).astype(float), rng.integers(-99, 99, (40, 4)).astype(float)
    least, most = negatives.bounds(a, b.min(0)[None], b.max(0)[None])
    assert (least <= (a @ b.T)).all() and ((a @ b.T) <= most).all()
    # Clusters far apart: an anchor's windows read few blocks.
    rows = [(k, [(k % 8) + 0.01 * (k % 3), 1.0 - (k % 8)], k % 2) for k in range(800)]
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 10)
    read = []
    real = negatives.Scratch.written

    def spy(self, df, purpose):
        out = real(self, df, purpose)
        if purpose == "needed":
            read.append((out.count(), out.select("tile").distinct().count()))
        return out

    monkeypatch.setattr(negatives, "TILE_ANCHORS", 1)
    monkeypatch.setattr(negatives.Scratch, "written", spy)
    assert found(frame(spark, rows)) == expected(rows)
    pairs, tiles = read[0]
    assert pairs < 0.3 * tiles * 80
