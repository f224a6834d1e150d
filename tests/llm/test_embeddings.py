from __future__ import annotations

import math
import random

import numpy as np
import pytest

from rillflow.llm.embeddings import cover_tree, link_vectors, linked, unit

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, cell int"


def brute(rows, threshold=0.98):
    """Links and smallest reachable id per row, by comparing all pairs."""
    usable = []
    for vec, values, label in rows:
        bad = vec is None or label is None or not values or any(v is None or not math.isfinite(v) for v in values)
        if not bad and any(values):
            usable.append((vec, np.array(values, np.float32).astype(float), label))
    links = {}
    for i, (a, x, la) in enumerate(usable):
        for b, y, lb in usable:
            if a != b and la == lb and len(x) == len(y):
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                    links.setdefault(a, []).append(b)
    out = {}
    for vec, _, _ in rows:
        seen, todo = {vec}, [vec]
        while todo:
            for other in links.get(todo.pop(), []):
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        component = min(seen) if vec is not None else None
        out[vec] = (len(links.get(vec, [])), component, vec is not None and component == vec)
    return out


def rows_of(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("spread", [0.0, 0.01, 0.03, 0.1, 0.4])
def test_traversal_finds_exactly_the_close_pairs(spread):
    rng = np.random.default_rng(int(spread * 100))
    base = rng.normal(size=(15, 12))
    a = unit(base[rng.integers(0, 15, 150)] + rng.normal(size=(150, 12)) * spread)
    b = unit(base[rng.integers(0, 15, 90)] + rng.normal(size=(90, 12)) * 0.02)
    ta, tb = cover_tree(a, 0.05), cover_tree(b, 0.05)
    assert (linked(a, ta, b, tb, 0.98) == (a @ b.T >= 0.98)).all()
    one = cover_tree(a[:1], 0.05)
    assert (linked(a[:1], one, b, tb, 0.98) == (a[:1] @ b.T >= 0.98)).all()


def test_levels_halve_cover_and_nest():
    points = unit(np.random.default_rng(1).normal(size=(200, 6)))
    levels = cover_tree(points, 0.05)
    gaps = np.sqrt(np.maximum(0, 2 - 2 * points @ points.T))
    radius = levels[0][2][0]
    for (before, _, _), (centres, owner, radii) in zip(levels, levels[1:-1]):
        radius /= 2
        assert set(before) <= set(centres)
        assert (gaps[np.arange(200), centres[owner]] <= radii[owner] + 1e-9).all()
        assert radii.max() <= radius + 1e-9


def test_links_are_those_of_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for k in range(260):
        centre = rng.randrange(6)
        values = [math.cos(centre * 7 + i) + rng.gauss(0, 0.08) for i in range(8)]
        rows.append((k, values, rng.choice([0, 0, 0, 1, None])))
    rows += [(1000 + k, rows[5][1], rows[5][2] or 0) for k in range(40)]  # exact copies
    rows += [(2000, None, 1), (2001, [0.0] * 8, 1), (2002, [float("nan")] + [1.0] * 7, 1), (2003, [None] + [1.0] * 7, 1)]
    rows += [(2004, [float("inf")] * 8, 1), (2005, [], 1), (2006, rows[5][1][:4], 0), (2007, [3e30] * 8, 7), (2008, [1e-30] * 8, 7)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).repartition(5)
    for block_rows in (16, 512):
        assert rows_of(link_vectors(df, block_rows=block_rows)) == brute(rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert link_vectors(empty).collect() == []
    rows = [(1, [1.0, 0.0], 0, "", 0), (1, [1.0, 0.0], 0, "", 0), (2, [1.0, 0.01], 0, "", 0), (None, [1.0, 0.0], 0, "", 0)]
    found = [tuple(r) for r in link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()]
    # Rows of one id do not link with each other; their links to others add up.
    assert sorted(found, key=str) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, False)]
