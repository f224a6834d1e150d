from __future__ import annotations

import collections
import pickle
import random

import numpy as np
import pytest

from rillflow.llm import decontaminate as dc
from tests.llm.conftest import words


def bag(found, size=5):
    k = min(size, len(found))
    return collections.Counter(tuple(found[i : i + k]) for i in range(len(found) - k + 1)) if found else collections.Counter()


def brute(text, items):
    """The best similarity of each item over all windows of its length, where it reaches 0.8."""
    own, out = (text or "").encode().lower().split(), {}
    for item, other in items:
        other = (other or "").encode().lower().split()
        length, want = min(len(own), len(other)), bag(other)
        for k in range(len(own) - length + 1 if length else 0):
            have = bag(own[k : k + length])
            least, most = sum((have & want).values()), sum((have | want).values())
            if 100 * least >= 80 * most:
                out[item] = max(out.get(item, 0), least / most)
    return out


def tables(seed=1):
    rng = random.Random(seed)
    items = [(k, " ".join(words(rng, rng.choice([14, 14, 30, 59]), 300))) for k in range(25)]
    items += [(100, "two words"), (101, "One"), (102, ""), (103, None), (104, "a a a a a a a a a a a a"), (5, items[6][1])]
    docs = []
    for _ in range(120):
        body = words(rng, rng.choice([3, 20, 200]), 300)
        if rng.random() < 0.6:
            part = items[rng.randrange(25)][1].split()
            for _ in range(rng.randrange(0, 3)):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = part[rng.randrange(2) :]
        docs.append((len(docs), " ".join(body).upper() if rng.random() < 0.3 else "\n".join(body)))
    docs += [(500, None), (501, ""), (502, "two  WORDS"), (503, "one"), (504, "a " * 30), (505, items[0][1] * 1), (506, "b " * 100_000)]
    docs.append((507, " ".join(items[2][1].split()[:-1])))  # shorter than the item
    return docs, items


@pytest.fixture
def items_table(spark):
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "item_id bigint, text string, doc_id string")


def test_same_as_all_windows(documents, items_table):
    docs, items = tables()
    unique = [i for i in items if i[0] != 5 or i[1] == items[6][1]]
    want = {d: brute(t, unique) for d, t in docs if d != 506}
    found = collections.defaultdict(dict)
    for r in dc.find_items(documents(docs).repartition(5), items_table(unique)).collect():
        found[r.doc_id][r.item_id] = r.similarity
    assert sum(map(len, want.values())) > 40
    for d, hits in want.items():
        assert found[d] == pytest.approx(hits), d
    judged = {r.doc_id: r for r in dc.judge(documents(docs), items_table(unique)).collect()}
    assert len(judged) == len(docs)
    for d, hits in want.items():
        r = judged[d]
        assert (r.n_items, r.contaminated, r.kept) == (len(hits), bool(hits), not hits)
        if hits:
            assert (r.best_item, r.best_similarity) == min(hits.items(), key=lambda h: (-h[1], h[0]))
    table = documents(docs)
    clean = dc.decontaminate(table, items_table(unique))
    assert clean.columns == table.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, h in want.items() if not h} | {506}


def test_slices_of_items_give_the_same(documents, items_table, monkeypatch):
    docs, items = tables(2)
    whole = sorted(map(str, dc.judge(documents(docs), items_table(items)).collect()))
    found = sorted(map(str, dc.find_items(documents(docs), items_table(items)).collect()))
    clean = sorted(map(str, dc.decontaminate(documents(docs), items_table(items)).collect()))
    monkeypatch.setattr(dc, "SLICE_BYTES", 1_500)
    assert sorted(map(str, dc.judge(documents(docs), items_table(items)).collect())) == whole
    assert sorted(map(str, dc.find_items(documents(docs), items_table(items)).collect())) == found
    assert sorted(map(str, dc.decontaminate(documents(docs), items_table(items)).collect())) == clean


def test_repeated_rows_stay_apart_at_any_slice_size(documents, items_table):
    text = "some text of seven words is here"
    docs = [(1, text), (1, text), (1, "some other text without it"), (None, text), (None, text), (2, None)]
    items = items_table([(7, text), (8, "nothing of the kind anywhere at all"), (None, text)])
    for size in (1 << 20, 40):
        rows = dc.judge(documents(docs), items, slice_bytes=size).collect()
        assert sorted((str(r.doc_id), r.n_items, str(r.best_item)) for r in rows) == [
            ("1", 0, "None"), ("1", 2, "7"), ("1", 2, "7"), ("2", 0, "None"), ("None", 2, "7"), ("None", 2, "7"),
        ]
        clean = dc.decontaminate(documents(docs), items, slice_bytes=size).collect()
        assert sorted(str(r.doc_id) for r in clean) == ["1", "2"]


def test_lists_of_an_index_grow_with_the_items_only():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 20_000, dtype=np.uint64)
    index = dc._Index(prints)
    assert len(pickle.dumps(index)) < 100 * len(prints)
    probes = prints[:50] ^ np.uint64(0b1011)
    window, item = index.near(probes)
    assert set(range(50)) <= set(item[window == item].tolist())
    # Of unrelated pairs, one in seven shares a list and one in a thousand is within the radius.
    assert len(window) < 0.002 * len(probes) * len(prints)


def test_index_finds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 2**63, 50, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    probes = []
    for p in prints:
        for flips in (0, 5, dc.RADIUS, dc.RADIUS + 1):
            bits = rng.choice(64, flips, replace=False).astype(np.uint64)
            probes.append(p ^ np.bitwise_xor.reduce(np.uint64(1) << bits, initial=np.uint64(0)))
    probes = np.array(probes, np.uint64)
    got = set(zip(*map(np.ndarray.tolist, dc._Index(prints).near(probes))))
    away = np.bitwise_count(probes[:, None] ^ prints[None, :])
    assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(away <= dc.RADIUS))))


def test_odd_tables(documents, items_table):
    docs = [(1, "some text of six words here"), (1, "some text of six words here"), (None, "some text of six words here"), (2, None)]
    none = dc.judge(documents(docs), items_table([]))
    assert [r.contaminated for r in none.collect()] == [False] * 4
    found = dc.judge(documents(docs), items_table([(None, docs[0][1])])).collect()
    assert sorted((str(r.doc_id), r.contaminated, r.best_item) for r in found) == [
        ("1", True, None), ("1", True, None), ("2", False, None), ("None", True, None)
    ]
    assert dc.judge(documents([]), items_table([(1, "x")])).collect() == []
