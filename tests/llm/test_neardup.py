from __future__ import annotations

import collections
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillflow.llm import components as comp
from rillflow.llm import neardup
from rillflow.llm.neardup import near_duplicates, one_per_group
from rillflow.operators.checkpoints import Scratch
from tests.llm.conftest import words


def bags(text, size):
    found = (text or "").encode().lower().split()
    k = min(size, len(found))
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1)) if found else frozenset()


def brute(rows, size):
    """(set size, smallest reachable id) per id, over pairs that share a shingle."""
    sets = [(doc, bags(text, size)) for doc, text in rows]
    holders = collections.defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    parent = {}

    def root(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for k, (doc, s) in enumerate(sets):
        for other in {j for x in s for j in holders[x] if j < k}:
            t = sets[other][1]
            both = len(s & t)
            if 100 * both >= 80 * (len(s) + len(t) - both):
                a, b = root(doc), root(sets[other][0])
                parent[max(a, b)] = min(a, b)
    return {doc: (len(s), root(doc)) for doc, s in sets}


def rows_of(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def corpus(seed=1):
    rng = random.Random(seed)
    rows = []

    def add(text):
        rows.append((len(rows) * 3 + 2, text))

    for _ in range(60):
        base = words(rng, rng.choice([3, 20, 80, 300]))
        add(" ".join(base))
        for _ in range(rng.randrange(3)):
            copy = list(base)
            for _ in range(rng.randrange(1, 1 + len(base) // 12 + 1)):
                copy[rng.randrange(len(copy))] = "changed"
            add(" ".join(copy).replace(" ", "\n" if rng.random() < 0.2 else " "))
    base = words(rng, 120)  # a chain in which only neighbours are alike, and a large group of near copies
    for step in range(0, 40, 4):
        add(" ".join(words(rng, step) + base[step:]) if step else " ".join(base))
    group = words(rng, 200)
    for _ in range(90):
        copy = list(group)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(200)] = f"own{rng.randrange(10**6)}"
        add(" ".join(copy))
    shared = words(rng, 60)  # many documents that share a passage and no more
    for _ in range(70):
        add(" ".join(shared + words(rng, 60, 10**6)))
    rng.shuffle(rows)
    return rows


ODD = [
    (900_001, None),
    (900_002, ""),
    (900_003, " \n\t\x0b\x0c\r "),
    (900_004, "One"),
    (900_005, "oNE"),
    (900_006, "Ä b"),
    (900_007, "ä b"),  # only A-Z are lower-cased
    (900_008, "a b c"),  # no ASCII white space inside the first word
    (900_009, "a b c"),
]


@pytest.mark.parametrize("size", [2, 5])
def test_groups_are_those_of_all_pairs(documents, size):
    rows = corpus(size) + ODD
    found = near_duplicates(documents(rows).repartition(7), size=size)
    assert rows_of(found) == brute(rows, size)


def test_kept_and_columns(documents):
    rows = corpus(9)[:80] + ODD + [(900_010, " ".join(["long"] * 200_000))]
    docs = documents(rows)
    found = near_duplicates(docs, size=5)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = {d for d, (_, c) in brute(rows, 5).items() if d == c}
    assert {r.doc_id for r in found.where("kept").collect()} == want
    kept = one_per_group(docs, size=5)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want


def test_repeated_ids_nulls_and_empty_tables(documents):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, text), (2, "quite another text than that"), (3, "quite another text than that"), (None, text)]
    found = sorted((tuple(r) for r in near_duplicates(documents(rows), size=5).collect()), key=str)
    assert [r for r in found if r[0] == 3] == [(3, 1, 1, False)]
    assert [r[2] for r in found if r[0] == 2] == [1, 1]
    assert [r for r in found if r[0] == 1] == [(1, 26, 1, True)] * 2
    assert [r[3] for r in found if r[0] is None] == [False]
    assert near_duplicates(documents([]), size=5).collect() == []


def _shared(rows):
    """Whether the other document of the pair is in the same node."""
    places = list(zip(rows["id"].to_pylist(), rows["node"].to_pylist()))
    held = set(places)
    return [(doc ^ 1, node) in held for doc, node in places]


def test_pairs_share_a_node_at_the_deepest_level():
    """Pairs at similarity 0.8 in nodes that never become small."""
    rng, pairs = np.random.default_rng(80), 8_000
    met = 0
    for begin in range(0, pairs, 4_000):
        one = rng.integers(0, 2**32, (4_000, neardup.TOKENS), dtype=np.uint32)
        two = np.where(rng.random(one.shape) < 0.8, one, rng.integers(0, 2**32, one.shape, dtype=np.uint32))
        tokens = [t.tobytes() for pair in zip(one, two) for t in pair]
        fixed = [pa.array(range(8_000), pa.int64())] * len(neardup._DOC)
        batches = [pa.RecordBatch.from_arrays([*fixed, pa.array(tokens, pa.binary())], [*neardup._DOC, "tokens"])]
        rows = pa.Table.from_batches(neardup._roots(iter(batches)))
        for _ in range(neardup.DEPTH - 1 + neardup.FURTHER):
            held = rows.filter(pa.array(_shared(rows))).combine_chunks().to_batches()
            rows = pa.Table.from_batches(neardup._branches(iter(held)))
        met += len(np.unique(rows.filter(pa.array(_shared(rows)))["id"].to_numpy() // 2))
    assert met >= pairs - 1


def test_crowd_of_one_template(documents, monkeypatch):
    """Documents of one template, too unlike to be linked, stay together below the second level; their near copies are found."""
    rng, rows = random.Random(4), []
    template = words(rng, 180)
    for k in range(260):
        own = words(rng, 30, 10**6)
        rows.append((len(rows), " ".join(template + own)))
        if k % 3 == 0:
            rows.append((len(rows), " ".join(template + own + words(rng, 48, 10**6))))
    deep = []
    monkeypatch.setattr(neardup, "_next", lambda large, f=neardup._next: deep.append(1) or f(large))
    rng.shuffle(rows)
    found = rows_of(near_duplicates(documents(rows), size=2))
    assert len(deep) > 2 and found == brute(rows, 2)
    assert len({c for _, c in found.values()}) == 260


def test_one_row_of_a_repeated_id_stays(documents):
    text, other = " ".join(f"t{i}" for i in range(30)), " ".join(f"o{i}" for i in range(30))
    rows = [(1, text), (1, text), (1, text), (2, text), (3, None), (3, other), (4, ""), (4, None), (None, text), (None, text), (5, "a b")]
    kept = one_per_group(documents(rows).repartition(4), size=5)
    assert sorted(((r.doc_id, r.text) for r in kept.collect() if r.doc_id != 4), key=str) == sorted(
        [(1, text), (3, other), (5, "a b"), (None, text), (None, text)], key=str
    )
    assert kept.where("doc_id = 4").count() == 1


def test_bitmaps_differ_in_no_more_than_the_sets(spark):
    """Pairs at the least similarity pass the bitmaps, pairs at 0.6 do not."""
    rng, rows = np.random.default_rng(5), []
    for k in range(400):
        n, similar = int(rng.choice([9, 90, 900])), k % 2 == 0
        apart = n // 9 if similar else n // 4  # on either side: similarity 0.8 and 0.6
        one, two, both = np.split(rng.integers(0, 2**64, n + apart, dtype=np.uint64), [apart, 2 * apart])
        a, b = (neardup._bitmap(np.concatenate([both, x])) for x in (one, two))
        assert sum(((x ^ y) % 2**64).bit_count() for x, y in zip(a, b)) <= 2 * apart
        rows.append((n, similar, *a, *b))
    names = [f"{s}_{f}" for s in "ab" for f in neardup._BITMAP]
    table = spark.createDataFrame(rows, ["size", "similar", *names])
    sides = [F.struct(F.col("size").alias("n"), *[F.col(f"{s}_{f}").alias(f) for f in neardup._BITMAP]).alias(s) for s in "ab"]
    passed = table.select("size", "similar", *sides).withColumn("close", neardup._close("a", "b", 80))
    assert passed.where("similar and not close").count() == 0
    assert passed.where("size >= 90 and not similar and close").count() == 0


def test_crowd_around_one_component_is_compared_at_once(spark):
    """Branching on would take the large component along; nodes without one branch on."""
    rows = [(1, k, 0 if k < 100 else k) for k in range(160)] + [(2, k, k) for k in range(160)]
    large = spark.createDataFrame(rows, "node bigint, id bigint, component bigint")
    with Scratch(spark) as scratch:
        few, many = neardup._apart(large, False, scratch)
        assert [r.node for r in few.select("node").distinct().collect()] == [1] and few.count() == 160
        assert [r.node for r in many.select("node").distinct().collect()] == [2] and many.count() == 160


@pytest.mark.parametrize("few", [0, comp.FEW_LINKS])
def test_components_in_rounds_and_in_one_task(spark, monkeypatch, few):
    rng = random.Random(few)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    least = {k: k for pair in links for k in pair}
    for _ in least:
        for u, v in links:
            least[u] = least[v] = min(least[u], least[v])
    monkeypatch.setattr(comp, "FEW_LINKS", few)
    found = comp.components(spark.createDataFrame(links, "u bigint, v bigint"))
    ends = {k for u, v in links if u != v for k in (u, v)}
    assert {tuple(r) for r in found.collect()} == {(k, least[k]) for k in ends}
    assert comp.components(spark.createDataFrame([(7, 7)], "u bigint, v bigint")).count() == 0


def test_few_links_take_no_rounds(spark):
    """A chain takes several rounds of joins, each of them some jobs of as many tasks as there are shuffle partitions."""
    context = spark.sparkContext
    context.setJobGroup("few links", "")
    try:
        found = comp.components(spark.createDataFrame([(k, k + 1) for k in range(100)], "u bigint, v bigint"))
        assert {r.component for r in found.collect()} == {0}
        assert len(context.statusTracker().getJobIdsForGroup("few links")) <= 8
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_scratch_of_a_level_goes_with_it(documents, monkeypatch):
    """At each write, the folders of one level at most are there; before, those of all levels stayed up to the end."""
    most, real = collections.Counter(), Scratch.written
    held = []

    def spy(self, df, purpose):
        out = real(self, df, purpose)
        held.append((purpose, self.paths[-1]))
        there = collections.Counter(p for p, path in held if os.path.isdir(path.removeprefix("file:")))
        for p, n in there.items():
            most[p] = max(most[p], n)
        return out

    monkeypatch.setattr(Scratch, "written", spy)
    monkeypatch.setattr(neardup, "FURTHER", 0)
    rng = random.Random(4)
    template = words(rng, 180)
    rows = [(k, " ".join(template + words(rng, 30, 10**6))) for k in range(60)]
    assert rows_of(near_duplicates(documents(rows), size=2)) == brute(rows, 2)
    assert sum(p == "nodes" for p, _ in held) > 2
    assert most["nodes"] == most["members"] == most["candidate-texts"] == 1
    assert max(most["sized"], most["parts"], most["groups"]) <= 2
    assert not any(os.path.isdir(path.removeprefix("file:")) for _, path in held)
