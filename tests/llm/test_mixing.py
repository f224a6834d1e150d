from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest

from rillflow.llm import mixing
from rillflow.llm.queries import MIX, ORACLES
from tests.compare import differences
from tests.llm.conftest import words


def corpus(seed=2):
    rng = random.Random(seed)
    rows = []
    for source, n in (("b", 200), ("a", 12), ("Z", 30), (None, 25), ("é", 6), ("empty", 3), ("aa", 40)):
        for _ in range(n):
            size = 0 if source == "empty" else rng.choice([0, 1, 5, 40, 300])
            rows.append((len(rows) * 7, " ".join(words(rng, size)), None, source))
    rows += [(100_001, None, None, "a"), (100_002, " \t\n", None, "a"), (100_003, "x " * 20_000, None, "b")]
    rng.shuffle(rows)
    return rows


def repeated_shares(sizes, weights, share, epochs):
    """Targets by clamping and sharing out again until none is above its cap."""
    left, target = share * sum(sizes.values()), dict.fromkeys(sizes, 0.0)
    open_ = set(sizes)
    while open_:
        deal = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        over = {s for s in open_ if deal[s] >= epochs * sizes[s]}
        if not over:
            return target | deal
        for s in over:
            target[s] = epochs * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_same_as_sql(documents):
    rows = corpus()
    docs = documents(rows)
    db = duckdb.connect()
    db.register("documents", pa.table({n: [r[k] for r in rows] for k, n in ((0, "doc_id"), (1, "text"), (3, "source"))}))
    found = mixing.mix(docs.repartition(6), **MIX)
    assert differences(found, db, ORACLES["op6_mixing"]) == []


def test_targets_and_sums(documents):
    rows = corpus(3)
    found = [(r, s) for r in mixing.mix(documents(rows), **MIX).collect() for s in [next(x[3] for x in rows if x[0] == r.doc_id)]]
    sizes, taken, target = {}, {}, {}
    for r, s in found:
        assert 0 <= r.taken <= 2 * r.size
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: [5, 2, 1][k % 3] for k, s in enumerate(order)}
    want = repeated_shares(sizes, weights, 1.5, 2.0)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert taken[s] == round(target[s])


def test_reruns_and_other_partitions_agree(documents):
    docs = documents(corpus(4))
    first = sorted(map(tuple, mixing.mix(docs, **MIX).collect()))
    assert sorted(map(tuple, mixing.mix(docs.repartition(11), **MIX).collect())) == first
    assert sorted(map(tuple, mixing.mix(docs, **{**MIX, "seed": 3}).collect())) != first


def test_mixed_documents_hold_the_words_taken(documents):
    docs = documents(corpus(5))
    taken = {r.doc_id: r.taken for r in mixing.mix(docs, **MIX).collect()}
    mixed = mixing.mixed_documents(docs, **MIX)
    assert mixed.columns == docs.columns
    held, texts = {}, {r.doc_id: r.text for r in docs.collect()}
    for r in mixed.collect():
        held[r.doc_id] = held.get(r.doc_id, 0) + len(r.text.encode().split())
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert held == {d: n for d, n in taken.items() if n}


def test_odd_tables(documents):
    assert mixing.mix(documents([]), **MIX).collect() == []
    rows = [(1, None, None, None), (2, "", None, "a"), (2, "", None, "a")]
    found = sorted(map(tuple, mixing.mix(documents(rows), **MIX).collect()))
    assert found == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    one = mixing.mix(documents([(1, "a b c", None, "s"), (1, "a b c", None, "s")]), **MIX).collect()
    assert sum(r.taken for r in one) == 9 and {r.target for r in one} == {9.0}
    # Fewer caps than the share asks for: every source is at its cap.
    full = mixing.mix(documents([(1, "a b c", None, "s")]), weights=[1], share=3.0, epochs=2.0).collect()
    assert [(r.target, r.taken) for r in full] == [(6.0, 6)]


def test_mixed_documents_with_repeated_and_missing_ids(documents):
    rng = random.Random(6)
    rows = [(k, " ".join(words(rng, 20)), None, "ab"[k % 2]) for k in range(30)]
    rows += [(3, " ".join(words(rng, 7)), None, "a")] * 5 + [(3, " ".join(words(rng, 9)), None, "b")]
    rows += [(None, " ".join(words(rng, 11)), None, s) for s in "aab"]
    docs = documents(rows)
    held = {"a": 0, "b": 0}
    for r in mixing.mixed_documents(docs.repartition(5), **MIX).collect():
        held[r.source] += len(r.text.split())
    taken = mixing.mix(docs, **MIX).agg({"taken": "sum"}).first()[0]
    sizes = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in held}
    want = repeated_shares(sizes, {"a": 5, "b": 2}, 1.5, 2.0)
    assert held == {s: round(t) for s, t in want.items()} and sum(held.values()) == taken


def test_columns_named_like_helpers_keep_their_values(spark):
    rows = [(k, f"word{k} two", "a", 100 + k, -k, "x") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _row bigint, _SIZE bigint, _cut string")
    out = mixing.mixed_documents(docs, weights=[1], share=1.0).collect()
    assert sorted(tuple(r) for r in out) == sorted(rows)


def test_rows_without_an_id_are_spread_over_slices(spark):
    rows = [(None, f"text number {k}", "a") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix(docs, weights=[1], share=0.5).collect()
    assert sum(r.taken for r in out) == 600
    assert max(r.taken for r in out) == 3
    again = mixing.mix(docs.repartition(7), weights=[1], share=0.5).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
