"""The prefix trie against a walk over all conversations."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rillflow.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, digest string, place int, depth int, p1 string"


def expected(rows):
    """Nodes by walking every conversation, as the contract of the query says."""
    own = {}

    def digest(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()

    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [(r[3], r[4]) for r in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        full[c] = tuple(donor[:h] + turns[h:])
    members = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out, sums = [], {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in children.get(node, [])]
        leaves = sum(b[0] for b in below) or 1
        saved = sum(b[1] for b in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        sums[node] = leaves, saved
        ends = sorted(c for c in members[node] if full[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(members[node]), len(node), parent, len(members[node]), len(below), leaves, saved,
             hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
        )
    return sorted(out, key=str)


def conversations_of(spark, rows):
    full = [(*r, "x", 1, 2, "y") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(4)


def found(df):
    donor = F.col("conv_id") - F.col("conv_id") % 100
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return sorted(map(tuple, conversations.trie(df, donor, taken).collect()), key=str)


def random_rows(seed, n=140):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 700), n):
        for turn in range(rng.choice([1, 2, 3, 6, 9])):
            text = rng.choice(["a", "bb", "é漢"]) if rng.random() < 0.8 else f"own {c} {turn}"
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn > 1 else "user", text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_walk(spark, seed):
    rows = random_rows(seed)
    assert found(conversations_of(spark, rows)) == expected(rows)


def test_hot_conversation_and_copies(spark, monkeypatch):
    """One conversation has a third of all turns, another many copies; parts are small."""
    monkeypatch.setattr(conversations, "PACKED", 3)
    rows = [(7, t, "user", f"t{t % 5}") for t in range(400)] + [(8, t, "user", f"t{t % 5}") for t in range(390)]
    rows += [(c, t, "user", f"same {t}") for c in range(300, 380) for t in range(7)]
    rows += [(200, t, "user", f"same {t}") for t in range(6)]
    assert found(conversations_of(spark, rows)) == expected(rows)


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    """With a handful of cells nearly every prefix may be shared; the groups settle it."""
    monkeypatch.setattr(conversations, "CELLS_PER_PREFIX", 0)
    real = conversations._cells
    monkeypatch.setattr(conversations, "_cells", lambda digests, cells: real(digests, cells) % 61)
    rows = random_rows(3, 90)
    assert found(conversations_of(spark, rows)) == expected(rows)


def test_nulls_ties_repeated_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (100, None, "user", "null turn first"), (100, 1, None, None), (100, 1, None, None),
        (100, 1, "user", "tie"), (101, 2, "user", ""), (101, None, "user", "null turn first"), (102, 5, "u", "x" * 100_000),
        (103, 1, "user", None), (55, 1, "user", "no donor"), (55, 1, "user", "no donor"), (-3, 1, "user", "below zero"),
    ]
    assert found(conversations_of(spark, rows)) == expected(rows)


def test_empty_tables(spark):
    assert found(conversations_of(spark, [])) == []
    assert found(conversations_of(spark, [(None, 1, "user", "x")])) == []


def test_turnless_conversations(spark):
    """Conversations whose only turns are replaced by those of an absent donor."""
    rows = [(c, 0, "user", "x") for c in range(1, 60)]
    want = expected(rows)
    assert any(r[1] == 0 and r[-1] != hashlib.sha256().hexdigest() for r in want)
    assert found(conversations_of(spark, rows)) == want


def test_singleton_tails_are_not_shuffled(spark):
    """The sketch leaves only shared prefixes, and hardly others, to the groups."""
    rows = [(c, t, "user", f"own {c} {t}") for c in range(400) for t in range(6)]
    turns = spark.createDataFrame(
        [(c, t + 1, f"{c} {t}".encode(), 1, t == 5) for c, t, *_ in rows],
        "conv_id bigint, depth bigint, digest binary, chars bigint, last boolean",
    )
    out = conversations.screened(conversations.prefixes(turns))
    assert out.where("not alone and not before").count() <= 20


