"""Packing: ids as the tokenizers library gives them, every id in one place, little padding."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillflow.llm import packing
from rillflow.llm.queries import byte_vocabulary
from tests.conftest import DATA


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_vocabulary()[0])


@pytest.fixture(scope="module")
def encoder():
    return packing.ByteEncoder(*byte_vocabulary())


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("aAb'sStTreLl.,!|<>éÉİΣσßŉǅ½²ª漢字ÿ\x00\x1c\x85\xa0\xad\t\n\r   ‍’-क़019"), max_size=24))
def test_ids_are_those_of_the_library(tokenizer, encoder, text):
    for t in (text, f"{text}<|endoftext|>{text}"):
        assert encoder(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(tokenizer, encoder, text):
    assert encoder(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_all_characters_encoded_fast(tokenizer, encoder):
    for c in map(chr, [9, 10, 13, *range(32, 127), *range(0xA1, 0x250)]):
        for t in (c, f"a{c}b", f"a {c} b", f" {c}{c}", f"1{c}2", f"'{c}s"):
            assert encoder(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_ids_of_long_texts_and_of_the_table(tokenizer, encoder, monkeypatch):
    texts = [t or "" for t in pq.read_table(f"{DATA}/documents.parquet").column("text").to_pylist()]
    monkeypatch.setattr(packing, "LONG", 300)
    for t in texts:
        assert encoder(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def check_patterns(histogram, size):
    found = packing.patterns(histogram, size)
    used = Counter()
    for p in found:
        assert p.count > 0 and sum(p.lengths) <= size
        for length in p.lengths:
            used[length] += p.count
    assert used == Counter({k: n for k, n in histogram.items() if n})
    assert len(found) <= 3 * len(histogram)
    return found


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 10**12), max_size=32))
def test_patterns_hold_every_piece(histogram):
    check_patterns(histogram, 32)


def test_patterns_take_the_pack_with_most_space():
    assert packing.patterns({6: 1, 5: 1, 3: 2}, 10) == [
        packing.Pattern(1, (6, 3)), packing.Pattern(1, (5, 3)),
    ]
    assert packing.patterns({10: 7}, 10) == [packing.Pattern(7, (10,))]
    assert packing.patterns({}, 10) == []
    assert packing.patterns({3: 8}, 10) == [packing.Pattern(2, (3, 3, 3)), packing.Pattern(1, (3, 3))]


def test_numbers_of_pieces_do_not_matter_for_the_work():
    rng = random.Random(3)
    found = check_patterns({k: rng.randrange(1, 10**10) for k in range(1, 1025)}, 1024)
    total = sum(p.count * sum(p.lengths) for p in found)
    assert total > 0.99 * 1024 * sum(p.count for p in found)


def pieces_of(tokenizer, rows, size):
    out = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), size):
            part = np.array(ids[start : start + size], "<u4")
            out.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
    return Counter(out)


def check(packed, tokenizer, rows, size):
    found = packed.collect()
    assert Counter((r.doc_id, r.start, r.length, r.crc, r.doc_tokens) for r in found) == pieces_of(tokenizer, rows, size)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= size
    return by_sequence


def packed(df, folder, size):
    return packing.pack(df, *byte_vocabulary(), size=size, folder=folder, columns={"crc": F.crc32("ids")})


def test_every_id_has_one_place(spark, documents, tokenizer, tmp_path):
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choice(["it's", "wörd", "a", "42nd,", "漢字"]) for _ in range(rng.randrange(90)))) for k in range(250)]
    rows += [(k, "the very same text") for k in range(300, 600)]
    rows += [(700, "long " * 4_000), (701, None), (702, ""), (None, "no id"), (None, "no id"), (5, "twice"), (5, "twice")]
    rng.shuffle(rows)
    out = packed(documents(rows).repartition(6), str(tmp_path / "p"), 64)
    by_sequence = check(out, tokenizer, rows, 64)
    used = sum(n for spans in by_sequence.values() for _, n in spans)
    assert used > 0.97 * 64 * len(by_sequence)
    whole = packing.sequences(spark, str(tmp_path / "p"), out, pad_id=9, size=64).collect()
    assert {r.sequence_id for r in whole} == set(by_sequence)
    for r in whole:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 64)
        assert (ids[r.n_tokens :] == 9).all()
        end = 0
        for doc, length in zip(r.doc_ids, r.lengths):
            end += length
            assert length == 64 or ids[end - 1] == 0  # the rest of a document ends with its end id


def test_reruns_agree(documents, tmp_path):
    rows = [(k, "w " * (k % 37)) for k in range(200)]
    a = packed(documents(rows).repartition(3), str(tmp_path / "a"), 32).drop("row").collect()
    b = packed(documents(rows[::-1]).repartition(7), str(tmp_path / "b"), 32).drop("row").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_empty_table(documents, tokenizer, tmp_path):
    assert check(packed(documents([]), str(tmp_path / "p"), 64), tokenizer, [], 64) == {}
