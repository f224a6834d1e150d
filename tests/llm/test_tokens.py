from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillflow.llm import tokens
from rillflow.llm.queries import tokenizer_file
from tests.conftest import DATA


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


@pytest.fixture(scope="module")
def encoder():
    return tokens.WordEncoder(tokenizer_file())


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("aAbB'sStTmM.,!|<>éÉİΣσK12\t\x1c\n  ß漢字́‍’-क़"), max_size=24))
def test_words_give_the_ids_of_the_text(tokenizer, encoder, text):
    for t in (text, f"{text}<|endoftext|>{text}", f"<|ENDOFTEXT|>{text}"):
        assert np.frombuffer(encoder([t])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAb's.,!<|é1\x01 "), max_size=12), max_size=12))
def test_words_that_are_forgotten_are_learned_again(tokenizer, texts):
    small = tokens.WordEncoder(tokenizer_file(), remembered=1_000)
    for _ in range(2):
        for t in texts:
            assert np.frombuffer(small([t])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_memory_is_bounded(tokenizer):
    small = tokens.WordEncoder(tokenizer_file(), remembered=500)
    rng = random.Random(1)
    for _ in range(30):
        small([" ".join(f"{rng.randrange(10**9):x}." for _ in range(200)), "x" * 500_000 + "!"])
        assert max(map(len, small.words), default=0) <= 64
        assert len(small.words) + len(small.older) <= 2 * (500 + 3 * 200)


def test_ids_of_all_latin_letters_and_of_the_table(tokenizer, encoder):
    words = [f"{a}{chr(c)}{b}" for c in range(0xAA, 0x260) for a, b in (("", ""), ("x", "y"), ("THE", "."), ("é", "ñ"))]
    texts = [t or "" for t in pq.read_table(f"{DATA}/documents.parquet").column("text").to_pylist()]
    for t in [*words, *texts]:
        assert np.frombuffer(encoder([t])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def expected(tokenizer, rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), ids))
        start += len(ids)
    return out


def test_round_trip(spark, documents, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "DOCS_PER_PART", 20)
    rng = random.Random(6)
    rows = [(k * 3, " ".join(rng.choice(["Hello", "wörld,", "it's", "42nd"]) for _ in range(rng.randrange(60)))) for k in range(90)]
    rows += [(1, None), (2, ""), (4, "long " * 30_000)]
    rng.shuffle(rows)
    folder = tokens.write_tokens(documents(rows).repartition(5), str(tmp_path / "out"), tokenizer_file(), end_id=1)
    want = expected(tokenizer, rows)
    found = [tuple(r) for r in tokens.read_tokens(spark, folder).orderBy("start").collect()]
    assert found == want
    digests = tokens.read_tokens(spark, folder, tokens.crc32_of_ids, "bigint", "crc").collect()
    assert {(r.doc_id, r.crc) for r in digests} == {(d, zlib.crc32(np.array(i, "<u4").tobytes())) for d, _, _, i in want}
    some = tokens.read_documents(spark, folder, [1, 6, 4, 999])
    assert sorted(tuple(r) for r in some.collect()) == sorted(w for w in want if w[0] in (1, 4, 6))


def test_repeated_and_null_ids_and_empty_tables(spark, documents, tokenizer, tmp_path):
    rows = [(7, "same id"), (7, "another text"), (None, "no id"), (3, "x")]
    folder = tokens.write_tokens(documents(rows), str(tmp_path / "a"), tokenizer_file(), end_id=1)
    found = tokens.read_tokens(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, 3, 7, 7]
    assert sorted(r.ids for r in found) == sorted(w[3] for w in expected(tokenizer, rows))
    folder = tokens.write_tokens(documents([]), str(tmp_path / "b"), tokenizer_file(), end_id=1)
    assert tokens.read_tokens(spark, folder).collect() == []


def test_dictionary_is_verified(spark, documents, tmp_path):
    a = tokens.write_tokens(documents([(1, "some text")]), str(tmp_path / "a"), tokenizer_file(), end_id=1)
    b = tokens.write_tokens(documents([(1, "other words " * 50)]), str(tmp_path / "b"), tokenizer_file(), end_id=1)
    spark.read.parquet(f"{b}/dictionary").write.parquet(str(tmp_path / "c/dictionary"))
    spark.read.parquet(f"{a}/blocks").write.parquet(str(tmp_path / "c/blocks"))
    spark.read.parquet(f"{a}/parts").write.parquet(str(tmp_path / "c/parts"))
    with pytest.raises(Exception, match="another dictionary"):
        tokens.read_tokens(spark, str(tmp_path / "c")).collect()


def test_ids_that_do_not_fit_raise(documents, tmp_path):
    with pytest.raises(Exception, match="does not fit"):
        tokens.write_tokens(documents([(1, "word")]), str(tmp_path / "a"), tokenizer_file(), end_id=1 << 20)
