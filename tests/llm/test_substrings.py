from __future__ import annotations

import hashlib
import random

import numpy as np

from rillflow.llm import substrings
from rillflow.llm.substrings import LENGTH, Suffixes, remove_repeats


def brute(rows):
    """Rows in order of id; what each loses to the windows of smaller ids."""
    seen, out = set(), []
    for doc in sorted({d for d, _ in rows if d is not None}):
        own = [(t or "").encode() for d, t in rows if d == doc]
        for text in own:
            covered = np.zeros(len(text) + 1, bool)
            for p in range(len(text) - LENGTH + 1):
                if text[p : p + LENGTH] in seen:
                    covered[p : p + LENGTH] = True
            spans = int((np.diff(covered.astype(int)) == 1).sum() + covered[0])
            rest = bytes(b for b, c in zip(text, covered) if not c)
            out.append((doc, len(text), len(text) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
        for text in own:
            seen.update(text[p : p + LENGTH] for p in range(len(text) - LENGTH + 1))
    return sorted(out)


def corpus(seed=4):
    rng = random.Random(seed)
    letters = "abc dé\n"

    def text(n):
        return "".join(rng.choice(letters) for _ in range(n))

    shared = [text(n) for n in (49, 50, 51, 60, 120, 400)]
    rows = []
    for k in range(140):
        parts = [text(rng.randrange(0, 90)) for _ in range(rng.randrange(1, 4))]
        parts += rng.sample(shared, rng.randrange(0, 3))
        rng.shuffle(parts)
        rows.append((k * 5 + 1, "".join(parts)))
    rows += [(2_000 + k, "x" * rng.randrange(40, 200)) for k in range(12)]  # periodic texts
    rows += [(3_000 + k, rows[7][1] + shared[5]) for k in range(6)]  # copies
    rows += [(4_000, None), (4_001, ""), (4_002, "short"), (4_003, shared[4]), (4_004, shared[4][1:] + "y")]
    rng.shuffle(rows)
    return rows


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_same_as_all_windows_compared(documents):
    rows = corpus()
    docs = documents(rows).repartition(6)
    want = brute(rows)
    assert result(remove_repeats(docs)) == want
    # Many groups and buckets, and every anchor hot.
    assert result(remove_repeats(docs, group_bytes=1_000, bucket_rows=300, hot_docs=1)) == want


def test_kept_bytes_and_spans(documents):
    shared = "a passage that is long enough to count, by more than fifty bytes"
    rows = [(1, "one " + shared), (2, shared + " two")]
    found = {r.doc_id: r for r in remove_repeats(documents(rows), keep_bytes=True).collect()}
    assert bytes(found[1].kept).decode() == "one " + shared and found[1].spans == []
    assert bytes(found[2].kept) == b" two"
    assert [(s.begin, s.end) for s in found[2].spans] == [(0, len(shared))]


def test_repeated_and_missing_ids_and_empty_tables(documents):
    long = "".join(chr(97 + i % 23) + str(i) for i in range(60))
    rows = [(5, long), (5, long), (6, long), (None, long)]
    found = remove_repeats(documents(rows)).collect()
    removed = sorted(((r.doc_id, r.n_removed) for r in found), key=str)
    assert removed == [(5, 0), (5, 0), (6, len(long)), (None, 0)]
    assert remove_repeats(documents([])).collect() == []


def test_long_texts_are_cut_with_windows_kept_whole(monkeypatch):
    import pyarrow as pa

    rng = random.Random(2)
    text = "".join(rng.choice("ab") for _ in range(3_000))
    whole = [tuple(x) for x in _windows(pa.array([text, "q" * 70]))]
    monkeypatch.setattr(substrings, "PIECE", 256)
    assert sorted(_windows(pa.array([text, "q" * 70]))) == sorted(whole)


def _windows(texts):
    for data, ends, rows, places in substrings._cut(texts):
        _, begin, n, _ = substrings.runs(data, ends)
        which = np.searchsorted(ends, begin, side="right") - 1
        for w, b, k in zip(which, begin, n):
            for step in range(k):
                at = b + step
                yield int(rows[w]), int(at - ends[w] + places[w]), data[at : at + LENGTH].tobytes()


def test_suffix_sort_orders_by_bytes():
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.integers(97, 99, 400), np.full(200, 97), rng.integers(97, 99, 300)]).astype(np.uint8)
    data = np.concatenate([data, data[:250]])
    at = rng.permutation(len(data) - LENGTH)
    group = rng.integers(0, 3, len(at))
    suffixes = Suffixes(data)
    order = suffixes.sort(at, group)
    key = [(group[i], data[at[i] : at[i] + LENGTH].tobytes()) for i in order]
    assert key == sorted(key)
    order, number = suffixes.classes(at, group)
    key = [(group[i], data[at[i] : at[i] + LENGTH].tobytes()) for i in order]
    assert [a == b for a, b in zip(key, key[1:])] == [a == b for a, b in zip(number, number[1:])]


def test_collisions_of_hashes_are_found_by_the_bytes():
    data = np.frombuffer(b"".join(bytes([65 + k]) * LENGTH for k in range(4)) * 2, np.uint8)
    at = np.arange(8) * LENGTH
    suffixes = Suffixes(data)
    suffixes.hash.sums[:] = 0  # every stretch now has the same hash
    order, number = suffixes.classes(at, np.zeros(8, np.int64))
    assert [int(data[at[i]]) for i in order] == sorted(int(data[i]) for i in at)
    assert number.tolist() == [1, 1, 2, 2, 3, 3, 4, 4]
