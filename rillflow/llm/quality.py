"""Quality classifier: supervised subword embeddings.

A document is the average of the learned vectors of its features, hashed into ``BUCKETS`` rows: its words, the byte
3- to 4-grams within its words (with the white space around them) and a mark for every word that repeats the one before it.
A softmax over the classes follows. Vectors and output weights are learned together by stochastic gradient descent in
numpy over a bounded sample of labelled documents.

As the output is linear in the average, scoring adds up one number per feature, for all documents of a batch at once.

Nulls and odd rows: a null, empty or blank text has no features and gets the score of the output's bias; a document whose
label is null is not learned from; labels that differ for one id are all used; repeated ids are rows like any other; without
labelled rows of both classes every score is the labelled share of class 1, or 0.5 without any.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import labelled_sample, mixed, pieces, utf8

BUCKETS, DIMENSIONS = 1 << 17, 8
SHORTEST, LONGEST = 3, 4
#: Documents learned from per class, drawn by hash, and how much of each is read for learning.
LEARN_DOCS, LEARN_CHARS = 2_500, 6_000
EPOCHS, RATE = 6, 0.4
#: Empty features that every average takes in, so that a few chance features of a short text do not decide.
EMPTY_FEATURES = 60

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, size: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.ones(size, np.uint64)
    done = 1
    while done < size:
        step = np.uint64(pow(base, done, 1 << 64))
        out[done : 2 * done] = out[: min(done, size - done)] * step
        done *= 2
    return out


def features(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of concatenated texts, kind by kind: (bucket, number of the text), texts rising.

    ``data`` holds the texts' bytes, ``ends`` their bounds.
    """
    doc = np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends))
    space = _SPACE[data]
    clean = np.where(space, np.uint8(0x20), data)
    mask = np.uint64(BUCKETS - 1)

    # Words: where they start and end, and a polynomial hash of each from sums over the bytes before.
    first = ~space
    first[1:] &= space[:-1] | (doc[1:] != doc[:-1])
    last = ~space
    last[:-1] &= space[1:] | (doc[1:] != doc[:-1])
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    if len(starts):
        up = _powers(int(_BASE), len(data))
        down = _powers(pow(int(_BASE), -1, 1 << 64), len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((clean.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        words = mixed((sums[stops] - sums[starts]) * down[starts])
        of = doc[starts]
        yield (words & mask).astype(np.int64), of
        again = np.flatnonzero((words[1:] == words[:-1]) & (of[1:] == of[:-1])) + 1
        yield np.full(len(again), BUCKETS, np.int64), of[again]

    # Byte n-grams of one text with white space at their ends only.
    code = clean.astype(np.uint64)
    inner = np.zeros(len(data), bool)
    for n in range(2, LONGEST + 1):
        if len(data) < n:
            break
        size = len(data) - n + 1
        code = (code[:size] << np.uint64(8)) | clean[n - 1 :]
        inner = inner[:size] | space[n - 2 : n - 2 + size] if n > 2 else inner[:size]
        if n >= SHORTEST:
            fits = np.flatnonzero(~inner & (doc[:size] == doc[n - 1 :]))
            yield (mixed(code[fits] + np.uint64(n << 56)) & mask).astype(np.int64), doc[fits]


@dataclass
class Model:
    """One number per feature, the last one for a repeated word, and the bias."""

    logits: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total, count = np.zeros(len(ends) - 1), np.zeros(len(ends) - 1)
        for buckets, of in features(data, ends):
            total += np.bincount(of, self.logits[buckets], len(total))
            count += np.bincount(of, minlength=len(total))
        return 1 / (1 + np.exp(-(total / (count + EMPTY_FEATURES) + self.bias)))


def train(texts: list[str], labels: list[int], seed: int = 5) -> Model:
    """Gradient descent over single documents, in a seeded order, with a falling rate."""
    y = np.array(labels, np.float64)
    flat = np.zeros(BUCKETS + 1, np.float32)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return Model(flat, float(np.log(share / (1 - share))))
    # All documents' features one after another, which is returned to the system when done.
    buckets, weights, bounds = array("i"), array("f"), [0]
    for text in texts:
        data, ends = utf8(pa.array([text]))
        found = [b for b, _ in features(data, ends)]
        ids, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
        buckets.frombytes(ids.astype(np.int32).tobytes())
        weights.frombytes((n / (n.sum() + EMPTY_FEATURES)).astype(np.float32).tobytes())
        bounds.append(len(buckets))
    buckets, weights = np.frombuffer(buckets, np.int32), np.frombuffer(weights, np.float32)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, at = EPOCHS * len(texts), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(texts)):
            ids, share = buckets[bounds[k] : bounds[k + 1]], weights[bounds[k] : bounds[k + 1]]
            mean = share @ vectors[ids]
            raw = mean @ output + bias
            odds = np.exp(raw - raw.max())
            wrong = odds / odds.sum()
            wrong[int(y[k])] -= 1
            rate = np.float32(RATE * (1 - at / steps))
            back = output @ wrong
            output -= rate * np.outer(mean, wrong).astype(np.float32)
            bias -= rate * np.float32(0.1) * wrong.astype(np.float32)
            # Each feature's share of the step, not less than its share of an average document.
            vectors[ids] -= rate * np.outer(np.minimum(share * len(ids), 8.0), back).astype(np.float32)
            at += 1
    return Model((vectors @ (output[:, 1] - output[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def sample(docs: DataFrame, labels: DataFrame, label: str, *, id_column: str = "doc_id") -> list[tuple[str, int]]:
    """Labelled texts to learn from."""
    return labelled_sample(docs, labels, label, LEARN_DOCS, LEARN_CHARS, id_column=id_column)


def score(docs: DataFrame, model: Model, *keep: Column | str, text_column: str = "text") -> DataFrame:
    """Columns ``keep`` and ``score``, the probability of class 1, of every whole text."""
    kept = docs.select(*keep, F.col(text_column).alias("_text"))
    columns = kept.columns[:-1]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in pieces(batch, "_text", 1 << 20):
                found = model.scores(*utf8(rows.column(len(columns))))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(found)], [*columns, "score"])

    return kept.mapInArrow(run, f"{fields}, score double")


def keep_good(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The documents (all their columns) that score ``least`` or more."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in pieces(batch, "text", 1 << 20):
                yield rows.filter(pa.array(model.scores(*utf8(rows.column(at))) >= least))

    return docs.mapInArrow(run, schema)
