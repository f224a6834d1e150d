"""Language identification by rank-order profiles of character n-grams.

A language's profile is its most frequent n-grams in order, counted over a bounded sample of labelled documents. A
document's own most frequent n-grams are compared with each profile by the out-of-place distance: the sum of how far each
n-gram's rank is from its rank in the profile, the profile's length where it is missing there.

Nulls and odd rows: a text that is null or has no letter is ``und`` with score 0; rows without a language are not learned
from; equal distances go to the language that comes first by code point; repeated ids are rows like any other; without
labelled rows every document is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.common import filled, slices

UNKNOWN = "und"
#: Length of profiles, longest n-gram, and documents learned from per language.
PROFILE, LONGEST, LEARN_DOCS = 400, 3, 400

#: Stands for the edge of a word; above all code points, below 2**21.
_EDGE = 0x110000
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        # Surrogates cannot be in a text.
        table = np.zeros(_EDGE, bool)
        for cp in range(_EDGE):
            table[cp] = chr(cp).isalpha()
        _letters = table
    return _letters


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text's words as numbers, and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[points]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Words with one edge before, between and after them.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[0] = True
    word = np.where(letter, points, _EDGE).astype(np.int64)[kept]
    if word[0] != _EDGE:
        word = np.append(_EDGE, word)
    if word[-1] != _EDGE:
        word = np.append(word, _EDGE)
    edge = word == _EDGE
    found = [word[~edge]]
    code, inner = word, np.zeros(len(word), bool)
    for n in range(2, LONGEST + 1):
        if len(word) < n:
            break
        # An edge may only come first or last.
        inner = inner[:-1] | (edge[n - 2 : -1] if n > 2 else False)
        code = (code[:-1] << 21) | word[n - 1 :]
        found.append(code[~inner])
    return np.unique(np.concatenate(found), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams in order, ties by code."""
    if len(codes) > size:
        least = -np.partition(-counts, size - 1)[size - 1]
        some = counts >= least
        codes, counts = codes[some], counts[some]
    return codes[np.lexsort((codes, -counts))][:size]


def learn_profiles(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> dict[str, np.ndarray]:
    """The profile of each language. At most about ``LEARN_DOCS`` documents per language, drawn by hash, are read.

    Counts are added up by Spark; the driver gets ``PROFILE`` n-grams per language.
    """
    labelled = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    labelled = labelled.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    share = F.least(F.lit(1.0), LEARN_DOCS / F.col("docs"))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    # A row per language, as many as there are profiles in the driver; no text moves for it.
    drawn = labelled.join(F.broadcast(sizes), "lang").where(place < share).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, counts = ngrams(text)
                if len(codes):
                    langs = pa.array([lang]).take(pa.array(np.zeros(len(codes), np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [langs, pa.array(codes), pa.array(counts)], ["lang", "code", "n"]
                    )

    counted = drawn.mapInArrow(count, "lang string, code bigint, n bigint")
    counted = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    best = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    profiles: dict[str, list[int]] = {}
    for r in best.orderBy("lang", "rank").collect():
        profiles.setdefault(r.lang, []).append(r.code)
    return {lang: np.array(profiles[lang], np.int64) for lang in sorted(profiles)}


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], *keep: Column, text_column: str = "text") -> DataFrame:
    """Columns ``keep`` and (``lang_pred``, ``score``) for every row; whole texts are read.

    ``score`` is 1 minus the distance over the largest possible one.
    """
    names = list(profiles)
    # Each profile by code, and the rank of every code in it.
    by_code = [np.argsort(profiles[n], kind="stable") for n in names]
    codes = [profiles[n][o] for n, o in zip(names, by_code)]
    kept = docs.select(*keep, F.col(text_column).alias("_text"))
    columns = kept.columns[:-1]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def judge(text: str) -> tuple[str, float]:
        own = ranked(*ngrams(text), PROFILE)
        if not len(own) or not names:
            return UNKNOWN, 0.0
        ranks = np.arange(len(own))
        best = None
        for name, order, known in zip(names, by_code, codes):
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            away = np.where(known[at] == own, np.abs(order[at] - ranks), PROFILE)
            far = int(away.sum())
            if best is None or far < best[0]:
                best = far, name
        return best[1], 1.0 - best[0] / (PROFILE * len(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [judge(t) for t in filled(batch.column(len(columns))).to_pylist()]
            langs, scores = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*columns, "lang_pred", "score"],
            )

    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double")
