"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

Text is lower-cased, look-alike letters and digits or signs in place of letters are folded, and everything that is not a
letter becomes a space. The lexicon holds word starts, whole words of up to three letters, and pieces of scripts that do
not put spaces between words. Terms, their weights and the phrases in which a term does not count come from all labelled
documents, counted in tasks over whole texts; a term is taken by a significance test at a bounded share of false ones.
The two numbers that turn weight per word into a score are fitted to the loads of a bounded sample of documents.

Nulls and odd rows: a null or empty text has no match, as has a text of digits alone; a null label is not learned from;
repeated ids are rows like any other; without labels of both kinds the lexicon is empty and every score is 0.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import filled, slices, written

#: A term's shortest and longest start of a word.
SHORTEST, LONGEST = 4, 12
#: The fewest toxic documents a term must occur in, whatever their number.
FEWEST = 5
#: The share of terms that may be there by chance.
FALSE_SHARE = 0.05
#: The longest piece of a script without spaces.
PIECE = 4
#: Documents per class whose loads the score is fitted to, drawn by hash.
LEARN_DOCS = 1_500
#: Counts that a task holds before it hands them on.
MOST_COUNTS = 400_000
#: Bits of the table that tells which ids may be labelled.
CELLS = 1 << 25
#: A term is at least so many times as frequent among toxic documents as among others.
ODDS = 20.0
#: Terms (the most significant) and exception phrases (the most frequent) kept at most.
MOST_TERMS, MOST_PHRASES = 2_000, 500
#: Terms that the choice is made from at most, the most significant.
MOST_CANDIDATES = 40_000
#: Words added to a text's length, so that one match in a short text does not weigh without bound.
EXTRA_WORDS = 10
#: Load added before the logarithm, that of about one match in some thousand words.
FLOOR = 1e-3

#: Letters of other scripts that look like Latin ones (fixed values).
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x",
    "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i",
}
#: Digits and signs used in place of letters (fixed values).
SUBSTITUTES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}


class _Fold(dict):
    """A translation table that is filled as characters turn up."""

    def __missing__(self, point: int) -> str:
        char = chr(point)
        plain = unicodedata.normalize("NFKC", char) if point > 0x2000 else char
        char = plain.lower() if len(plain) == 1 else char
        char = SUBSTITUTES.get(char) or HOMOGLYPHS.get(char) or char
        self[point] = char if char.isalpha() else " "
        return self[point]


_fold = _Fold()
#: Runs of scripts that do not put spaces between words.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")


def fold(text: str) -> str:
    """Folded text; as long as the lower-cased one, with a space before and after."""
    return f" {text.lower().translate(_fold)} "


def starts(word: str) -> set[str]:
    """The terms that a folded word holds; whole short words end in a space."""
    found = set()
    if not word.isascii():
        for run in _UNSPACED.findall(word):
            found.update(run[k : k + n] for n in range(1, PIECE + 1) for k in range(len(run) - n + 1))
        if _UNSPACED.match(word):
            return found
    if len(word) < SHORTEST:
        found.add(word + " ")
    found.update(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
    return found


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: float = 0.0
    offset: float = 0.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term if _UNSPACED.match(term) else " " + term, (len(term), weight, False))
        for phrase in self.exceptions:
            # A phrase is whole words; its last space is the next word's first.
            found.add_word(f" {phrase} ", (len(phrase) + 1, 0.0, True))
        found.make_automaton()
        return found

    def load(self, automaton, text: str) -> float:
        """The weight of matches outside exception phrases, per word."""
        folded = fold(text)
        hits, spared = [], []
        for end, (size, weight, exception) in automaton.iter(folded):
            (spared if exception else hits).append((end - size + 1, weight, end))
        if not hits:
            return 0.0
        original = f" {text.lower()} "
        total, last = 0.0, -1
        for begin, weight, end in sorted(hits, key=lambda h: (h[0], -h[2])):
            if begin <= last or any(b - 1 <= begin and end <= e for b, _, e in spared):
                continue  # the longest term at a place counts
            if any(c.isalpha() for c in original[begin : end + 1]):
                total, last = total + weight, end if _UNSPACED.match(folded[begin]) else begin
        words = len(text.split())
        if not text.isascii():
            words += sum(len(run) // 2 for run in _UNSPACED.findall(folded))
        return total / (words + EXTRA_WORDS)

    def score(self, automaton, text: str) -> float:
        load = self.load(automaton, text)
        if load <= 0:
            return 0.0
        return 1 / (1 + math.exp(-(self.offset + self.slope * math.log(load + FLOOR))))


def _terms(text: str) -> set[str]:
    """The distinct terms of a text."""
    return set().union(*map(starts, set(fold(text).split())))


def _phrases(text: str, weights: dict[str, float]) -> set[str]:
    """Two words in a row, of which one holds a term."""
    words = fold(text).split()
    telling = {w for w in set(words) if not weights.keys().isdisjoint(starts(w))}
    if not telling:
        return set()
    return {f"{a} {b}" for a, b in zip(words, words[1:]) if a in telling or b in telling}


def _surprise(n1: int, n0: int, share: float) -> float:
    """How unlikely so many toxic ones among n1 + n0 documents are by chance: -log of a bound of the probability."""
    n = n1 + n0
    out = n1 * math.log(n1 / (n * share))
    return out + n0 * math.log(n0 / (n * (1 - share))) if n0 else out


def _odds(n1: int, n0: int, sizes: dict[int, int]) -> float:
    return ((n1 + 0.5) / (sizes[1] + 1)) / ((n0 + 0.5) / (sizes[0] + 1))


def choose(seen: list[tuple[str, int, int]], tests: int, sizes: dict[int, int]) -> dict[str, float]:
    """Terms with weights, from (term, toxic documents, others); ``tests`` terms were looked at.

    The rule of Benjamini and Hochberg: the k-th most significant term counts if its probability is at most
    k / ``tests`` of ``FALSE_SHARE``, or a later one's is.
    """
    share = sizes[1] / (sizes[0] + sizes[1])
    ranked = []
    for term, n1, n0 in seen:
        if n1 >= FEWEST and _odds(n1, n0, sizes) >= ODDS:
            ranked.append((_surprise(n1, n0, share), term, n1, n0))
    ranked.sort(key=lambda r: (-r[0], r[1]))
    most = 0
    for k, row in enumerate(ranked, 1):
        if row[0] >= math.log(tests / (FALSE_SHARE * k)):
            most = k
    telling = {term: (surprise, n1, n0) for surprise, term, n1, n0 in ranked[:most]}
    longer: dict[str, str] = {}
    for term, (_, n1, _) in telling.items():
        # A start that goes on in one way only stands for the longer one.
        before = term[:-1]
        if before in telling and n1 > 0.95 * telling[before][1] and term > longer.get(before, ""):
            longer[before] = term
    terms = set()
    for term in telling:
        if term[:-1] in telling:
            continue
        while term in longer:
            term = longer[term]
        terms.add(term)
    best = sorted(terms, key=lambda t: (-telling[t][0], t))[:MOST_TERMS]
    return {t: math.log(_odds(*telling[t][1:], sizes)) for t in best}


def _harmless(seen: list[tuple[str, int, int]]) -> list[str]:
    """Phrases that only other documents have."""
    found = [(n0, p) for p, n1, n0 in seen if n0 >= 3 and not n1]
    return [p for _, p in sorted(found, reverse=True)[:MOST_PHRASES]]


def _fit(lexicon: Lexicon, loads: list[tuple[float, int]]) -> None:
    """Logistic regression on the log of the load; Newton steps with a small ridge."""
    y = np.array([y for _, y in loads], float)
    x = np.stack([np.ones(len(y)), np.log(np.array([load for load, _ in loads]) + FLOOR)], 1)
    beta = np.zeros(2)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - 0.1 * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        beta = beta + np.linalg.solve(curve, slope)
    lexicon.offset, lexicon.slope = float(beta[0]), float(beta[1])


def _tally(rows, terms) -> list[tuple[str, int, int]]:
    seen = {0: Counter(), 1: Counter()}
    for text, y in rows:
        seen[y].update(terms(text))
    return [(t, seen[1][t], seen[0][t]) for t in seen[0].keys() | seen[1].keys()]


def learn(rows: list[tuple[str, int]]) -> Lexicon:
    """Terms, weights, exception phrases and calibration from (text, 0 or 1)."""
    rows = sorted(set(rows))  # copies tell nothing new
    sizes = Counter(y for _, y in rows)
    if not sizes[0] or not sizes[1]:
        return Lexicon()
    seen = [r for r in _tally(rows, _terms) if r[1] + r[2] >= FEWEST]
    lexicon = Lexicon(choose(seen, len(seen), sizes))
    lexicon.exceptions = _harmless(_tally(rows, lambda t: _phrases(t, lexicon.weights)))
    automaton = lexicon.automaton() if lexicon.weights else None
    _fit(lexicon, [(lexicon.load(automaton, t) if automaton else 0.0, y) for t, y in rows])
    return lexicon


def _counted(rows: DataFrame, terms) -> DataFrame:
    """(``term``, ``n1``, ``n0``): in how many of ``rows`` (``text``, ``y``) of each class a term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            n1, n0 = ([seen[y][t] for t in keys] for y in (1, 0))
            columns = [pa.array(keys, pa.string()), pa.array(n1, pa.int64()), pa.array(n0, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["term", "n1", "n0"])

        seen = (Counter(), Counter())
        for batch in slices(batches):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[y].update(terms(text))
                if len(seen[0]) + len(seen[1]) > MOST_COUNTS:
                    yield out()
                    seen = (Counter(), Counter())
        yield out()

    parts = rows.select("text", "y").mapInArrow(run, "term string, n1 bigint, n0 bigint")
    return parts.groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _likely(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose id may be in ``marks``: by a bit table of bounded size, before anything is shuffled."""
    cell = F.pmod(F.xxhash64("id"), F.lit(CELLS))
    word, bit = F.floor(cell / 64).alias("_word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {CELLS}L) % 64 as int))")
    bits = marks.groupBy(word).agg(F.bit_or(bit).alias("_bits"))
    found = texts.withColumn("_word", word).withColumn("_bit", bit).join(F.broadcast(bits), "_word")
    return found.where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*texts.columns)


def learn_from(docs: DataFrame, labels: DataFrame, label: str = "toxic", *, id_column: str = "doc_id") -> Lexicon:
    """:func:`learn` from all labelled documents, counted in tasks; only terms, phrases and loads reach the driver."""
    marks = labels.where(F.col(label).isin(0, 1)).select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("y"))
    texts = docs.select(F.col(id_column).alias("id"), "text").where("text is not null")
    texts = _likely(texts, marks).withColumn("mark", F.md5("text"))
    # Copies are found by marks; of the texts, only those learned from are shuffled, once. Labels grow with the input: no broadcast.
    ids = texts.select("id", "mark").join(marks.hint("merge"), "id")
    ids = written(ids.groupBy("mark", "y").agg(F.min("id").alias("id")), "toxicity-ids")
    rows = texts.join(ids.hint("merge"), ["id", "mark"]).groupBy("id", "mark", "y").agg(F.first("text").alias("text"))
    rows = written(rows, "toxicity-rows")
    sizes = {0: 0, 1: 0} | {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes[0] or not sizes[1]:
        return Lexicon()

    seen = written(_counted(rows, _terms).where(F.col("n1") + F.col("n0") >= FEWEST), "toxicity-terms")
    n1, n0, share = F.col("n1"), F.col("n0"), sizes[1] / (sizes[0] + sizes[1])
    surprise = n1 * F.log(n1 / ((n1 + n0) * share)) + F.when(n0 > 0, n0 * F.log(n0 / ((n1 + n0) * (1 - share)))).otherwise(0.0)
    odds = ((n1 + 0.5) / (sizes[1] + 1)) / ((n0 + 0.5) / (sizes[0] + 1))
    best = seen.where((n1 >= FEWEST) & (odds >= ODDS)).orderBy(surprise.desc(), "term").limit(MOST_CANDIDATES)
    lexicon = Lexicon(choose([tuple(r) for r in best.collect()], seen.count(), sizes))

    if lexicon.weights:
        weights = lexicon.weights
        phrases = _counted(rows, lambda t: _phrases(t, weights)).where("n1 = 0 and n0 >= 3")
        lexicon.exceptions = _harmless([tuple(r) for r in phrases.orderBy(F.desc("n0"), F.desc("term")).limit(MOST_PHRASES).collect()])
    drawn = F.lit(False)
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    for y, n in sizes.items():
        drawn = drawn | ((F.col("y") == y) & (place < min(1.0, LEARN_DOCS / n)))
    loads = _loads(rows.where(drawn), lexicon).collect()
    _fit(lexicon, sorted((r.load, r.y) for r in loads))
    return lexicon


def _loads(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton() if lexicon.weights else None
        for batch in slices(batches):
            found = [lexicon.load(automaton, t) if automaton else 0.0 for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), batch.column(1)], ["load", "y"])

    return rows.select("text", "y").mapInArrow(run, "load double, y int")


def score(docs: DataFrame, lexicon: Lexicon, *keep: Column | str, text_column: str = "text") -> DataFrame:
    """Columns ``keep`` and ``score`` of every whole text."""
    kept = docs.select(*keep, F.col(text_column).alias("_text"))
    columns = kept.columns[:-1]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton() if lexicon.weights else None
        for batch in slices(batches):
            texts = filled(batch.column(len(columns))).to_pylist()
            found = [lexicon.score(automaton, t) if automaton else 0.0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.float64())], [*columns, "score"]
            )

    return kept.mapInArrow(run, f"{fields}, score double")
