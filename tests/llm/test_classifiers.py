from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rillflow.llm import language, quality, toxicity
from rillflow.llm.common import labelled_sample, utf8
from rillflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def crc(doc):
    return zlib.crc32(str(doc).encode())


# --- held-out accuracy on the supplied tables ---------------------------------------


def test_held_out_language(spark):
    found = QUERIES["op3_language"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) == 1_000 and all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == r.lang for r in rows if r.held_out and r.lang_pred != "und"]
    assert np.mean(held) >= 0.97


def test_held_out_quality_and_toxicity(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for name, label, rest, least in (("op9_quality", "quality", (4, 2), 0.95), ("op10_toxicity", "toxic", (5, 0), 0.97)):
        rows = QUERIES[name](spark, FOLDER)
        assert rows.count() == 1_000
        held = [r for r in rows.join(labels, "doc_id").collect() if r.held_out]
        assert all(r.held_out == (crc(r.doc_id) % rest[0] == rest[1]) and 0 <= r.score <= 1 for r in held)
        assert np.mean([r.predicted == r[label] for r in held]) >= least


# --- language -----------------------------------------------------------------------


def plain_ngrams(text):
    counts, word = {}, ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
            continue
        if word:
            edged = f" {word} "
            for n in (1, 2, 3):
                for k in range(len(edged) - n + 1):
                    gram = edged[k : k + n]
                    if gram.strip():
                        counts[gram] = counts.get(gram, 0) + 1
        word = ""
    return counts


@pytest.mark.parametrize("text", ["a", "ab", "Abc, dé f", "--x1y22z\n", "ÀÉ ñ 漢字", "a" * 50, "", " 12 "])
def test_ngrams_are_those_of_words_with_edges(text):
    def code(gram):
        out = 0
        for c in gram:
            out = out << 21 | (language._EDGE if c == " " else ord(c))
        return out

    codes, counts = language.ngrams(text)
    want = {code(g): n for g, n in plain_ngrams(text).items() if g not in ("  ",)}
    assert dict(zip(codes.tolist(), counts.tolist())) == want


def test_language_odd_rows(documents):
    rows = [(k, "the cat and the dog " * 5, "en") for k in range(5)] + [(10 + k, "le chat et le chien " * 5, "fr") for k in range(5)]
    odd = [(20, None, "en"), (21, "", "fr"), (22, "123 ... !", None), (23, "the dog", None), (23, "the dog", None), (24, "chien " * 50_000, None)]
    docs = documents(rows + odd)
    found = language.identify(docs, language.learn_profiles(docs), docs["doc_id"]).collect()
    by = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert len(found) == 16 and by[20] == by[21] == by[22] == ("und", 0.0)
    assert by[23][0] == "en" and by[24][0] == "fr" and by[0][0] == "en"
    empty = documents([])
    assert language.learn_profiles(empty) == {}
    assert language.identify(docs, {}, docs["doc_id"]).where("lang_pred <> 'und'").count() == 0
    assert language.identify(empty, {}, empty["doc_id"]).collect() == []


def test_equal_distances_go_to_the_first_language(documents):
    docs = documents([(1, "abc abc", "x"), (2, "abc abc", "b"), (3, "abc", None)])
    found = language.identify(docs, language.learn_profiles(docs), docs["doc_id"]).collect()
    assert {r.lang_pred for r in found} == {"b"}


# --- quality ------------------------------------------------------------------------


def plain_features(text):
    """Words, marks for repeated words, and n-grams within words, with white space at their ends."""
    data = text.encode()
    clean = bytes(0x20 if c in b" \t\n\x0b\x0c\r" else c for c in data)
    words = data.split()
    grams = []
    for n in (3, 4):
        for k in range(len(clean) - n + 1):
            if b" " not in clean[k + 1 : k + n - 1]:
                grams.append(clean[k : k + n])
    return len(words), sum(a == b for a, b in zip(words, words[1:])), len(grams)


def test_features_are_counted_per_text():
    texts = ["one two  two\ntwo", "", " ", "é abc", "x", "a b c d", "long" * 40]
    kinds = list(quality.features(*utf8(pa.array(texts))))
    for k, text in enumerate(texts):
        n_words, again, grams = plain_features(text)
        counts = [int((of == k).sum()) for _, of in kinds]
        assert counts == [n_words, again, counts[2], grams - counts[2]]
    # The same text has the same features wherever it stands.
    alone = [np.sort(b) for b, _ in quality.features(*utf8(pa.array([texts[0]])))]
    among = [np.sort(b[of == 0]) for b, of in kinds]
    assert all((a == b).all() for a, b in zip(alone, among))


def test_classifier_learns_and_is_the_same_again():
    rng = random.Random(1)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(30)) for _ in range(60)]
    bad = [" ".join([rng.choice(["alpha", "beta"])] * 30) for _ in range(30)] + ["ALPHA!! BETA!! " * 12] * 30
    model = quality.train(good + bad, [1] * 60 + [0] * 60)
    scores = model.scores(*utf8(pa.array(good + bad)))
    assert (scores[:60] > 0.7).all() and (scores[60:] < 0.5).all()
    again = quality.train(good + bad, [1] * 60 + [0] * 60)
    assert (again.logits == model.logits).all()


def test_quality_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "word " * 100_000), (4, "word"), (5, "ok")]
    docs = documents(rows)
    labels = spark.createDataFrame([(5, 1, 0), (4, None, 1), (9, 0, 1)], "doc_id bigint, quality int, toxic int")
    assert quality.sample(docs, labels, "quality") == [("ok", 1)]
    model = quality.train(["ok"], [1])  # one class only
    scores = {r.doc_id: r.score for r in quality.score(docs, model, "doc_id").collect()}
    assert len(scores) == 5 and all(s > 0.9 for s in scores.values())
    assert quality.train([], []).scores(*utf8(pa.array(["x"]))).tolist() == [0.5]
    kept = quality.keep_good(docs, model, 0.7)
    assert kept.columns == docs.columns and kept.count() == 6
    empty = documents([])
    assert quality.score(empty, model, "doc_id").collect() == [] and quality.keep_good(empty, model, 0.7).collect() == []


# --- toxicity -----------------------------------------------------------------------


def lexicon():
    rng = random.Random(2)
    calm = ["tree", "river", "stone", "cloud", "waste", "bin", "leaf"]
    rows = []
    for k in range(120):
        words = [rng.choice(calm) for _ in range(40)]
        if k % 2:
            for _ in range(3):
                words.insert(rng.randrange(40), rng.choice(["vilebeast", "vilething", "grimwort"]))
        elif k % 3 == 0:
            words[5:7] = ["grimwort", "salad"]
        rows.append((" ".join(words), k % 2))
    return toxicity.learn(rows)


def test_lexicon_terms_exceptions_and_folding():
    found = lexicon()
    assert any("vile".startswith(t[:4]) or t.startswith("vile") for t in found.weights)
    automaton = found.automaton()
    score = lambda t: found.score(automaton, t)
    clean = "tree river stone cloud " * 8
    assert score(clean) == 0.0
    assert score(clean + "vilebeast vilebeast") > 0.5
    # Cyrillic look-alikes and digits for letters.
    assert score(clean + "vіlebeаst v1l3beast") == score(clean + "vilebeast vilebeast")
    # Only starts of words count, and digits alone are no letters.
    assert score(clean + "evilebeast 71134") == 0.0
    if any(t.startswith("grim") for t in found.weights):
        assert score(clean + "grimwort salad") == 0.0
    # The same matches weigh less in a longer text.
    assert score(clean * 40 + "vilebeast") < score(clean + "vilebeast")


def test_exception_phrases_spare_a_term():
    own = toxicity.Lexicon({"trash": 2.0}, ["trash can"], slope=1.0, offset=3.0)
    automaton = own.automaton()
    assert own.score(automaton, "a trash can here") == 0.0
    assert own.score(automaton, "a trash cat here") > 0.5
    assert own.score(automaton, "trash can, trash") > 0.5


def test_toxicity_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "123"), (4, "vilebeast " * 60_000), (4, "tree"), (5, "vilebeast")]
    docs = documents(rows)
    found = [(r.doc_id, r.score) for r in toxicity.score(docs, lexicon(), "doc_id").collect()]
    scores = dict(sorted(found, key=lambda r: r[1]))
    assert len(found) == 6 and scores[1] == scores[2] == scores[3] == 0.0 and scores[4] > 0.5 and scores[5] > 0.5
    assert toxicity.learn([]) == toxicity.Lexicon() == toxicity.learn([("a b", 1)])
    nothing = toxicity.score(docs, toxicity.Lexicon(), "doc_id").collect()
    assert {r.score for r in nothing} == {0.0}
    assert toxicity.score(documents([]), lexicon(), "doc_id").collect() == []
    labels = spark.createDataFrame([(5, 1), (3, 0), (2, None), (77, 1)], "doc_id bigint, toxic int")
    assert labelled_sample(docs, labels, "toxic", 10, 4) == [("123", 0), ("vile", 1)]


def rare_terms():
    rng = random.Random(7)
    calm = [f"calm{chr(97 + a)}{chr(97 + b)}" for a in range(12) for b in range(12)]
    rows = []
    for k in range(3_000):
        text = " ".join(rng.choice(calm) for _ in range(30))
        if k % 6 == 0:  # 500 toxic documents; three terms are in 8 of them each
            rare = {0: "bomenteta", 1: "zq", 2: "今日漢毒字天"}.get(k // 6 % 60, "vilebeast")
            text = f"{text} {rare} " + " ".join(rng.choice(calm) for _ in range(5))
        rows.append((text, int(k % 6 == 0)))
    return rows


def test_rare_short_and_unspaced_terms(spark, documents):
    rows = rare_terms()
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(rows)], "doc_id bigint, toxic int")
    copies = [(k, text) for k, (text, _) in enumerate(rows)]
    docs = documents(copies + copies[:9] + [(9_999, None), (None, "of no label")])
    whole = toxicity.learn_from(docs.repartition(5), labels)
    plain = toxicity.learn(rows)
    assert whole.weights == plain.weights and whole.exceptions == plain.exceptions
    assert (whole.slope, whole.offset) == pytest.approx((plain.slope, plain.offset), rel=0.1)
    automaton = whole.automaton()
    for text in ("a bomenteta b", "calm zq calm", "今日漢毒字天", "好好今日漢毒字天好好"):
        assert whole.score(automaton, text) > 0.5, text
    for text in ("calmaa calmbb", "zqa azq"):
        assert whole.score(automaton, text) == 0.0, text
    assert toxicity.learn_from(docs.limit(0), labels) == toxicity.Lexicon()


def test_terms_late_in_a_long_text_are_learned(spark, documents):
    rows = [(k, "calm tree " * 1_000 + ("vilebeast" if k % 2 else "stone") + f" n{'x' * k}") for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id bigint, toxic int")
    found = toxicity.learn_from(documents(rows), labels)
    assert any("vilebeast".startswith(t) for t in found.weights)
