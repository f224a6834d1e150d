from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from rillflow.llm.common import utf8
from rillflow.llm.queries import MIX, QUERIES, quality_model, tokenizer_file
from tests.llm.test_decontaminate import brute as items_in
from tests.llm.test_mixing import repeated_shares
from tests.llm.test_neardup import brute as groups_of

FOLDER = "/root/testdata/sf0.001"


def plain_mix(rows):
    """(doc_id, text) of every repetition."""
    size = {d: len((t or "").encode().split()) for d, t, _ in rows}
    totals = Counter()
    for d, _, s in rows:
        totals[s] += size[d]
    order = sorted(s for s in totals if s is not None) + [None] * (None in totals)
    weights = {s: MIX["weights"][k % 3] for k, s in enumerate(order)}
    target = repeated_shares(dict(totals), weights, MIX["share"], MIX["epochs"])
    out = []
    for source in order:
        own = [(hashlib.md5(f"17:{d}".encode()).hexdigest(), d, t) for d, t, s in rows if s == source]
        whole = int(target[source] // max(totals[source], 1))
        rest = round(target[source]) - whole * totals[source]
        for _, d, text in sorted(own, key=lambda r: r[:2]):
            part = max(0, min(size[d], rest))
            rest -= size[d]
            taken = whole * size[d] + part
            out += [(d, text)] * (taken // max(size[d], 1))
            if taken % max(size[d], 1):
                words, at = text.encode().split()[: taken % size[d]], 0
                for w in words:
                    at = text.encode().index(w, at) + len(w)
                out.append((d, text.encode()[:at].decode()))
    return out


def test_run_is_what_plain_python_makes_of_the_documents(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality_model(spark, docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    total = len(rows)
    rows = [r for r in rows if model.scores(*utf8(pa.array([r[1]])))[0] >= 0.7]
    assert 0.5 * total < len(rows) < total
    groups = groups_of([r[:2] for r in rows], 5)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    rows = [r for r in rows if not items_in(r[1], items)]
    mixed = plain_mix(rows)
    tokenizer = Tokenizer.from_file(tokenizer_file())

    want = Counter()
    for d, text in mixed:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want[d, len(ids), zlib.crc32(ids.tobytes())] += 1
    found = corpus_pipeline.run(spark, FOLDER).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == want
    assert [r.doc_id for r in found] == sorted(r.doc_id for r in found)
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()


@pytest.mark.parametrize("k", range(5))
def test_stages_take_empty_tables_and_odd_rows(spark, k):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    name, stage = corpus_pipeline.STAGES[k]
    empty = stage(spark, docs.limit(0), FOLDER)
    assert empty.collect() == [] and (k == 4 or empty.columns == docs.columns)
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "words of no document", "en", None, 20)], docs.schema
    )
    stage(spark, odd, FOLDER).collect()


def test_every_operator_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(entry.oracle_sql()) <= set(names)
