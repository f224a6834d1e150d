from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, node int, g int, row int, part int"


def words(rng: random.Random, n: int, vocabulary: int = 4_000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture
def documents(spark):
    """Builds a documents table of (doc_id, text) or longer rows, with further columns of names the operators use themselves."""

    def build(rows):
        full = []
        for r in rows:
            doc, text, lang, source = (*r, None, None)[:4]
            full.append((doc, text, lang, source, len(text or ""), "x", 1, 2, 3, 4))
        return spark.createDataFrame(full, DOCS)

    return build
