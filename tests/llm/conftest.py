from __future__ import annotations

import random

import pytest

from flowcubes.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text[, lang]) rows, as a checkpointed frame."""
    prepare(spark)

    def make(rows, extra: dict[str, str] | None = None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name, sql in (extra or {}).items():
            df = df.selectExpr("*", f"{sql} AS `{name}`")
        return df.checkpoint()

    return make


#: Columns whose names the operators use inside.
CLASH = {"row": "'x'", "k": "1", "score": "2.5", "component": "doc_id", "a b.c": "1", "length": "'l'"}


@pytest.fixture(scope="session")
def clash():
    return CLASH


@pytest.fixture
def rng():
    return random.Random(7)
