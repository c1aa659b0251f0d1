from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowcubes.llm import fingerprints as P
from llm_helpers import prose

DIGESTS = st.lists(st.integers(0, 2**64 - 1), max_size=80, unique=True)


@settings(max_examples=200, deadline=None)
@given(DIGESTS, DIGESTS, DIGESTS)
def test_peeling_recovers_the_exact_difference(shared, a, b):
    a, b = set(a) - set(shared), set(b) - set(shared)
    first, second = P.difference(np.array([*shared, *a], "u8"), np.array([*b, *shared], "u8"))
    assert (first, second) == (a - b, b - a)


def test_a_full_table_gets_stuck_and_a_larger_one_does_not():
    many = np.random.default_rng(1).integers(0, 2**63, 100, "u8")
    assert P.peel(P.sketch(many)) is None
    assert P.difference(many, many[:0])[0] == set(many.tolist())


def test_published_fingerprints_of_most_edited_texts_peel(docs_of, rng):
    """Nothing but two returned strings gives the exact difference."""
    docs = [(i, ". ".join(prose(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 60)))) for i in range(200)]
    texts = dict(docs)
    peeled = 0
    for r in P.fingerprints(docs_of(docs)).collect():
        found = P.compared(P.table_of(r.fingerprint), P.table_of(r.edited_fingerprint))
        if found is not None:
            after = texts[(r.doc_id - 1) % 200]
            text, half = texts[r.doc_id], len(texts[r.doc_id]) // 2
            own, new = (set(P.paragraph_digests(t).tolist()) for t in (text, text[:len(text) - half] + after[:half]))
            assert found == (own - new, new - own)
            peeled += 1
    assert peeled >= 180


@pytest.mark.parametrize("n", [10, 5000])
def test_a_difference_that_never_peels_is_found_by_comparison(monkeypatch, n):
    monkeypatch.setattr(P, "peel", lambda table: None)
    many = np.random.default_rng(1).integers(0, 2**63, n, "u8")
    assert P.difference(many, many[1:]) == ({int(many[0])}, set())


def test_likeness_counts_repeats():
    a, b = P.paragraph_digests("x y.\nx y.\nz."), P.paragraph_digests("x y.\nz.")
    assert P.likeness(a, b) == pytest.approx(2 / 3)
    assert P.likeness(a, a) == 1.0 and P.likeness(a[:0], b[:0]) == 1.0 and P.likeness(a, b[:0]) == 0.0


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, new, other = (Counter(P.paragraph_digests(t).tolist()) for t in (text, edited, after))
        near = lambda x, y: sum((x & y).values()) / sum((x | y).values()) if x or y else 1.0
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(near(own, new), 12), round(near(own, other), 12)))
    return out


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_documents_and_their_next(docs_of, rng, clash, buckets, monkeypatch):
    rows = [(rng.randint(-50, 5000), ". ".join(prose(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 20)))) for _ in range(120)]
    rows += [(7, None), (8, ""), (9, "é😀" * 10), (None, "no id"), (9, "é😀" * 10), (3, "word " * 60_000)]
    real = P.with_next
    monkeypatch.setattr(P, "with_next", lambda d: real(d, buckets))
    got = [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12)) for r in P.fingerprints(docs_of(rows, clash)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_equal_texts_have_equal_fingerprints_and_edges(docs_of):
    got = {(r.doc_id): r for r in P.fingerprints(docs_of([(1, "a b. c d."), (2, "a b. c d."), (3, "other.")])).collect()}
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint
    one = P.fingerprints(docs_of([(1, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    assert P.fingerprints(docs_of([])).count() == 0
