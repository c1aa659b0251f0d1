"""Licence scan against a plain scan of word lists."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowcubes.llm import license_scan as L
from llm_helpers import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def stands(words, phrase):
    p = phrase.split()
    return [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]


def plain(text):
    words = words_of(text)
    at = {p: stands(words, p) for p in PHRASES}
    every = [x for v in at.values() for x in v]
    return len(words), len(every), min(every, default=None), max(every, default=None), ",".join(sorted({PHRASES[p] for p, v in at.items() if v}))


def labels(text):
    """Labels by trying every place for every key phrase."""
    words, out = words_of(text), set()
    for t in L.BASE + L.TEMPLATES:
        keys = t.keys or (t.text,)
        for first in stands(words, keys[0]):
            at = first
            for k in keys[1:]:
                later = [x for x in stands(words, k) if at < x <= first + len(t.text.split()) * 3 // 2]
                at = later[0] if later else None
                if at is None:
                    break
            if at is not None:
                out.add(t.label)
    return ",".join(sorted(out))


HARD = [
    None, "", "...", "Under the MIT License", "under the mit-license, UNDER THE (MIT) LICENSE!", "under under the mit license mit license", "cc by nc cc-by-nc CC BY NC", "apache license version 2.0 Apache License, Version 20",
    "é under the mit license\xa0", "under\xa0the mit license", "under the mıt license", "the the the mit", "CC BY NC SA", "cc by\x00nc", "1 cc2 by nc",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including",
    "Permission is hereby granted, free of charge. " + "x " * 400 + "to deal in the software without restriction",
    "Redistribution and use in source and binary forms, with or without changes, are permitted provided that the following conditions are met:",
    "This work is licensed under the GNU General Public License, version 3, not version 2.", "gnu lesser general public license version 3",
]


@pytest.fixture(scope="module")
def index():
    return L.Index(L.BASE + L.TEMPLATES, {b"the": 90, b"license": 20, b"mit": 3}, 100)


def test_scan_equals_the_plain_scan(docs_of, clash):
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, "under the mit license"), (3, HARD[3]), (3, HARD[3])]
    parts = [*PHRASES, "under", "the", "mit", "license", "cc", "by", "nc", "apache license", "version 2", "version 3 gnu general public license"]
    rows += [(100 + i, prose(rng, 30) + " " + rng.choice([" ", ", ", "-"]).join(rng.choice(parts) for _ in range(rng.randint(1, 30)))) for i in range(200)]
    docs = docs_of(rows, clash)
    got = L.scan(docs, L.learn(docs)).collect()
    key = lambda r: tuple((x is not None, x) if not isinstance(x, str) else (True, x) for x in r)
    want = [(i, *plain(t), labels(t)) for i, t in rows]
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in got), key=key) == sorted(want, key=key)
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got)


@settings(max_examples=300, deadline=None)
@given(st.text("abnc byunderthmil2-. É\xa0", max_size=60), st.integers(1, 9))
def test_blocks_hold_the_words_wherever_they_are_cut(text, size):
    assert [w.decode() for part in L.blocks(text.encode(), size) for w in part] == words_of(text)


def test_a_gapped_template_scores_less_than_a_whole_one(index):
    def score(text):
        spots = {i: w for i, w in enumerate(L.spoken(text)) if w in index.idf}
        return {index.templates[t].label: s for t, s in index.accepted(index.places(spots), spots).items()}

    whole = L.TEMPLATES[2].text
    assert score(whole) == {"bsd": pytest.approx(1)}
    assert 0 < score(whole.replace("with or without modification are", "are"))["bsd"] < 1
    assert score(whole.replace("conditions", "rules")) == {}


def test_the_index_holds_the_rarest_words(index):
    phrase = index.of[0][0]
    assert {w for w, p in index.postings.items() if any(x == phrase for x, _ in p)} == {b"mit", b"under"}


def test_empty_table(docs_of):
    docs = docs_of([])
    assert L.scan(docs, L.learn(docs)).count() == 0
