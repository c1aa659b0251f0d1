"""Phrase mining against plain counters."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowcubes.llm import collocations as C

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, top=C.TOP, least=C.MIN_COUNT):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            total[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items()):
                continue
            score, _, l, r = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def got(docs, **how):
    return sorted(tuple(r[c] for c in COLUMNS) for r in C.collocations(docs, **how).collect())


def talk(rng, n, words, marks=" .,;:!?\n\r\x0b\x0c\t"):
    return "".join(rng.choice(words) + (rng.choice(marks) if rng.random() < 0.2 else "  " if rng.random() < 0.05 else " ") for _ in range(n))


VOCABULARY = ["the", "The", "of", "new", "york", "city", "été", "a\xa0b", "x\x00y", "-", " z", "Ünder", "it's", "\x1c", "\x85q", "ÉTÉ"]


def test_phrases_equal_plain_counts(docs_of, clash):
    rng = random.Random(5)
    rows = [(i, talk(rng, rng.randint(1, 120), VOCABULARY), rng.choice(["en", "de", None, "und", ""])) for i in range(150)]
    rows += [(900, None, "en"), (901, "", "fr"), (902, " . ,\t", "fr"), (None, "new york city " * 30, "fr"), (903, "new york city " * 30, "fr"), (903, "new york city " * 30, "fr")]
    docs = docs_of(rows, {k: v for k, v in clash.items()} | {"h": "1", "shard": "'s'", "phrase": "2"})
    want = brute([(r[2], r[1]) for r in rows])
    assert {w[0] for w in want} == {"en", "de", "und", "", "fr"}
    for how in ({}, {"block": 300}, {"block": 23}):
        assert got(docs.repartition(7), **how) == want
    assert got(docs.coalesce(1), top=3) == brute([(r[2], r[1]) for r in rows], 3)


def test_a_phrase_at_the_limit_over_many_shards(docs_of):
    """Ten occurrences, dealt out as evenly as tasks allow, and nine of another."""
    rows = [(i, "rare bird sings " + ("odd fish" if i < 9 else "") + f". w{i} x{i}", "en") for i in range(10)]
    for parts in (1, 3, 4, 9):
        assert got(docs_of(rows).repartition(parts)) == brute([(r[2], r[1]) for r in rows]) != []


def test_empty_tables(docs_of):
    assert got(docs_of([])) == [] and got(docs_of([(1, None), (2, "a b c")])) == []


def test_ties_go_to_the_first_cut_and_to_the_bytes(docs_of):
    rows = [(i, "a b c. é f. z y. é f. z y", "en") for i in range(10)]
    assert got(docs_of(rows)) == brute([(r[2], r[1]) for r in rows])


@settings(max_examples=300, deadline=None)
@given(st.text("ab é \n.", max_size=80), st.integers(1, 12))
def test_blocks_hold_every_phrase_once(text, size):
    found, raw = Counter(), C.folded([text.encode()])
    for part, own in C.blocks(raw, size):
        words = C.words_of(part, own)
        for k in (1, 2, 3) if words else ():
            found.update(words.texts(words.places(k), k))
    want = Counter(" ".join(p[i:i + k]).encode() for p in pieces(text) for k in (1, 2, 3) for i in range(len(p) - k + 1))
    assert found == want


def counted_in_a_task(texts, monkeypatch, keys=None, held=None):
    """(counts by text, rows) of a task whose set holds all hashes."""
    if keys:
        monkeypatch.setattr(C.Words, "keys", keys)
    if held:
        monkeypatch.setattr(C, "HELD_PHRASES", held)
    counting, total, rows = C.Counting((1, 2, 3), C.Bits(8, b"\xff" * 32), False), Counter(), 0
    for lang, text in texts:
        for raw, own in C.blocks(C.folded([text.encode()]), 200):
            words = C.words_of(raw, own)
            if words is not None:
                counting(words, C.salt_of(lang), lang)
            for found in counting.given(False):
                total, rows = added(total, found), rows + len(found["n"])
    for found in counting.given(True):
        total, rows = added(total, found), rows + len(found["n"])
    return total, rows


def added(total, found):
    columns = [x.to_pylist() if hasattr(x, "to_pylist") else list(x) for x in (found["lang"], found["words"], found["phrase"], found["n"])]
    for lang, size, phrase, n in zip(*columns):
        total[lang, int(size), phrase] += int(n)
    return total


@pytest.mark.parametrize("held", [None, 40])
@pytest.mark.parametrize("kinds", [None, 1, 7])
def test_no_count_rests_on_a_hash(monkeypatch, kinds, held):
    """Also where all phrases of a task share a hash, or seven of them."""
    rng = random.Random(kinds)
    texts = [(rng.choice(["en", "de"]), talk(rng, 150, VOCABULARY + ["seveneig", "seveneigh", "seveneighu", "long" * 90, "long" * 89 + "lonk"])) for _ in range(6)]
    keys = kinds and (lambda self, places, size, salt: (self.start[places] % kinds).astype("u8"))
    got, _ = counted_in_a_task(texts, monkeypatch, keys, held)
    want = Counter()
    for lang, text in texts:
        for p in pieces(text):
            want[lang, 0, b""] += len(p)
            want.update((lang, k, " ".join(p[i:i + k]).encode()) for k in (1, 2, 3) for i in range(len(p) - k + 1))
    assert +got == +want


def test_a_task_gives_out_a_phrase_once(monkeypatch):
    """Words far more than 200,000, in many blocks, each of them twice."""
    texts = [("en", ". ".join(f"w{i}" for i in range(k, k + 5_000))) for _ in range(2) for k in range(0, 250_000, 5_000)]
    got, rows = counted_in_a_task(texts, monkeypatch)
    assert len(got) == rows == 250_001 and got["en", 1, b"w7"] == 2


def test_phrases_below_the_minimum_in_all_are_not_counted(docs_of, monkeypatch):
    sets, plain = [], C.bits_of
    monkeypatch.setattr(C, "bits_of", lambda hashes: sets.append(hashes.count()) or plain(hashes))
    docs = docs_of([(i, "lone pair. " if i < 9 else "x y. ") for i in range(24)]).coalesce(2)
    assert got(docs) == brute([("en", "lone pair" if i < 9 else "x y") for i in range(24)]) != []
    assert sets == [3, 0]  # x, y and "x y"; the others reach the support of a shard, but not the minimum


def test_bits_hold_their_hashes(spark):
    h = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 5_000)
    bits, data = C.bits_of(spark.createDataFrame([(int(x),) for x in h], "h long"))
    held = C.Bits(bits, data.value)
    assert held.has(h.view("u8")).all()
    assert held.has(np.random.default_rng(2).integers(0, 2**63, 5_000, "u8")).mean() < 0.06


def test_supports_are_shares_that_lose_nothing(docs_of):
    docs = docs_of([(i, "x" * (i * 7), "en") for i in range(40)]).repartition(9)
    support = C.local_support(docs, 10)
    assert sum(s - 1 for s in support.values()) < 10 and set(support) == set(range(C.SHARDS))


@pytest.mark.parametrize("a", [10**9, 3 * 10**15])
def test_scores_past_64_bits_are_exact(spark, a):
    got = spark.sql(f"select (cast({a} as decimal(19,0)) * cast({a} as decimal(19,0)) * 1000000) div (cast({a + 7} as decimal(19,0)) * cast({a + 1} as decimal(19,0))) s").first().s
    assert got == 1_000_000 * a * a // ((a + 7) * (a + 1))
