"""Token counts, byte-level coding and packing against the libraries."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from flowcubes.llm import byte_bpe, packing, token_counts
from llm_helpers import prose

HARD = [
    None, "", " ", "\n\n \t", "a", "İstanbul ΣΑΣ ﬁne Å é x́", "it's they'll WE'RE 'tis", "don''t  stop here now",
    "<|endoftext|>", "x<|endoftext|>y <|startoftext|> <|end", "漢字かな交じり文" * 50, "😀👍🏽 a‍b", "0123456789 1,000.5 ½²", "\x00\x01 \x7f", "a" * 5000, "é" * 3000, "word " * 4000,
    "a\x1c\x1f\x85b\u2028c\u3000 d\xa0e" * 300, "tab\tnew\nline\r\nend ", "   lead", "trail   ", "a  b   c \n d", "!!!??? ... --- ''' \"\"", "The quick brown fox. " * 900, " \n" * 3000, "x\n\n\nfoo" * 2000,
]


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.fixture(scope="module")
def machine():
    return token_counts.Transducer(public_tokenizers.path(token_counts.VOCABULARY))


@pytest.fixture(scope="module")
def words():
    return library("word_bpe_49k.json")


@pytest.mark.parametrize("text", [t for t in HARD if t])
def test_transducer_counts_as_the_library(machine, words, text):
    assert machine.text(text) == len(words.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(blacklist_categories=("Cs", "Cn", "Co")), max_size=60))
def test_transducer_counts_any_text(text):
    m = token_counts.compiled(None)
    assert m.text(text) == len(_words().encode(text, add_special_tokens=False).ids)


def _words(cache=[]):  # noqa: B006
    if not cache:
        cache.append(library("word_bpe_49k.json"))
    return cache[0]


@settings(max_examples=200, deadline=None)
@given(st.text("ab 'é\n<|>endoftx", max_size=80), st.lists(st.integers(0, 80), max_size=5))
def test_chunk_maps_compose_wherever_a_text_is_cut(text, cuts):
    m = token_counts.compiled(None)
    at = [0, *sorted(min(c, len(text)) for c in cuts), len(text)]
    assert m.fold([m.chunk(text[a:b]) for a, b in zip(at, at[1:])]) == m.text(text)


@settings(max_examples=600, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aÀé字。，、かが\u3099\u0301\u0323 1 ٣½'|<>,.;-\u3000Σß\nsﬁ"), st.characters(blacklist_categories=("Cs", "Cn", "Co"))), max_size=40), st.lists(st.integers(0, 40), max_size=6), st.integers(0, 6))
def test_maps_compose_associatively_to_the_librarys_count(text, cuts, middle):
    m = token_counts.compiled(None)
    at = [0, *sorted(min(c, len(text)) for c in cuts), len(text)]
    maps = [m.chunk(text[a:b]) for a, b in zip(at, at[1:])]
    want = len(_words().encode(text, add_special_tokens=False).ids)
    assert m.fold(maps) == want
    assert m.fold([m.compose(maps[:middle]), m.compose(maps[middle:])]) == want


def test_marks_and_digits_are_cuts(machine):
    for text in ("字" * 50 + "。" + "字" * 50 + "，" + "字" * 50, "a" * 50 + "1" + "b" * 50 + "2" + "c" * 50, '{"k":' + "a" * 90 + ',"v":' + "b" * 90):
        head, tokens, tail = machine.chunk(text)
        assert tokens and len(head) + len(tail) < len(text)


def test_maps_compose_over_several_rounds(docs_of, words):
    rows = [(i, t * 3) for i, t in enumerate(HARD) if t and len(t) > 500] + [(90, "字" * 3000 + "。" + "か" * 3000), (91, "1" * 7000)]
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs_of(rows), chunk=100, fan=16).collect()}
    assert got == {i: len(words.encode(t, add_special_tokens=False).ids) for i, t in rows}


def test_token_counts_of_chunked_and_odd_rows(docs_of, words, clash):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(0, HARD[5]), (None, "no id"), (7, "same"), (7, "same")]
    got = token_counts.count_tokens(docs_of(rows, clash), chunk=1000).collect()
    want = [(i, len((t or "").encode()), len(words.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert token_counts.count_tokens(docs_of([])).count() == 0


def tiktoken_encoding():
    import tiktoken

    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=packing.rank_file(byte_bpe.VOCABULARY), special_tokens={})


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (1000, 200), (16_384, 512)])
def test_chunked_encoding_is_that_of_the_whole_text(docs_of, rng, clash, chunk, overlap):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(100, prose(rng, 3000)), (None, prose(rng, 40)), (100, "twice"), (100, "twice")]
    got = byte_bpe.round_trip(docs_of(rows, clash), chunk=chunk, overlap=overlap).collect()
    whole, want = tiktoken_encoding(), []
    for i, t in rows:
        ids = np.array(whole.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(blacklist_categories=("Cs", "Cn", "Co")), max_size=60))
def test_packing_ids_are_the_librarys(text):
    encode, whole = _encoders()
    assert encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids
    special = text + "<|endoftext|>" + text
    assert encode(special).tolist() == whole.encode(special, add_special_tokens=False).ids


def _encoders(cache=[]):  # noqa: B006
    if not cache:
        cache.extend([packing.Encoder(), library("byte_bpe_50k.json")])
    return cache


def test_coding_of_an_empty_table(docs_of):
    assert byte_bpe.round_trip(docs_of([])).count() == 0


def check_packed(rows, got, limit):
    lib = library("byte_bpe_50k.json")
    ids = [(i, np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")) for i, t in rows]
    pieces = []
    for i, x in ids:
        first = len(x) % limit or limit
        cuts = [0, *range(first, len(x) + 1, limit)] if len(x) > limit else [0, len(x)]
        pieces += [(i, k, a, b - a, zlib.crc32(x[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=key) == sorted(pieces, key=key)
    used: dict[int, int] = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert all(v <= limit for v in used.values())
    return used


def test_packing_is_gapless_and_near_the_bound(docs_of, rng, clash):
    rows = [(i, t) for i, t in enumerate(HARD) if t is None or len(t) < 30_000]
    rows += [(1000 + i, prose(rng, rng.randint(1, 400))) for i in range(150)] + [(5, "same text")] * 40 + [(None, "no id")]
    got = packing.pack_documents(docs_of(rows, clash), limit=256).collect()
    used = check_packed(rows, got, 256)
    assert len(used) <= -(-sum(used.values()) // 256) * 1.05 + 1
    assert packing.pack_documents(docs_of([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
@example({3: 3, 5: 53, 39: 11})
def test_plan_places_every_rank_once_as_document_best_fit_does(histogram):
    slots = packing.plan(histogram, 64)
    fill: dict[int, list[tuple[int, int]]] = {}
    for length, count in histogram.items():
        own = sorted((s for s in slots if s[0] == length), key=lambda s: s[1])
        assert [s[1] for s in own] == [sum(x[2] for x in own[:i]) for i in range(len(own))]
        assert sum(s[2] for s in own) == count
        for _, _, n, first, offset in own:
            for i in range(first, first + n):
                fill.setdefault(i, []).append((offset, length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    free: list[int] = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            best = min((f for f in free if f >= length), default=None)
            if best is not None:
                free.remove(best)
            free.append((best or 64) - length if best is not None else 64 - length)
    assert len(fill) == len(free)
