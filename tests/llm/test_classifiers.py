from __future__ import annotations

import math
import string
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowcubes.llm import language_id as L
from flowcubes.llm import toxicity as X
from flowcubes.llm.common import sample_by
from llm_helpers import prose

LETTERS = {"aa": "aeioulmnr", "bb": "zxkqwtpbd", "cc": "éèàçùœîô"}


def language_rows(rng, n=240):
    return [(i, prose(rng, rng.randint(5, 60), LETTERS[lang]), lang) for i in range(n) for lang in [rng.choice(list(LETTERS))]]


def test_held_out_accuracy_and_odd_rows(docs_of, rng, clash):
    rows = language_rows(rng)
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !?", "bb"), (None, prose(rng, 30, LETTERS["cc"]), None), (3, rows[3][1], rows[3][2]), (1003, "zxkq " * 20_000, "bb")]
    docs = docs_of(rows + odd, clash)
    profiles = L.learn(docs)
    assert set(profiles) == set(LETTERS) and all(len(p) <= L.PROFILE for p in profiles.values())
    got = L.predict(docs, profiles).collect()
    assert len(got) == len(rows) + len(odd)
    lang = {i: x for i, _, x in rows}
    held = [r for r in got if r.held_out and r.doc_id in lang]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    by = {r.doc_id: r for r in got}
    assert [(by[i].lang_pred, by[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by[None].lang_pred == "cc" and by[None].held_out and by[1003].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got)
    kept = L.keep_known(docs, profiles)
    assert kept.columns == docs.columns and kept.count() == len(rows) + len(odd) - 3


def test_nothing_to_learn_from(docs_of):
    docs = docs_of([(1, "words here", None)])
    assert L.learn(docs) == {}
    assert [tuple(r)[2:] for r in L.predict(docs, {}).collect()] == [("und", 0.0)]
    assert L.predict(docs_of([]), {}).count() == 0 and L.keep_known(docs_of([]), {}).count() == 0


def test_the_distance_is_out_of_place():
    profiles = {"p": ["_a", "ab", "c"], "q": ["zz", "c", "ab"]}
    classify = L.Classifier(profiles, size=3)
    own = [g for g, _ in plain_grams("abc ab").most_common(3)]
    cost = {k: sum(abs(p.index(g) - i) if g in p else 3 for i, g in enumerate(own)) for k, p in profiles.items()}
    best = min(sorted(cost), key=cost.get)
    assert classify("abc ab") == (best, pytest.approx(1 - cost[best] / 9))


def plain_grams(text):
    """n-grams of words of letters, in the order of first occurrence by distinct word."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = Counter()
    for w, times in Counter(words).items():
        p = f"_{w}_"
        for g in (p[i:i + n] for n in (1, 2, 3) for i in range(len(p) - n + 1)):
            if g != "_":
                out[g] += times
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abAB_é½²1 .漢字İß\u0301") | st.characters(blacklist_categories=("Cs",)), max_size=60), st.integers(1, 40), st.sampled_from([2, 96]))
def test_ngrams_of_words(text, block, kinds):
    want = plain_grams(text)
    most, L.MOST_KINDS = L.MOST_KINDS, kinds
    try:
        for size in (1 << 20, block):
            grams = L.text_grams(text, size)
            assert {L.spelled_out(c): n for c, n in zip(grams[0].tolist(), grams[1].tolist())} == want
            assert [L.spelled_out(c) for c in L.ranked(grams, 9).tolist()] == [g for g, _ in want.most_common(9)]
    finally:
        L.MOST_KINDS = most


def test_number_signs_are_no_letters():
    classify = L.Classifier({"p": ["a"], "q": ["b"]})
    assert [classify(t) for t in ("½ ² ①", "Ⅷ ٣", "_ __", "\u0301")] == [("und", 0.0)] * 4
    assert classify("½a²")[0] == "p"


def test_the_languages_learned_are_bounded(docs_of, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGS", 2)
    docs = docs_of([(i, "some text", lang) for i, lang in enumerate(["aa"] * 40 + ["bb"] * 30 + ["cc"] * 5)])
    assert set(L.learn(docs)) == {"aa", "bb"}


def kernel(s, t):
    def features(w):
        out = Counter()
        for i, j, k in combinations(range(len(w)), 3):
            if j - i <= 3 and k - j <= 3:
                out[w[i] + w[j] + w[k]] += X.DECAY ** (k - i + 1)
        return out

    a, b = features(s), features(t)
    norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return sum(x * b[g] for g, x in a.items()) / norm if norm else 0.0


def test_kernel_rows_are_the_gapped_subsequence_kernel(rng):
    marks = ["idiot", "scoundrel", "rascal", "knave"]
    words = ["idiot", "idioot", "idixot", "idiots", "scoundrell", "scowndrel", "knaves", "rascle", "abc", "zzz", "ab"] + prose(rng, 300).split()
    k = X.Kernel(marks)
    for w in words:
        exact = np.array([kernel(w, m) for m in marks])
        exact = np.where(exact >= X.FLOOR, exact, 0.0) ** X.POWER
        want = exact / np.sqrt(1 + exact.sum())
        assert k.rows([w])[0] == pytest.approx(want, abs=1e-9)
    assert k.rows(["idiot idioot fine"])[0][0] > k.rows(["idiot fine"])[0][0] * 0.9
    assert kernel("idiot", "idi-ot") > X.FLOOR and kernel("scoundrel", "scoundxrel") > 0.7


def test_word_forms():
    assert "idiot" in X.words_of("You i d i o t !") and "idiot" in X.words_of("(i.d.i.o.t)") and "idiot" in X.words_of("IDIOT!!!")
    assert X.words_of("  .. a") == set()
    assert all(len(w) <= X.WINDOW for w in X.words_of("q" * 500))


def test_new_words_are_looked_at_as_arrays(rng, monkeypatch):
    k = X.Kernel(["idiot", "scoundrel", "rascal", "knave"])
    monkeypatch.setattr(X, "vectors", None)  # of dicts: for the landmarks only
    text = "you idioot, scoundrell! rascle knaves " + prose(rng, 200)
    found = k.rows([text, None, "", "a ab", text.upper()])
    assert (found[0] > 0).all() and found[1:4].sum() == 0 and (found[0] == found[4]).all()
    assert (k.rows([text])[0] == found[0]).all()


def test_a_word_that_holds_the_null_character():
    k = X.Kernel(["idiot"])
    alone, among = k.rows(["idiots"])[0], X.Kernel(["idiot"]).rows(["ab\0cdef\0g \0\0\0\0 xidiotx", "idiots"])
    assert alone[0] > 0 and among[1] == pytest.approx(alone) and among[0] == pytest.approx(k.rows(["xidiotx"])[0])


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB.'’é  \n\0Σ\u2003\ud800—i"), max_size=90))
def test_forms_are_those_of_the_plain_definition(text):
    bare = text.lower().translate(str.maketrans("", "", string.punctuation + "¡¿«»“”„‘’…–—·•"))
    want = set(bare.split()) | {m.group().replace(" ", "") for m in X.SPACED.finditer(bare)}
    assert X.forms_of(text) == want


def test_training_makes_its_rows_once(docs_of, spark, rng, monkeypatch):
    made, plain = spark.sparkContext.accumulator(0), X.map_batches

    def counted(df, fn, schema):
        def start():
            step = fn()

            def counting(batch):
                made.add(batch.num_rows)
                return step(batch)
            return counting
        return plain(df, start, schema)

    monkeypatch.setattr(X, "map_batches", counted)
    rows, marks = toxic_rows(rng)
    assert X.train(docs_of(rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert made.value == 2 * sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in rows)  # for their words, then their rows


INSULTS = ["scoundrel", "rascal", "numbskull", "blockhead"]


def toxic_rows(rng, n=600):
    rows, marks = [], []
    for i in range(n):
        words, bad = prose(rng, rng.randint(10, 120)).split(), i % 4 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    return rows, marks


def test_held_out_toxicity(docs_of, spark, rng, clash):
    rows, marks = toxic_rows(rng)
    odd = [(5000, None), (5001, ""), (None, "you rascal scoundrel"), (5002, "such a scoun-drel and num.bskull, blockhxead"), (5003, prose(rng, 50)), (3, rows[3][1]), (5004, "word " * 50_000)]
    docs = docs_of(rows + odd, clash)
    labels = spark.createDataFrame([*marks, (None, 1, 1), (5000, 1, None), (77777, 0, 1)], "doc_id long, quality int, toxic int").checkpoint()
    model = X.train(docs, labels)
    got = X.score(docs, model).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: t for i, _, t in marks}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[5002].predicted == 1 and by[None].predicted == 1
    assert [by[i].predicted for i in (5000, 5001, 5003, 5004)] == [0] * 4
    kept = X.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_without_labels_of_both_classes(docs_of, spark):
    docs = docs_of([(1, "some words"), (2, None)])
    none = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert X.train(docs, none) is None
    assert [(r.score, r.predicted) for r in X.score(docs, None).collect()] == [(0.0, 0)] * 2
    assert X.keep_clean(docs, None).count() == 2 and X.score(docs_of([]), None).count() == 0


def test_samples_are_bounded_even_and_repeatable(spark):
    rows = [(i, "many") for i in range(20_000)] + [(i, "few") for i in range(7)] * 3 + [(9, None), (None, "few")]
    df = spark.createDataFrame(rows, "doc_id long, lang string")
    got = [tuple(r) for r in sample_by(df, "lang", 100).collect()]
    assert len(got) == len(set(got)) == 108 and {k for _, k in got} == {"many", "few"}
    assert sorted(got, key=str) == sorted(map(tuple, sample_by(df.repartition(3), "lang", 100).collect()), key=str)
    assert 5_000 < np.mean([i for i, k in got if k == "many"]) < 15_000
    assert sample_by(df.limit(0), "lang", 5).count() == 0
