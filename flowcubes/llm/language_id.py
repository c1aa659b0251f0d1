"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent character n-grams (1 to 3
letters of words with a mark at either end), most frequent first. A text's own
list is compared to each profile: every n-gram costs the distance between its
two ranks, or the length of the profile if it is not there. The language of
least total cost is the prediction.

Profiles are learned from at most ``SAMPLE_DOCS`` documents of each language,
those of least hash of the id among the rows that may be learned from, and of
the ``MAX_LANGS`` languages with the most rows. A letter is what Unicode calls
one; number signs and marks divide words.

Defined results: ``und`` and score 0 for a null text and one without a letter,
and for every text if there is nothing to learn from; ties go to the language
that sorts first; rows with a null lang are predicted but not learned from;
a null id is held out; repeated rows give equal rows; an empty table gives an
empty result; `predict` reads no other columns, and `keep_known` keeps them.
"""

from __future__ import annotations

from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowcubes.llm.common import held_out, map_batches, map_whole, sample_by

FOLDS, HELD_FOLD = 5, 0
SAMPLE_DOCS = 2_000
PROFILE = 400
SIZES = (1, 2, 3)
UNKNOWN = "und"
#: A prediction of lower score is no known language: `keep_known` rejects it.
MIN_SCORE = 0.02
MARK = ord("_")  # at either end of a word
#: Letters of a block whose n-grams are counted in tables of all that are possible.
MOST_KINDS = 96
BLOCK = 1 << 20
#: Languages learned: those with the most rows.
MAX_LANGS = 256

Profiles = dict[str, list[str]]


@cache
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def packed(gram: str) -> int:
    """The code points of an n-gram in 21 bits each."""
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def spelled_out(code: int) -> str:
    return "".join(chr(code >> s & 0x1FFFFF) for s in (42, 21, 0) if code >> s & 0x1FFFFF)


def block_grams(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed n-grams, counts, places) of a block of code points. Places give the
    order of first occurrence: by word, then size, then place in the word."""
    letter = letter_table()[code]
    after = np.r_[False, letter[:-1]]
    kept = letter | after  # letters, and one mark after each word
    seq = np.r_[MARK, np.where(letter, code, MARK)[kept]].astype("i8")
    if letter[-1]:
        seq = np.r_[seq, MARK]
    if len(seq) < 3:
        return (np.zeros(0, "i8"),) * 3
    mark = seq == MARK
    marks = np.flatnonzero(mark)
    # the letters of this block as small numbers
    low = seq.min()
    if seq.max() - low < 1 << 16:
        there = np.bincount(seq - low) > 0
        own, kinds = (np.cumsum(there) - 1)[seq - low], int(there.sum())
    else:
        values, own = np.unique(seq, return_inverse=True)
        kinds = len(values)
    dense = kinds <= MOST_KINDS
    codes, counts, places = [], [], []
    for n in SIZES:
        at = np.arange(len(seq) - n + 1)
        if n == 1:
            at = at[~mark]
        elif n == 3:
            at = at[~mark[1:-1]]
        number, full = np.zeros(len(at), "i8"), np.zeros(len(at), "i8")
        for i in range(n):
            number = number * kinds + own[at + i] if dense else number
            full = full << 21 | seq[at + i]
        if dense:
            tally = np.bincount(number, minlength=kinds**n)
            first = np.empty(kinds**n, "i8")
            first[number[::-1]] = np.arange(len(at))[::-1]  # of equal ones the last write stays: the first place
            found = np.flatnonzero(tally)
            count, first = tally[found], first[found]
        else:
            _, first, count = np.unique(full, return_index=True, return_counts=True)
        codes.append(full[first])
        counts.append(count)
        place = at[first]
        word = np.searchsorted(marks, place, "right") - 1
        start = marks[word]
        places.append(2 * start + (n - 1) * (marks[word + 1] - start + 1) + place)
    return np.concatenate(codes), np.concatenate(counts), np.concatenate(places)


def text_grams(text: str, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`block_grams` of a whole text; a long one is read in blocks that end with a word."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    parts, at = [], 0
    while at < len(code):
        end = at + block
        while end < len(code) and letter_table()[code[end - 1]]:
            end += 1
        found = block_grams(code[at:end])
        parts.append((*found[:2], found[2] + 4 * at))
        at = end
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return (np.zeros(0, "i8"),) * 3
    codes, counts, places = (np.concatenate(c) for c in zip(*parts))
    every, first, own = np.unique(codes, return_index=True, return_inverse=True)  # the first one is of the first block
    return every, np.bincount(own, counts, len(every)).astype("i8"), places[first]


def ranked(grams: tuple[np.ndarray, np.ndarray, np.ndarray], size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, packed; equal counts in the order of first occurrence."""
    codes, counts, places = grams
    if not len(codes):
        return codes
    key = (counts.max() - counts) * (places.max() + 1) + places
    if len(key) > size:
        least = np.argpartition(key, size)[:size]
        return codes[least[np.argsort(key[least])]]
    return codes[np.argsort(key)]


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, size: int = PROFILE) -> Profiles:
    """Profiles from rows that are not held out and have a lang. Only these
    lists (``size`` n-grams a language) come to the driver."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null").where(~held_out("doc_id", FOLDS, HELD_FOLD))
    sample = rows.join(sample_by(rows, "lang", sample_docs, MAX_LANGS), ["doc_id", "lang"], "left_semi")

    def start():
        def step(batch: pa.RecordBatch) -> dict:
            counts: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                codes, own, _ = text_grams(text)
                for g, n in zip(codes.tolist(), own.tolist()):
                    counts[lang, g] += n
            return {"lang": [k[0] for k in counts], "gram": [spelled_out(k[1]) for k in counts], "n": list(counts.values())}
        return step

    counts = map_batches(sample.select("lang", "text"), start, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).where(F.col("place") <= size).orderBy("lang", "place").collect()
    out: Profiles = {}
    for r in top:
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Classifier:
    def __init__(self, profiles: Profiles, size: int = PROFILE):
        self.size, self.langs = size, sorted(profiles)
        every = sorted({packed(g) for p in profiles.values() for g in p})
        at = {g: i for i, g in enumerate(every)}
        self.codes = np.array([*every, 1 << 62], "i8")
        #: rank of each n-gram in each profile; -1 if it is not there (the last row: in none)
        self.ranks = np.full((len(every) + 1, len(self.langs)), -1, "i4")
        for j, lang in enumerate(self.langs):
            for r, g in enumerate(profiles[lang]):
                self.ranks[at[packed(g)], j] = r

    def __call__(self, text: str | None) -> tuple[str, float]:
        """(language, how near its profile is: 1 for the same list, 0 for
        nothing in common)."""
        own = ranked(text_grams(text), self.size) if text and self.langs else ()
        if not len(own):
            return UNKNOWN, 0.0
        row = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        theirs = self.ranks[np.where(self.codes[row] == own, row, len(self.codes) - 1)]
        cost = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(len(own))[:, None])).sum(0)
        best = int(cost.argmin())
        return self.langs[best], float(1 - cost[best] / (self.size * len(own)))


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    def start():
        classify = Classifier(profiles)

        def step(batch: pa.RecordBatch) -> dict:
            found = [classify(t) for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}
        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", FOLDS, HELD_FOLD).alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, start, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, profiles: Profiles, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows, with all their columns, whose text is in a known language."""
    at = docs.columns.index("text")

    def start():
        classify = Classifier(profiles)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [classify(t) for t in batch.column(at).to_pylist()]
            return batch.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in found]))
        return step

    return map_whole(docs, start)
