"""Toxicity by a subsequence string-kernel support vector machine.

Two words are alike by the three-letter subsequences that they share, where up
to two other characters may stand between two letters and every character that
a subsequence spans costs a factor; so an insult stays near itself with
characters put in or left out. Landmarks are words that mark toxic labels.
A power of the kernels of a text's words with the landmarks, summed and scaled by
the root of their total, is its row; multiplied with the inverse root of the landmarks' own kernel matrix
(Nyström) they are the features of a linear support vector machine, whose
margins a sigmoid turns into scores.

The machine is trained on at most ``SAMPLE_DOCS`` labelled documents of each
class, those of least hash of the id.

Defined results: a null or empty text scores as one in which no word is near a
landmark; without labels of both classes every score is 0; a null label is not
learned from; a null id is held out; a document with several labels is learned
from with each; repeated rows give equal rows; an empty table gives an empty
result; `score` reads no other columns, and `keep_clean` keeps them.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowcubes.llm.common import held_out, map_batches, map_whole, sample_by

FOLDS, HELD_FOLD = 4, 2
SAMPLE_DOCS = 4_000
THRESHOLD = 0.3
LANDMARKS = 160
#: Landmark candidates: words in so many toxic documents of the sample, and so many words.
MIN_DOCS, CANDIDATES = 3, 3_000
#: No two landmarks have a larger kernel.
ALIKE = 0.95
DECAY = 0.8
GAPS = [(a, b) for a in (1, 2, 3) for b in (1, 2, 3)]  # steps to the second and third letter
#: Normalised kernels below this are taken as 0; the others are raised to the power.
FLOOR, POWER = 0.45, 4
#: What is known of words is forgotten when there are so many.
MEMO_WORDS = 400_000
#: Longer words are cut into overlapping windows of so many characters.
WINDOW = 32
WORDS_AT_ONCE = 1_000
PUNCTUATION, OTHER_PUNCTUATION = string.punctuation.encode(), "¡¿«»“”„‘’…–—·•"
SPACED = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")
#: The end of any of these: found faster.
SPACED_END = re.compile(r" \S \S(?!\S)")


def forms_of(text: str) -> set[str]:
    """Lower-cased words of any length, without punctuation at their ends or
    inside; single characters in a row make one word too."""
    bare = text.lower().encode("utf-8", "surrogatepass").translate(None, PUNCTUATION).decode("utf-8", "surrogatepass")
    if not bare.isascii():
        for c in OTHER_PUNCTUATION:
            bare = bare.replace(c, "")
    every = set(bare.split())
    if SPACED_END.search(bare):
        every.update(m.group().replace(" ", "") for m in SPACED.finditer(bare))
    return every


def windows(word: str) -> list[str]:
    return [word[i:i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


def words_of(text: str) -> set[str]:
    """The forms of three characters or more; long ones are cut into overlapping
    windows."""
    every = forms_of(text)
    found = {w for w in every if 3 <= len(w) <= WINDOW}
    for w in every:
        if len(w) > WINDOW:
            found.update(windows(w))
    return found


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters as 1 to 63 (0 ends a word), and the word of each."""
    joined = "\0".join(words)
    if joined.count("\0") >= max(1, len(words)):  # words that hold this character themselves
        joined = "\0".join(w.replace("\0", "\1") for w in words)
    raw = np.frombuffer((joined + "\0\0\0\0\0\0\0").encode("utf-32-le", "surrogatepass"), "<u4").astype("i8")
    code = np.where((raw >= 97) & (raw <= 122), raw - 96, 27 + raw % 37)
    code[raw == 0] = 0
    return code, np.cumsum(raw == 0)


def _subsequences(words: list[str]):
    """(word, subsequence, weight) for each pair of steps, as arrays."""
    code, word = _codes(words)
    n = len(code) - 6
    for a, b in GAPS:
        inside = np.flatnonzero((code[:n] > 0) & (word[:n] == word[a + b:n + a + b]) & (code[a:n + a] > 0) & (code[a + b:n + a + b] > 0))
        yield word[inside], (code[inside] << 12) + (code[inside + a] << 6) + code[inside + a + b], DECAY ** (a + b + 1)


def vectors(words: list[str]) -> list[dict[int, float]]:
    """Each word's subsequences and their summed weights."""
    out: list[dict[int, float]] = [{} for _ in words]
    for word, sub, weight in _subsequences(words):
        for w, s in zip(word.tolist(), sub.tolist()):
            out[w][s] = out[w].get(s, 0.0) + weight
    return out


class Kernel:
    """Kernels of words with the landmarks: the normalised subsequence kernel,
    raised to ``POWER``."""

    def __init__(self, landmarks: list[str]):
        own = vectors(landmarks)
        subs = sorted({s for v in own for s in v})
        at = {s: i for i, s in enumerate(subs)}
        self.weights = np.zeros((len(subs), len(landmarks)))
        for j, v in enumerate(own):
            norm = np.sqrt(sum(x * x for x in v.values())) or 1.0
            for s, x in v.items():
                self.weights[at[s], j] = x / norm
        self.gram = (self.weights.T @ self.weights) ** POWER
        #: of each subsequence, where its landmarks and their weights begin, and how many there are
        i, self.marks = np.nonzero(self.weights)
        self.values = self.weights[i, self.marks]
        self.first, self.many = np.zeros(1 << 18, "i8"), np.zeros(1 << 18, "i8")
        self.many[subs] = np.bincount(i, minlength=len(subs))
        self.first[subs] = np.cumsum(self.many[subs]) - self.many[subs]
        self.cold: set[str] = set()
        self.warm: dict[str, np.ndarray] = {}

    def _add(self, words: list[str]) -> None:
        """Finds the rows of words not seen yet."""
        n = self.weights.shape[1]
        parts = list(_subsequences(words))
        word, sub = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        weight = np.repeat([p[2] for p in parts], [len(p[0]) for p in parts])
        # each with the landmarks that have it
        many = self.many[sub]
        ends = np.cumsum(many)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[sub] - (ends - many), many)
        dots = np.bincount(np.repeat(word * n, many) + self.marks[place], np.repeat(weight, many) * self.values[place], len(words) * n).reshape(-1, n)
        least = np.bincount(word, weight * weight, len(words))  # of the squared norm
        near = dots.max(1) >= FLOOR * np.sqrt(least) * (1 - 1e-9)
        own = near[word]
        word, sub, weight = word[own], sub[own], weight[own]
        key = (word << 18) + sub
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        if not len(first):
            return
        squared = np.bincount(key[first] >> 18, np.add.reduceat(weight, first) ** 2, len(words))
        at = np.flatnonzero(near & (squared > 0))
        rows = dots[at] / np.sqrt(squared[at])[:, None]
        for i, row in zip(at.tolist(), np.where(rows >= FLOOR, rows, 0.0) ** POWER):
            if row.any():
                self.warm[words[i]] = row

    def rows(self, texts: list[str | None]) -> np.ndarray:
        """For each text the summed kernels of its words with each landmark,
        over the root of one and all of them."""
        if len(self.cold) + len(self.warm) > MEMO_WORDS:
            self.cold, self.warm = set(), {}
        words = []
        for t in texts:
            own = forms_of(t) - self.cold if t else set()
            for w in [w for w in own if len(w) > WINDOW]:
                own.remove(w)
                own.update(windows(w))
            words.append(own)
        every = set().union(*words).difference(self.cold, self.warm)
        new = [w for w in every if len(w) >= 3]
        for i in range(0, len(new), WORDS_AT_ONCE):
            self._add(new[i:i + WORDS_AT_ONCE])
        self.cold.update(every.difference(self.warm))
        out = np.zeros((len(texts), self.weights.shape[1]))
        for i, own in enumerate(words):
            if hot := sorted(own & self.warm.keys()):
                total = np.sum([self.warm[w] for w in hot], axis=0)
                out[i] = total / np.sqrt(1 + total.sum())
        return out


@dataclass
class Model:
    landmarks: list[str]
    root: np.ndarray  # the Nyström map
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        margin = rows @ self.root @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps; y is -1 or 1
    and both classes weigh alike."""
    x = np.c_[x, np.ones(len(x))]
    cost = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum())) * c / len(y)
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w)) * 1e-3
    for _ in range(rounds):
        short = 1 - y * (x @ w)
        on = short > 0
        slope = 1e-3 * w - 2 * ((cost * y * short)[on] @ x[on])
        step = np.linalg.solve(ridge + 2 * (x[on] * cost[on, None]).T @ x[on], slope)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _sigmoid(margin: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and shift of the sigmoid for margins, with targets drawn in a
    little from 0 and 1."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, w = np.c_[margin, np.ones(len(margin))], np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _landmarks(found: list[tuple[str, float]], n: int) -> list[str]:
    """Words of highest weight, none much like a chosen one."""
    own = vectors([w for w, _ in found])
    norms = [np.sqrt(sum(x * x for x in v.values())) for v in own]
    chosen: list[int] = []
    for i, v in enumerate(own):
        if norms[i] and all(sum(x * own[j].get(s, 0.0) for s, x in v.items()) < ALIKE * norms[i] * norms[j] for j in chosen):
            chosen.append(i)
            if len(chosen) == n:
                break
    return [found[i][0] for i in chosen]


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """The machine, from a bounded sample of labelled documents; None if it
    does not hold both classes."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    marks = marks.where(~held_out("doc_id", FOLDS, HELD_FOLD)).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    marks = marks.join(texts.select("doc_id"), "doc_id", "left_semi")
    sample = texts.join(sample_by(marks, "toxic", sample_docs), "doc_id").repartition(16).persist()
    try:
        sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        if not (sizes.get(0) and sizes.get(1)):
            return None

        def start():
            def step(batch: pa.RecordBatch) -> dict:
                seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
                for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                    seen[toxic].update(words_of(text))
                every = list(seen[0].keys() | seen[1].keys())
                return {"word": every, "clean": [seen[0][w] for w in every], "bad": [seen[1][w] for w in every]}
            return step

        words = map_batches(sample.select("toxic", "text"), start, "word string, clean long, bad long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
        p, q = F.col("bad") / sizes[1], F.col("clean") / sizes[0]
        both = (F.col("bad") + F.col("clean")) / (sizes[0] + sizes[1])
        weight = (p - q) / F.sqrt(both * (1 - both) + 1e-9)
        found = words.where(F.col("bad") >= MIN_DOCS).select("word", weight.alias("weight")).orderBy(F.desc("weight"), "word").limit(CANDIDATES).collect()
        landmarks = _landmarks([(r["word"], r["weight"]) for r in found if r["weight"] > 0], LANDMARKS)
        if not landmarks:
            return None

        def rows():
            kernel = Kernel(landmarks)
            return lambda b: {"doc_id": b.column("doc_id"), "toxic": b.column("toxic"), "row": list(kernel.rows(b.column("text").to_pylist()))}

        data = map_batches(sample.select("doc_id", "toxic", "text"), rows, "doc_id long, toxic int, row array<double>").collect()
    finally:
        sample.unpersist()
    data.sort()  # here: orderBy would make the rows twice, once for its ranges
    values, vecs = np.linalg.eigh(Kernel(landmarks).gram)
    root = (vecs / np.sqrt(np.maximum(values, 1e-3))) @ vecs.T
    x, y = np.array([r["row"] for r in data]), np.array([1.0 if r["toxic"] else -1.0 for r in data])
    weights, bias = _svm(x @ root, y)
    slope, shift = _sigmoid(x @ root @ weights + bias, y)
    return Model(landmarks, root, weights, bias, slope, shift)


def _scorer(model: Model | None):
    if model is None:
        return lambda texts: np.zeros(len(texts))
    kernel = Kernel(model.landmarks)
    return lambda texts: model.scores(kernel.rows(texts))


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    def start():
        scores = _scorer(model)

        def step(batch: pa.RecordBatch) -> dict:
            found = scores(batch.column("text").to_pylist())
            return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": found, "predicted": (found >= threshold).astype("i4")}
        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", FOLDS, HELD_FOLD).alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, start, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that score below the threshold."""
    at = docs.columns.index("text")

    def start():
        scores = _scorer(model)
        return lambda batch: batch.filter(pa.array(scores(batch.column(at).to_pylist()) < threshold))

    return map_whole(docs, start)
