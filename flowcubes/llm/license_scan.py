"""Licence scan by a positional index of rare words.

Licence templates are word sequences with mandatory key phrases. The document
frequency of every template word is counted over all documents; the index holds,
for the rarest (highest-IDF) words of each key phrase, where they stand in it. A
file's own licence words are looked up from its rarest on: each occurrence and
posting give the place where the phrase would begin, the places that all indexed
words of a phrase agree on are kept, and there the phrase is verified word by
word. A template counts where all its key phrases stand in order, within its
length and half as much again; its score is the share of its IDF weight that
stands at the right distance.

Since a phrase is only looked for from words that it cannot do without, every
place of every key phrase is found, however common its other words are.

Defined results: a null text is an empty one, without words; a null id is passed
through; repeated rows give equal rows; an empty table gives an empty result;
extra columns are not read. Words that no document holds count as held by one.
Texts are cut into blocks between words, so that a very long text costs its
licence words and one block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowcubes.llm.common import map_batches

#: Letters A-Z in lower case; all other ASCII but digits and a-z divides words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Words of a key phrase that the index holds.
RARE = 2
BLOCK_BYTES = 1 << 20


class Template(NamedTuple):
    label: str
    text: str
    #: phrases of the text that must stand; the whole text if there are none
    keys: tuple[str, ...] = ()


#: The phrases whose places are counted, and their labels.
BASE = (
    Template("mit", "under the mit license"),
    Template("apache-2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc"),
)
#: Notices and openings of common licences.
TEMPLATES = (
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("apache-2", "you may not use this file except in compliance with the license", ("file except in compliance with the license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms", "provided that the following conditions are met")),
    Template("cc-by", "creative commons attribution 4 0 international"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc0", "cc0 1 0 universal"),
    Template("epl-2", "eclipse public license v 2 0"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify and or distribute", "with or without fee is hereby granted")),
    Template("lgpl-3", "gnu lesser general public license version 3"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
             ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    Template("mpl-2", "mozilla public license version 2"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


def blocks(raw: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, in blocks of about ``size`` bytes cut between words."""
    at = 0
    while at < len(raw):
        part = raw[at:at + size].translate(FOLD)
        if at + size < len(raw):
            cut, grown = part.rfind(b" "), size
            while cut < 0 and at + grown < len(raw):
                grown *= 2
                part = raw[at:at + grown].translate(FOLD)
                cut = part.rfind(b" ")
            if cut >= 0 and at + len(part) < len(raw):
                part = part[:cut + 1]
        at += len(part)
        yield part.split()


def spoken(text: str) -> list[bytes]:
    return [w for part in blocks(text.encode()) for w in part]


class Index:
    """Postings of the rarest words of every key phrase of the templates."""

    def __init__(self, templates: tuple[Template, ...], held_by: dict[bytes, int], documents: int):
        self.templates = templates
        self.words = [spoken(t.text) for t in templates]
        self.idf = {w: math.log((documents + 1) / max(1, held_by.get(w, 0))) + 1e-9 for own in self.words for w in own}
        self.phrases: list[tuple[int, int, list[bytes]]] = []  # (template, place in it, words)
        self.of: list[list[int]] = []  # phrases of each template
        #: word -> (phrase, place of the word in the phrase)
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.indexed: list[int] = []  # how many words of each phrase the index holds
        for t, template in enumerate(templates):
            self.of.append([])
            for key in template.keys or (template.text,):
                words = spoken(key)
                place = next(i for i in range(len(self.words[t])) if self.words[t][i:i + len(words)] == words)
                phrase = len(self.phrases)
                self.phrases.append((t, place, words))
                self.of[t].append(phrase)
                rare = sorted(set(words), key=lambda w: (-self.idf[w], w))[:RARE]
                for w in rare:
                    self.postings.setdefault(w, []).append((phrase, words.index(w)))
                self.indexed.append(len(rare))
        self.weight = [sum(self.idf[w] for w in own) for own in self.words]

    def places(self, spots: dict[int, bytes]) -> list[list[int]]:
        """Where each key phrase stands in a file, given its licence words by place."""
        occurrences: dict[bytes, list[int]] = {}
        for place, word in spots.items():
            if word in self.postings:
                occurrences.setdefault(word, []).append(place)
        starts: dict[int, set[int]] = {}
        seen = [0] * len(self.phrases)
        for word in sorted(occurrences, key=lambda w: (-self.idf[w], w)):
            for phrase, q in self.postings[word]:
                if seen[phrase] and not starts[phrase]:
                    continue
                # a word that the phrase holds twice is indexed at its first place
                here = {p - q for p in occurrences[word]}
                starts[phrase] = starts[phrase] & here if seen[phrase] else here
                seen[phrase] += 1
        found: list[list[int]] = [[] for _ in self.phrases]
        for phrase, at in starts.items():
            if seen[phrase] == self.indexed[phrase]:
                words = self.phrases[phrase][2]
                found[phrase] = sorted(p for p in at if all(spots.get(p + i) == w for i, w in enumerate(words)))
        return found

    def covered(self, template: int, start: int, spots: dict[int, bytes]) -> float:
        """Share of a template's weight that stands at its place from ``start``."""
        own = self.words[template]
        return min(1.0, sum(self.idf[w] for i, w in enumerate(own) if spots.get(start + i) == w) / self.weight[template])

    def accepted(self, found: list[list[int]], spots: dict[int, bytes]) -> dict[int, float]:
        """Templates all of whose key phrases stand in order near one another, and
        their best score."""
        out: dict[int, float] = {}
        for t, own in enumerate(self.of):
            if not all(found[p] for p in own):
                continue
            first = self.phrases[own[0]]
            for start in found[own[0]]:
                at, end = start, start + len(self.words[t]) * 3 // 2
                for p in own[1:]:
                    at = next((x for x in found[p] if at < x <= end), None)
                    if at is None:
                        break
                if at is not None:
                    out[t] = max(out.get(t, 0.0), self.covered(t, start - first[1], spots))
        return out


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def learn(docs: DataFrame, templates: tuple[Template, ...] = BASE + TEMPLATES) -> Index:
    """The index, with document frequencies over all documents. Only the counts
    of template words come to the driver."""
    vocabulary = frozenset(w for t in templates for w in spoken(t.text))

    def start():
        def step(batch: pa.RecordBatch) -> dict:
            held: dict[bytes, int] = {}
            for text in batch.column("text").to_pylist():
                own: set[bytes] = set()
                for words in blocks(text):
                    own |= vocabulary.intersection(words)
                for w in own:
                    held[w] = held.get(w, 0) + 1
            return {"word": [*held, None], "n": [*held.values(), batch.num_rows]}
        return step

    counts = map_batches(_rows(docs).select("text"), start, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    held_by = {None if r["word"] is None else bytes(r["word"]): r["n"] for r in counts}
    return Index(templates, held_by, held_by.pop(None, 0))


def scan(docs: DataFrame, index: Index, base: int = len(BASE)) -> DataFrame:
    """Per document: its words, the places of the first ``base`` templates, and
    the labels of all templates found."""
    vocabulary = frozenset(index.idf)

    def start():
        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
            for text in batch.column("text").to_pylist():
                n, spots = 0, {}
                for words in blocks(text):
                    if not vocabulary.isdisjoint(words):
                        spots.update((i, w) for i, w in enumerate(words, n) if w in vocabulary)
                    n += len(words)
                found = index.places(spots)
                scores = index.accepted(found, spots)
                places = [p for t in range(base) for phrase in index.of[t] for p in found[phrase]]
                labels = {index.templates[t].label for t in scores}
                out["n_words"].append(n)
                out["n_base"].append(len(places))
                out["first_word"].append(min(places, default=None))
                out["last_word"].append(max(places, default=None))
                out["base_labels"].append(",".join(sorted({index.templates[t].label for t in scores if t < base})))
                out["labels"].append(",".join(sorted(labels)))
                out["score"].append(max(scores.values(), default=0.0))
            return {"doc_id": batch.column("doc_id")} | out
        return step

    return map_batches(_rows(docs), start, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
