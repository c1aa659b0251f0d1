"""Phrase collocation mining by partitioning (SON).

The input's tasks are dealt to ``SHARDS`` shards, each of them mined by many
tasks. A shard is mined completely at a local support that is lowered in
proportion to its size: a phrase that occurs ``MIN_COUNT`` times in all reaches
that support in one shard at least. The union of the locally frequent phrases,
less those whose shards together stay below ``MIN_COUNT``, is then counted
globally and exactly, by their texts. The fewer the shards, the higher their
supports, and the fewer phrases are counted in vain.

Mining works on hashes of words and phrases, counted in the tasks and added up
by shard; its union is a set of bits, ``BITS_PER_PHRASE`` a phrase and at most
2 ** ``MOST_BITS``. Phrases that meet by chance in either are counted in vain and
then found to be too few: no count rests on a hash. Tasks find the occurrences of
a phrase by its hash too, but compare their bytes. Phrases of three words are
mined only where both their pairs are in the union. The texts are read four
times, whatever their number: for the sizes of the shards, for words and pairs,
for their counts and triples, and for the counts of these.

Defined results: a null text is an empty one, without words; a null lang is
``und``, together with that lang; nulls in other columns mean nothing, repeated
rows count again; an empty table has no phrases; extra columns are not read. A
very long text is worked on in blocks; one cut within a piece overlaps the next.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowcubes.llm.common import stored
from flowcubes.llm.hashing import mix, spelled

MIN_COUNT = 10
SHARDS = 2
#: A phrase goes if a longer one holds it and has this share (per cent) of its count.
COVERED = 50
TOP = 2_000
UNKNOWN = "und"
BLOCK = 1 << 22
BITS_PER_PHRASE, LEAST_BITS, MOST_BITS = 32, 18, 29
#: Hashes, phrases of single blocks, and bytes of these, that a task holds before it gives them out.
HELD_HASHES, HELD_PHRASES, HELD_BYTES = 1 << 22, 1 << 20, 1 << 25
#: Longer phrases are compared and copied one by one.
LONG = 256

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: A-Z in lower case, all separators of pieces as line feeds, tabs as spaces.
_FOLD = bytes(10 if c in _SEPARATORS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEPS = np.array([0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], "u8")


def folded(texts: list[bytes]) -> bytes:
    """The texts as one, in pieces by lines of words by single spaces."""
    raw = b"\n".join(texts).translate(_FOLD)
    while b"  " in raw:  # each time runs are half as long
        raw = raw.replace(b"  ", b" ")
    return raw


def blocks(raw: bytes, size: int = BLOCK, follow: int = 2) -> Iterator[tuple[bytes, int]]:
    """(block, own): phrases that begin in the first ``own`` bytes belong to the
    block. Blocks end with a piece; in one longer than a block they end with a
    word, and ``follow`` more words follow."""
    at = 0
    while at < len(raw):
        end = at + size
        if end >= len(raw):
            yield raw[at:], len(raw) - at
            return
        cut = raw.rfind(b"\n", at, end)
        if cut >= 0:
            yield raw[at:cut + 1], cut + 1 - at
            at = cut + 1
            continue
        gap = re.compile(b"[ \n]")
        cut = raw.rfind(b" ", at, end)
        if cut < 0:
            found = gap.search(raw, end)
            cut = found.start() if found else len(raw) - 1
        more = cut + 1
        for _ in range(follow):
            if raw[cut:cut + 1] == b"\n":
                break
            found = gap.search(raw, more)
            more = found.end() if found else len(raw)
        yield raw[at:more], cut + 1 - at
        at = cut + 1


class Words(NamedTuple):
    """The words of a block."""

    raw: bytes
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    #: whether a word and the next are of one piece
    joined: np.ndarray
    own: int  # words whose phrases belong to the block

    def places(self, size: int) -> np.ndarray:
        """Places of the phrases of ``size`` words."""
        n = len(self.start) - size + 1
        if n <= 0:
            return np.zeros(0, "i8")
        ok = np.ones(n, bool)
        for i in range(size - 1):
            ok &= self.joined[i:i + n]
        return np.flatnonzero(ok[:self.own])

    def keys(self, places: np.ndarray, size: int, salt: np.uint64) -> np.ndarray:
        total = np.full(len(places), salt, "u8") + np.uint64(size)
        for i in range(size):
            total += self.hash[places + i] * _STEPS[i]
        return mix(total)

    def texts(self, places: np.ndarray, size: int) -> list[bytes]:
        raw = self.raw
        return [raw[a:b] for a, b in zip(self.start[places].tolist(), self.end[places + size - 1].tolist())]


def words_of(raw: bytes, own: int) -> Words | None:
    code = np.frombuffer(raw, "u1")
    line = code == 10
    inside = ~line & (code != 32)
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return None
    piece = np.cumsum(line)[start]
    return Words(raw, start, end, spelled(code[inside], end - start), piece[1:] == piece[:-1], int(np.searchsorted(start, own)))


def salt_of(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


class Bits:
    """A set of hashes as bits: all of its members are in it, and a few others."""

    def __init__(self, bits: int, data: bytes):
        self.mask, self.data = np.uint64((1 << bits) - 1), np.frombuffer(data, "u1")

    def __contains__(self, key: int) -> bool:
        return bool(self.has(np.array([key], "u8"))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys & self.mask
        return (self.data[(slot >> np.uint64(3)).astype("i8")] >> (slot & np.uint64(7)).astype("u1")) & 1 == 1


def bits_of(hashes: DataFrame) -> tuple[int, object]:
    """(size, broadcast bytes) of the set of the column ``h``. Only bits come to
    the driver, 2 ** ``MOST_BITS`` at most."""
    spark = hashes.sparkSession
    n = hashes.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (n * BITS_PER_PHRASE).bit_length()))
    slot = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    per = 1 << 15  # bits of a bitmap of the built-in aggregate
    maps = hashes.select(F.floor(slot / per).cast("int").alias("bucket"), (slot % per).alias("at")).groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("map"))
    data = bytearray(1 << bits - 3)
    for r in maps.toLocalIterator():
        data[r["bucket"] * (per // 8):(r["bucket"] + 1) * (per // 8)] = r["map"]
    return bits, spark.sparkContext.broadcast(bytes(data))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


HASHES = "shard int, h long, n long"
FOUND = "shard int, h long, lang string, words int, phrase binary, n long"


def _over_blocks(rows: DataFrame, begin: Callable[[], Callable[[Words, np.uint64, str], None]], give: Callable[[object, bool], Iterator[dict]], block: int, columns: str) -> DataFrame:
    """For every block of the texts of a task and lang, what ``begin()`` takes
    note of and ``give(noted, at_end)`` gives out, as rows of ``columns``."""
    rows = rows.withColumn("shard", F.spark_partition_id() % SHARDS)
    kind = T.StructType.fromDDL(columns)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        noted, salts, shard = begin(), {}, 0

        def out(at_end: bool) -> Iterator[pa.RecordBatch]:
            for found in give(noted, at_end):
                n = len(found["n"])
                found["shard"] = np.full(n, shard, "i4")
                yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) if f.name in found else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column("shard")[0].as_py()
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                salt = salts.setdefault(lang, salt_of(lang))
                for raw, own in blocks(folded(texts), block):
                    words = words_of(raw, own)
                    if words is not None:
                        noted(words, salt, lang)
                        yield from out(False)
        yield from out(True)

    return rows.mapInArrow(run, kind)


class Hashes:
    """Hashes, counted together before they are given out."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.n = 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(keys)
        self.n += len(keys)

    def given(self, at_end: bool) -> Iterator[dict]:
        if self.parts and (at_end or self.n >= HELD_HASHES):
            h, n = np.unique(np.concatenate(self.parts), return_counts=True)
            self.parts, self.n = [], 0
            for i in range(0, len(h), 1 << 16):
                yield {"h": h[i:i + (1 << 16)].view("i8"), "n": n[i:i + (1 << 16)]}


class Mining:
    """First level: words and pairs, as hashes."""

    def __init__(self) -> None:
        self.hashes = Hashes()

    def __call__(self, words: Words, salt: np.uint64, lang: str) -> None:
        for size in (1, 2):
            self.hashes.add(words.keys(words.places(size), size, salt))

    def given(self, at_end: bool) -> Iterator[dict]:
        return self.hashes.given(at_end)


def alike(raw: bytes, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at a and at b are equal."""
    padded = raw + bytes(8)
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))  # the eight bytes at each place
    same = np.ones(len(a), bool)
    for i in np.flatnonzero(size > LONG).tolist():
        same[i] = raw[a[i]:a[i] + size[i]] == raw[b[i]:b[i] + size[i]]
    at = np.flatnonzero(size <= LONG)
    a, b, size = a[at], b[at], size[at]
    while len(at):
        beyond = np.maximum(8 - size, 0) * 8
        same[at] &= (eight[a] ^ eight[b]) << beyond.astype("u8") == 0
        more = np.flatnonzero(size > 8)
        at, a, b, size = at[more], a[more] + 8, b[more] + 8, size[more] - 8
    return same


def together(raw: bytes, keys: np.ndarray, start: np.ndarray, size: np.ndarray, kind: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, counts): one row for those of the same key, kind and bytes. One
    that only shares the key of another stays for itself."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    first = np.flatnonzero(new)
    rest = np.flatnonzero(~new)
    row, lead = order[rest], order[first[np.cumsum(new)[rest] - 1]]
    same = (size[row] == size[lead]) & (kind[row] == kind[lead])
    same[same] = alike(raw, start[row[same]], start[lead[same]], size[row[same]])
    counts, strays = n[order], row[~same]
    counts[rest[~same]] = 0
    return np.r_[order[first], strays], np.r_[np.add.reduceat(counts, first), n[strays]]


class Phrases:
    """Phrases and their counts, by block and then over the blocks held."""

    def __init__(self) -> None:
        self.langs: dict[str, int] = {}
        self.raw: list[bytes] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.bytes = self.n = 0

    def add(self, lang: str, size: int, words: Words, places: np.ndarray, keys: np.ndarray) -> None:
        if not len(places):
            return
        start = words.start[places]
        length = words.end[places + size - 1] - start
        kind = np.full(len(places), self.langs.setdefault(lang, len(self.langs)) * 4 + size, "i4")
        rows, n = together(words.raw, keys, start, length, kind, np.ones(len(places), "i8"))
        if not self.raw or self.raw[-1] is not words.raw:
            self.raw.append(words.raw)
            self.bytes += len(words.raw)
        self.parts.append((keys[rows], start[rows] + (self.bytes - len(words.raw)), length[rows].astype("i4"), kind[rows], n))
        self.n += len(rows)

    def given(self, at_end: bool) -> Iterator[dict]:
        if not self.parts or not (at_end or self.n >= HELD_PHRASES or self.bytes >= HELD_BYTES):
            return
        raw, langs = b"".join(self.raw), pa.array(list(self.langs), pa.string())
        keys, start, size, kind, n = (np.concatenate(x) for x in zip(*self.parts))
        self.raw, self.parts, self.langs, self.bytes, self.n = [], [], {}, 0, 0
        rows, n = together(raw, keys, start, size, kind, n)
        code = np.frombuffer(raw, "u1")
        for i in range(0, len(rows), 1 << 16):
            part = rows[i:i + (1 << 16)]
            a, length = start[part], size[part].astype("i8")
            ends = np.cumsum(length)
            if ends[-1] > LONG * len(part):
                phrase = pa.array([raw[x:x + y] for x, y in zip(a.tolist(), length.tolist())], pa.binary())
            else:
                text = code[np.arange(ends[-1]) + np.repeat(a - (ends - length), length)]
                phrase = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(np.r_[0, ends].astype("i4")), pa.py_buffer(text)])
            yield {"lang": langs.take(pa.array(kind[part] >> 2)), "words": kind[part] & 3, "phrase": phrase, "n": n[i:i + (1 << 16)]}


class Counting:
    """Exact counts of the phrases of some sizes that are in a set; with
    ``mine``, hashes of the triples both pairs of which are in it."""

    def __init__(self, sizes: tuple[int, ...], bits: Bits, mine: bool, within: Bits | None = None):
        self.sizes, self.bits, self.mine, self.within = sizes, bits, mine, within
        self.hashes, self.phrases, self.totals = Hashes(), Phrases(), Counter()

    def __call__(self, words: Words, salt: np.uint64, lang: str) -> None:
        pairs = None
        for size in self.sizes:
            places = words.places(size)
            if size == 3 and self.within is not None:
                places = self.triples(words, salt, self.within)
            if size == 1:
                self.totals[lang] += len(places)
            keys = words.keys(places, size, salt)
            keep = self.bits.has(keys)
            places, keys = places[keep], keys[keep]
            pairs = places if size == 2 else pairs
            self.phrases.add(lang, size, words, places, keys)
        if self.mine:
            places = self.followed(pairs, words)
            self.hashes.add(words.keys(places, 3, salt))

    @staticmethod
    def followed(pairs: np.ndarray, words: Words) -> np.ndarray:
        """Places of triples whose pairs are both among the given places; the
        second one of the block's last word is tested as if it were."""
        member = np.zeros(len(words.start) + 1, bool)
        member[pairs] = True
        if words.own < len(words.joined):
            member[words.own] = words.joined[words.own]
        return pairs[member[pairs + 1]]

    def triples(self, words: Words, salt: np.uint64, within: Bits) -> np.ndarray:
        places = words.places(2)
        return self.followed(places[within.has(words.keys(places, 2, salt))], words)

    def given(self, at_end: bool) -> Iterator[dict]:
        if self.totals and at_end:
            n = len(self.totals)
            yield {"lang": list(self.totals), "words": [0] * n, "phrase": [b""] * n, "n": list(self.totals.values())}
        yield from self.phrases.given(at_end)
        yield from self.hashes.given(at_end)


def _frequent(found: DataFrame, support: dict[int, int], min_count: int) -> DataFrame:
    """Hashes that reach the local support in a shard, and ``min_count`` in all:
    phrases that share a hash add to it, and so none that is frequent is lost."""
    by_shard = [F.sum(F.when(F.col("shard") == s, F.col("n")).otherwise(0)) for s in support]
    sums = found.groupBy("h").agg(*(n.alias(f"n{s}") for s, n in zip(support, by_shard)))
    local = reduce(lambda x, y: x | y, (F.col(f"n{s}") >= least for s, least in support.items()))
    return sums.where(local & (reduce(lambda x, y: x + y, (F.col(f"n{s}") for s in support)) >= min_count)).select("h")


def local_support(docs: DataFrame, min_count: int) -> dict[int, int]:
    """Of each shard, ``min_count`` lowered by its share of the bytes. The shares
    sum to one, and so a phrase that stays below in every shard has fewer than
    ``min_count`` in all, in whatever way the tasks are dealt out later."""
    sizes = _rows(docs).groupBy((F.spark_partition_id() % SHARDS).alias("shard")).agg(F.sum(F.octet_length("text")).alias("n")).collect()
    size = {r["shard"]: r["n"] for r in sizes}
    total = max(1, sum(size.values()))
    return {s: max(1, -(-min_count * size.get(s, 0) // total)) for s in range(SHARDS)}


def counted(docs: DataFrame, min_count: int = MIN_COUNT, block: int = BLOCK) -> DataFrame:
    """(lang, words, phrase, n): exact counts of the phrases of 2 and 3 words that
    reach ``min_count``, of the words and pairs these are made of, and, with 0
    words, of all words of a lang."""
    rows, support = _rows(docs), local_support(docs, min_count)

    def level(begin: Callable[[], object], columns: str) -> DataFrame:
        return _over_blocks(rows, begin, lambda noted, at_end: noted.given(at_end), block, columns)

    bits, data = bits_of(stored(_frequent(level(Mining, HASHES), support, min_count), "pairs"))
    second = stored(level(lambda: Counting((1, 2), Bits(bits, data.value), True), FOUND), "counts")
    bits3, data3 = bits_of(stored(_frequent(second.where("h is not null"), support, min_count), "triples"))
    third = level(lambda: Counting((3,), Bits(bits3, data3.value), False, Bits(bits, data.value)), FOUND)
    every = second.where("h is null").unionByName(third).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    every = every.where((F.col("words") < 2) | (F.col("n") >= min_count))
    return stored(every.select("lang", "words", F.col("phrase").cast("string").alias("phrase"), "n"), "phrases")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, covered: int = COVERED, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each lang."""
    counts = counted(docs, min_count, block)
    found = counts.where("words >= 2").select("lang", "words", "phrase", F.col("n").alias("a"))
    parts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    parts = parts.select("*", F.expr("substring_index(phrase, ' ', k)").alias("first"), F.expr("substring_index(phrase, ' ', k - words)").alias("rest"))
    for part, name in (("first", "l"), ("rest", "r")):
        own = counts.where("words between 1 and 2").select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
        parts = parts.join(own, ["lang", part])
    wide = "cast({} as decimal(19, 0))".format  # products of 38 digits; beyond them it raises
    parts = parts.withColumn("score", F.expr(f"({wide('a')} * {wide('a')} * 1000000) div ({wide('l')} * {wide('r')})"))
    scored = parts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "words")).alias("s")).select("lang", "phrase", "s.*")
    # the pairs in each triple, with the largest count of the triples around them
    pair = F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2))).alias("phrase")
    around = found.where("words = 3").select("lang", "a", pair).groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(f"around is null or 100 * around < {covered} * a")
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    n = counts.where("words = 0").select("lang", "n")
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


#: The same rows in DuckDB, whose HUGEINT holds the products.
TWIN = f"""
WITH piece AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), spoken AS (
    SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS w FROM piece
), gram AS (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM spoken, (VALUES (1), (2), (3)) sizes(size) WHERE len(w) >= size
), f AS (
    SELECT lang, size, phrase, count(*)::HUGEINT AS a FROM gram GROUP BY ALL
), total AS (
    SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), candidate AS (
    SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= {MIN_COUNT}
), cut AS (
    SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate)
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, c.k, (1000000 * c.a * c.a) // (x.a * y.a) AS score
    FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), within AS (
    SELECT lang, phrase, max(a) AS around
    FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidate WHERE size = 3) GROUP BY ALL
), ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM scored s LEFT JOIN within w USING (lang, phrase) WHERE w.around IS NULL OR 100 * w.around < {COVERED} * s.a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""
