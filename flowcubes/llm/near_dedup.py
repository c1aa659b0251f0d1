"""Near-duplicate documents by Order MinHash and banded alignment.

A document is its sequence of five-word shingles, each labelled with how often
it has occurred before. For each of ``SKETCHES`` hash functions the five least
labelled shingles are sampled and kept in text order, in short texts the four or
three least (``ORDERS``); documents with an equal sample share a bucket.
Documents of equal words are one class, and only one of each takes part.

Two documents of a bucket are verified by aligning their labelled shingles
within the band that the threshold allows: with ``m`` aligned shingles of
``a`` and ``b``, their similarity is m / (a + b - m), and 0.8 or more links
them. A pair of that similarity, of any length, shares a bucket with a
probability of more than 0.9999.

In a bucket, first every member is compared with one pivot; members that are
then connected need no more comparison. A second round takes other pivots.
In buckets with members that are still apart, all of them are compared: tasks
take blocks of such a bucket, count what each two documents share, and align
those that may reach the threshold. So a large group of copies costs a few
comparisons a member, no pairs are listed, and no link between groups is lost.

Defined results: a null text is an empty one; texts without words are equal,
and so copies; a text of fewer than five words is one shingle; one document of
a group stays, that of least doc_id (a null id is the largest, among equal ids
the first row stays); an empty table gives an empty result; extra columns are
not read by `classes` and are kept by `keep_one`. The input is read once; its
numbered rows are written to the shared folder, and read from there after that.
Only the texts of documents that share a bucket are shuffled, compressed.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowcubes.llm.common import components, cut, map_batches, map_groups, stored
from flowcubes.llm.hashing import ROOT, mix, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 24
#: (shingles in a sample, least and most shingles of the texts that have such
#: samples). A pair with m aligned of u shingles agrees in a sample of k with a
#: probability of C(m, k) / C(u, k) or more, which is too little for k = 5 below
#: u = 95 and for k = 4 at u = 5; with m >= 0.8 u both texts have 0.8 u to u
#: shingles, so the ranges overlap. Texts of fewer than 4 have only equals.
ORDERS = ((3, 4, 5), (4, 5, 94), (5, 76, None))
PIVOT_ROUNDS = 2
#: Members of a bucket that one task compares with one another, the shingles that
#: these may have, and shingles that it counts at a time.
BLOCK, BLOCK_SHINGLES, COLUMNS = 1024, 2_000_000, 8192
#: Texts that are compared pass through the shuffles compressed at this level.
PACK_LEVEL = 1
SEED = 8_675_309

_STEPS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], "u8")
_SEEDS = np.random.default_rng(SEED).integers(1, 2**63, SKETCHES, "u8")


def shingles(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, labelled shingles) in text order; labelled ones are distinct."""
    if not words:
        return np.zeros(0, "u8"), np.zeros(0, "u8")
    h = word_hashes(words)
    n = max(1, len(h) - SHINGLE + 1)
    plain = np.zeros(n, "u8")
    for i in range(min(SHINGLE, len(h))):
        plain += h[i:i + n] * _STEPS[i]
    plain = mix(plain)
    order = np.argsort(plain, kind="stable")
    same = np.r_[False, plain[order[1:]] == plain[order[:-1]]]
    run = np.arange(n)
    before = np.zeros(n, "u8")
    before[order] = run - np.maximum.accumulate(np.where(same, 0, run))
    return plain, np.where(before > 0, mix(plain + before * ROOT), plain)


def sketch(plain: np.ndarray, labelled: np.ndarray, k: int) -> np.ndarray:
    """The hash of the ordered sample of ``k`` shingles of each hash function."""
    n = len(labelled)
    out = np.zeros(SKETCHES, "u8")
    rows = max(1, (1 << 19) // n)  # hash functions at a time
    for i in range(0, SKETCHES, rows):
        values = mix(labelled[None, :] ^ _SEEDS[i:i + rows, None])
        at = np.argpartition(values, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (len(values), 1))
        chosen = plain[np.sort(at, axis=1)]
        total = np.full(len(values), k, "u8")
        for j in range(k):
            total = mix(total * ROOT + chosen[:, j])
        out[i:i + rows] = total
    return out.view("i8")


def sketches(plain: np.ndarray, labelled: np.ndarray) -> np.ndarray | None:
    """The sketches of each sample size that texts of this length have, one after
    the other; None if no other text can be near."""
    n = len(labelled)
    found = [sketch(plain, labelled, k) for k, least, most in ORDERS if least <= n and (most is None or n <= most)]
    return np.concatenate(found) if found else None


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> float:
    """Similarity of two sequences of labelled shingles: the longest common
    subsequence within the band, over all shingles of both. 0 if the threshold
    is out of reach.

    As labels are distinct, the subsequence is the longest increasing run of
    places in ``b`` of what ``a`` holds, place by place. A pair at the threshold
    leaves at most ``band`` shingles unaligned, so its places differ by no more.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return 1.0 if n == m else 0.0
    if min(n, m) < threshold * max(n, m):
        return 0.0
    band = int((n + m) * (1 - threshold) / (1 + threshold)) + 1
    order = np.argsort(b)
    at = np.searchsorted(b, a, sorter=order)
    at[at == m] = 0
    place = order[at]
    near = (b[place] == a) & (np.abs(place - np.arange(n)) <= band)
    places = place[near]
    least = threshold * (n + m) / (1 + threshold)
    if len(places) < least - 1e-9:
        return 0.0
    if (np.diff(places) > 0).all():
        found = len(places)
    else:
        ends: list[int] = []
        for p in places.tolist():
            i = bisect_left(ends, p)
            if i == len(ends):
                ends.append(p)
            else:
                ends[i] = p
        found = len(ends)
    return found / (n + m - found)


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number of their own in ``row``, written to the shared
    folder: the numbers depend on how a scan is split, which may differ from one
    plan to the next, so every later read takes them from these files."""
    return stored(docs.withColumn("row", F.monotonically_increasing_id()), "rows")


def _signed(docs: DataFrame) -> DataFrame:
    def start():
        def step(batch: pa.RecordBatch) -> dict:
            words, samples, size = [], [], []
            for text in batch.column("text").to_pylist():
                own = (text or "").split()
                words.append(hashlib.blake2b(" ".join(own).encode("utf-8", "surrogatepass"), digest_size=16).digest())
                plain, labelled = shingles(own)
                size.append(len(labelled))
                samples.append(sketches(plain, labelled))
            return {"row": batch.column("row"), "doc_id": batch.column("doc_id"), "words": words, "size": size, "sketches": samples}
        return step

    return map_batches(docs.select("row", "doc_id", "text"), start, "row long, doc_id long, words binary, size int, sketches array<long>")


def _packed(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts of the given rows, compressed before they are shuffled (row, text)."""

    def start():
        pack = zstandard.ZstdCompressor(level=PACK_LEVEL).compress
        return lambda b: {"row": b.column("row"), "text": [pack((t or "").encode("utf-8", "surrogatepass")) for t in b.column("text").to_pylist()]}

    return stored(map_batches(docs.select("row", "text"), start, "row long, text binary").join(rows, "row", "left_semi"), "texts")


def _opened() -> Callable[[bytes], np.ndarray]:
    """The labelled shingles of a packed text."""
    unpack = zstandard.ZstdDecompressor().decompress
    return lambda packed: shingles(unpack(packed).decode("utf-8", "surrogatepass").split())[1]


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that align, with their similarity."""
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def start():
        labelled = _opened()

        def step(batch: pa.RecordBatch) -> dict:
            known: dict[int, np.ndarray] = {}
            out = []
            a, b, text_a, text_b = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
            for x, y, s, t in zip(a, b, text_a, text_b):
                for row, text in ((x, s), (y, t)):
                    if row not in known:
                        known[row] = labelled(text)
                out.append(aligned(known[x], known[y], threshold))
            return {"a": a, "b": b, "similarity": out}
        return step

    return map_batches(both, start, "a long, b long, similarity double").where(F.col("similarity") >= threshold)


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many labelled shingles each of ``a`` shares with each of ``b``."""
    every = np.concatenate([*a, *b])
    doc = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    _, at, times = np.unique(every, return_inverse=True, return_counts=True)
    often = times > 1
    column = np.cumsum(often) - 1
    keep = often[at]
    doc, column = doc[keep], column[at[keep]]
    out = np.zeros((len(a), len(b)), "f4")
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    for lo in range(0, int(often.sum()), COLUMNS):
        part = slice(*np.searchsorted(column, (lo, lo + COLUMNS)))
        has = np.zeros((len(a) + len(b), COLUMNS), "f4")
        has[doc[part], column[part] - lo] = 1
        out += has[:len(a)] @ has[len(a):].T
    return out


def _apart_links(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that connect components within the buckets, from all pairs
    of them. A bucket of more than ``BLOCK`` members is dealt out as pairs of
    blocks; a task counts what its documents share, aligns those that may reach
    the threshold and are not yet connected, and returns only links that connect."""

    def shingled():
        opened = _opened()
        return lambda b: {"row": b.column("row"), "labelled": [opened(t).view("i8") for t in b.column("text").to_pylist()]}

    own = texts.join(members.select("row").distinct(), "row", "left_semi").select("row", "text")
    labelled = stored(map_batches(own, shingled, "row long, labelled array<long>"), "shingles")
    sizes = members.groupBy("k", "sample").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = members.select("k", "sample", "row", "component").join(sizes, ["k", "sample"]).withColumn("b", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("k", "sample", "row", "component", F.least("b", "other").alias("lo"), F.greatest("b", "other").alias("hi"), (F.col("b") <= F.col("other")).alias("first"))

    def compare():
        def step(batch: pa.RecordBatch) -> dict | None:
            rows, component = batch.column("row").to_pylist(), batch.column("component").to_pylist()
            own = [x.values.to_numpy().view("u8") for x in batch.column("labelled")]
            alone = batch.column("lo")[0].as_py() == batch.column("hi")[0].as_py()
            first = batch.column("first").to_numpy(zero_copy_only=False)
            q, d = (np.arange(len(rows)),) * 2 if alone else (np.flatnonzero(first), np.flatnonzero(~first))
            if len(set(component)) < 2 or not len(q) or not len(d):
                return None
            size = np.array([len(x) for x in own])
            shared = overlaps([own[i] for i in q], [own[i] for i in d])
            may = shared >= (threshold - 1e-6) * (size[q][:, None] + size[d][None, :] - shared)
            if alone:
                may = np.triu(may, 1)
            root = {c: c for c in component}

            def find(c: int) -> int:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            out: dict[str, list] = {"a": [], "b": []}
            for i, j in zip(*np.nonzero(may)):
                i, j = int(q[i]), int(d[j])
                x, y = find(component[i]), find(component[j])
                if x != y and aligned(own[i], own[j], threshold) >= threshold:
                    root[x] = y
                    out["a"].append(min(rows[i], rows[j]))
                    out["b"].append(max(rows[i], rows[j]))
            return out if out["a"] else None
        return step

    return map_groups(placed.join(labelled, "row"), ["k", "sample", "lo", "hi"], compare, "a long, b long").distinct()


def linked(docs: DataFrame, reps: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """Components (node, component) of the class representatives (row, size, sketches)."""
    members = reps.where("sketches is not null").select("row", "size", F.posexplode("sketches").alias("k", "sample"))
    members = members.withColumn("k", F.col("k") % SKETCHES)
    shared = members.groupBy("k", "sample").agg(F.count("*").alias("n")).where("n > 1").select("k", "sample")
    members = stored(members.join(shared, ["k", "sample"]).withColumn("component", F.col("row")), "members")  # of buckets with company
    texts = _packed(docs, members.select("row").distinct())
    near = F.least("size", "other_size") >= threshold * F.greatest("size", "other_size")
    known = docs.sparkSession.createDataFrame([], "node long, component long")

    def connect(found: DataFrame) -> DataFrame:
        return known if found.isEmpty() else cut(components(found.select("a", "b").unionByName(known.toDF("a", "b"))))

    for i in range(PIVOT_ROUNDS):
        pivot = F.struct(F.col("row").alias("other"), F.col("size").alias("other_size"), F.col("component").alias("other_component"))
        pivots = members.groupBy("k", "sample").agg(F.min_by(pivot, F.xxhash64(F.lit(i), "row")).alias("o")).select("k", "sample", "o.*")
        pairs = members.join(pivots, ["k", "sample"]).where("component <> other_component").where(near)
        pairs = pairs.select(F.least("row", "other").alias("a"), F.greatest("row", "other").alias("b")).distinct()
        known = connect(cut(_verified(pairs, texts, threshold)))
        # go on with the buckets whose members are not all connected
        now = members.drop("component").join(known.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))
        apart = now.groupBy("k", "sample").agg((F.min("component") < F.max("component")).alias("apart")).where("apart").select("k", "sample")
        members = stored(now.join(apart, ["k", "sample"]), "members")
        if members.isEmpty():
            return known
    return connect(cut(_apart_links(members, texts, threshold)))


def _grouped(docs: DataFrame, threshold: float) -> DataFrame:
    """(row, doc_id, kept_row, component_id) of every document of the numbered rows."""
    signed = stored(_signed(docs), "signed")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    by_words = signed.groupBy("words").agg(F.min_by(F.struct("row", "doc_id", "size", "sketches"), order).alias("r"))
    reps = stored(by_words.select("words", "r.*"), "classes")
    of = linked(docs, reps, threshold)
    reps = reps.select("words", "row", "doc_id").join(of.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))
    least = reps.groupBy("component").agg(F.min_by(F.struct("row", "doc_id"), order).alias("l"))
    reps = reps.select("words", "component").join(least, "component").select("words", F.col("l.row").alias("kept_row"), F.col("l.doc_id").alias("component_id"))
    return signed.select("row", "doc_id", "words").join(reps, "words").select("row", "doc_id", "kept_row", "component_id")


def classes(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, component_id (the doc_id that stays of its
    group), kept."""
    rows = _numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    return _grouped(rows, threshold).select("doc_id", "component_id", (F.col("row") == F.col("kept_row")).alias("kept"))


def keep_one(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows, with all their columns, that stay: one of each group."""
    rows = _numbered(docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))))
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    own = rows.select("row", doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text"))
    gone = cut(_grouped(own, threshold).where("row <> kept_row").select("row"))
    return rows.join(gone, "row", "left_anti").drop("row").toDF(*docs.columns)
