"""Document fingerprints as invertible Bloom lookup sketches of paragraphs.

A text's paragraphs (lines, cut at sentence ends and at words that their own
hash chooses) are hashed, and each
digest is added to three cells of a table of (count, xor of digests, xor of
checks), with half as many cells again as the text has paragraphs. The table is
the fingerprint. The tables of two versions, the larger folded to the size of
the smaller, subtract cell by cell; what they share cancels, and peeling cells
that hold one digest recovers those that differ: from the fingerprints alone if
a version differs in as much as half of its text. When peeling gets stuck, both
tables are built larger, until it succeeds; should the largest get stuck, the
digests themselves are compared. The recovered digests give the likeness: shared
paragraphs over all paragraphs of both.

Defined results: a null text is an empty one; two texts without paragraphs are
alike (1.0); a repeated paragraph counts as often as it occurs; in the order
of documents a null id is the smallest and equal ids go by their text; a single
document is its own next one; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowcubes.llm.common import documents, map_batches
from flowcubes.llm.hashing import mix, spelled

#: Least cells of a fingerprint: three equal parts, of a power of two.
CELLS, PARTS = 12, 3
MAX_CELLS = 3 << 20
SHIFT = np.array([[0], [21], [42]], "u8")
#: One word in so many ends a paragraph by itself.
LONG = np.uint64(8)
PLACE = np.uint64(0xD6E8FEB86659FD93)
CELL = np.dtype([("count", "<i4"), ("digest", "<u8"), ("check", "<u4")])


def paragraph_digests(text: str) -> np.ndarray:
    """64-bit digests of the paragraphs; the n-th copy of one has its own.

    A paragraph ends at a line's or sentence's end, and at every word that its
    own hash chooses (one in ``LONG``), so equal stretches are cut alike anywhere."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    line = code == 10
    space = line | (code == 32) | (code == 9) | (code == 13)
    word = ~space
    begin = np.flatnonzero(word & np.r_[True, space[:-1]])
    if not len(begin):
        return np.zeros(0, "u8")
    last = np.flatnonzero(word & np.r_[space[1:], True])
    h = spelled(code[word], last - begin + 1)
    lines = np.cumsum(line)
    closing = code[last]
    stop = (np.r_[lines[begin[1:]], -1] != lines[last]) | (closing == 46) | (closing == 33) | (closing == 63) | (h % LONG == 0)
    owner = np.cumsum(stop) - stop
    start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    within = np.arange(len(h)) - np.repeat(start, np.diff(np.r_[start, len(h)]))
    powers = np.cumprod(np.full(int(within.max()) + 1, PLACE))
    digest = mix(np.add.reduceat(h * powers[within], start))
    order = np.argsort(digest, kind="stable")
    run = np.arange(len(digest))
    fresh = np.r_[True, digest[order[1:]] != digest[order[:-1]]]
    copy = np.zeros(len(digest), "u8")
    copy[order] = run - np.maximum.accumulate(np.where(fresh, run, 0))
    return np.where(copy > 0, mix(digest + copy * PLACE), digest)


def _check(digests):
    return (digests * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype("<u4")


def sketch(digests: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """The table of digests: each is in one cell of each part."""
    out = np.zeros(cells, CELL)
    part = cells // PARTS
    places = (digests >> SHIFT & np.uint64(part - 1)).astype("i8") + np.arange(PARTS)[:, None] * part
    digest, check, own = np.zeros(cells, "u8"), np.zeros(cells, "u4"), _check(digests)
    for at in places:
        np.bitwise_xor.at(digest, at, digests)
        np.bitwise_xor.at(check, at, own)
    out["count"], out["digest"], out["check"] = np.bincount(places.ravel(), minlength=cells), digest, check
    return out


def folded(table: np.ndarray, cells: int) -> np.ndarray:
    """The smaller table of the same digests: cells whose numbers agree in
    their low bits are added up."""
    out = np.empty(cells, CELL)
    by = table.reshape(PARTS, -1, cells // PARTS)
    out["count"] = by["count"].sum(1).ravel()
    for name in ("digest", "check"):
        out[name] = np.bitwise_xor.reduce(by[name], axis=1).ravel()
    return out


def subtract(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), CELL)
    out["count"] = a["count"] - b["count"]
    out["digest"] = a["digest"] ^ b["digest"]
    out["check"] = a["check"] ^ b["check"]
    return out


def peel(table: np.ndarray) -> tuple[set[int], set[int]] | None:
    """Digests only in the first and only in the second version; None when stuck.
    Each round takes all cells that hold one digest."""
    part = len(table) // PARTS
    offset = np.arange(PARTS)[:, None] * part
    count, digest, check = table["count"].copy(), table["digest"].copy(), table["check"].copy()
    signs, digests = [], []
    while True:
        at = np.flatnonzero(np.abs(count) == 1)
        at = at[_check(digest[at]) == check[at]]
        if not len(at):
            break
        found, one = np.unique(digest[at], return_index=True)
        sign, own = count[at[one]], _check(found)
        signs.append(sign)
        digests.append(found)
        for place in (found >> SHIFT & np.uint64(part - 1)).astype("i8") + offset:
            np.subtract.at(count, place, sign)
            np.bitwise_xor.at(digest, place, found)
            np.bitwise_xor.at(check, place, own)
    if count.any() or digest.any():
        return None
    if not digests:
        return set(), set()
    sign, found = np.concatenate(signs), np.concatenate(digests)
    return set(found[sign > 0].tolist()), set(found[sign < 0].tolist())


def cells_for(differing: int) -> int:
    """Cells from which so many differing digests are likely to peel."""
    cells = CELLS
    while cells < 3 * differing // 2 + CELLS // 2 and cells < MAX_CELLS:
        cells *= 2
    return cells


def fingerprint(digests: np.ndarray) -> np.ndarray:
    """The table that is published of a text."""
    return sketch(digests, cells_for(len(digests)))


def compared(x: np.ndarray, y: np.ndarray) -> tuple[set[int], set[int]] | None:
    """The digests in which two versions differ, from two tables of any sizes."""
    cells = min(len(x), len(y))
    x, y = (t if len(t) == cells else folded(t, cells) for t in (x, y))
    return peel(subtract(x, y))


def difference(a: np.ndarray, b: np.ndarray, tables: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[set[int], set[int]]:
    """The digests in which two versions differ: first from the fingerprints
    (``tables``, if they are at hand), then, when these get stuck, from ever
    larger tables."""
    found = compared(*(tables or (fingerprint(a), fingerprint(b))))
    cells = cells_for(len(a) + len(b))
    while found is None and cells <= MAX_CELLS:
        found = compared(sketch(a, cells), sketch(b, cells))
        cells *= 2
    if found is None:
        found = set(np.setdiff1d(a, b).tolist()), set(np.setdiff1d(b, a).tolist())
    return found


def likeness(a: np.ndarray, b: np.ndarray, tables: tuple[np.ndarray, np.ndarray] | None = None) -> float:
    first, second = difference(a, b, tables)
    shared = len(a) - len(first)
    every = shared + len(first) + len(second)
    return shared / every if every else 1.0


def text_of(table: np.ndarray) -> str:
    return base64.b64encode(table.tobytes()).decode()


def table_of(text: str) -> np.ndarray:
    """The table of a published fingerprint."""
    return np.frombuffer(base64.b64decode(text), CELL)


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(doc_id, text, next_text): the text that follows in descending doc_id.

    Ids are cut at approximate quantiles into buckets; within one a window
    gives the next text, and its last row takes the first text of the next
    bucket, of which there is one a bucket. No task sees all ids."""
    spark = docs.sparkSession
    d = documents(docs).withColumn("place", F.coalesce(F.bitwise_not("doc_id"), F.lit(2**63 - 1)))  # ascending: ids descend
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = d.agg(F.percentile_approx("place", [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    cuts = np.array(sorted(set(cuts)), "i8")

    @F.pandas_udf("int")
    def bucket(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, place.to_numpy()).astype("i4"))

    d = d.withColumn("bucket", bucket("place"))
    first = d.groupBy("bucket").agg(F.min_by("text", F.struct("place", "text")).alias("first"))
    over = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # one row a bucket
    first = first.select("bucket", F.coalesce(F.lead("first").over(W.orderBy("bucket")), F.first("first").over(over)).alias("first_of_next"))
    d = d.withColumn("within", F.lead("text").over(W.partitionBy("bucket").orderBy("place", "text")))
    return d.join(first, "bucket").select("doc_id", "text", F.coalesce("within", "first_of_next").alias("next_text"))


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited version, and likenesses."""

    def start():
        ahead: list = [None, None, None]  # the text that came next, its digests and table: mostly those of the following row

        def step(batch: pa.RecordBatch) -> dict:
            out = {k: [] for k in SCHEMA.replace(",", "").split()[::2] if k != "doc_id"}
            for text, after in zip(batch.column("text").to_pylist(), batch.column("next_text").to_pylist()):
                half = len(text) // 2
                edited = text[:len(text) - half] + after[:half]
                if ahead[0] == text:
                    own, x = ahead[1:]
                else:
                    own = paragraph_digests(text)
                    x = fingerprint(own)
                new, other = paragraph_digests(edited), paragraph_digests(after)
                y, z = fingerprint(new), fingerprint(other)
                ahead[:] = after, other, z
                out["n_chars"].append(len(text))
                out["edited_sha256"].append(hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest())
                out["fingerprint"].append(text_of(x))
                out["edited_fingerprint"].append(text_of(y))
                out["near_edited"].append(likeness(own, new, (x, y)))
                out["near_next"].append(likeness(own, other, (x, z)))
            return out | {"doc_id": batch.column("doc_id")}
        return step

    return map_batches(with_next(docs), start, SCHEMA)
