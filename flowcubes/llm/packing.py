"""Best-fit packing planned on the length histogram.

Documents are tokenised and cut into pieces of at most ``LIMIT`` tokens. Only
how many pieces there are of each length (at most ``LIMIT`` numbers) goes to
the driver, where best-fit decreasing runs over counts: it places whole runs
of equal lengths at once, and a run of sequences that look alike is one entry.
The plan says, for each length, which ranks take which sequence and offset. A
piece's rank within its length is its place among the equal lengths of its
task plus what earlier tasks hold, so no length, however common, is gathered
in one task. Pieces take their slots by rank.

Defined results: a null text is an empty one, which is the end mark alone;
repeated rows are packed once each; null ids are kept; an empty table gives
none; equal lengths are ordered by task and place in it; extra columns are not
read.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcubes.llm.common import cut, documents, map_batches

LIMIT = 2048
END = 0
VOCABULARY = "byte_bpe_50k"


@cache
def rank_file(name: str) -> dict[bytes, int]:
    with open(public_tokenizers.path(name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """Ids as the tokenizers library gives them for ``<name>.json``.

    The same vocabulary exists as a rank file, which encodes ordinary text
    faster; texts that hold a special string go through the library itself.
    """

    def __init__(self, name: str = VOCABULARY):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=rank_file(f"{name}.tiktoken"), special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


def piece_bounds(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; the first may be the shorter one."""
    first = n % limit or limit
    return [(0, min(n, first))] + [(s, limit) for s in range(first, n, limit)]


def pieces_of(docs: DataFrame, limit: int = LIMIT, name: str = VOCABULARY) -> DataFrame:
    """Tokenised pieces, each with its task and its place among the equal
    lengths of that task."""

    def start():
        encode, task, seen, end = Encoder(name), TaskContext.get().partitionId(), [0] * (limit + 1), np.array([END], "<u4")

        def step(batch: pa.RecordBatch) -> dict:
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "task", "place")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.concatenate([encode(text), end])
                for i, (s, n) in enumerate(piece_bounds(len(ids), limit)):
                    out["doc_id"].append(doc_id)
                    out["piece"].append(i)
                    out["start"].append(s)
                    out["length"].append(n)
                    out["ids_crc32"].append(zlib.crc32(ids[s:s + n].tobytes()))
                    out["task"].append(task)
                    out["place"].append(seen[n])
                    seen[n] += 1
            return out
        return step

    return map_batches(documents(docs), start, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long")


Slot = tuple[int, int, int, int, int]  # length, first rank, ranks, first sequence, offset


def plan(histogram: dict[int, int], limit: int = LIMIT) -> list[Slot]:
    """Best-fit decreasing over counts of lengths."""
    slots: list[Slot] = []
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of sequences
    free: list[int] = []  # the keys of room, sorted
    sequences = 0

    def give(capacity: int, first: int, n: int) -> None:
        if capacity and n:
            if capacity not in room:
                room[capacity] = []
                bisect.insort(free, capacity)
            room[capacity].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while rank < count:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                capacity = free[at]
                first, n = room[capacity].pop()
                if not room[capacity]:
                    del room[capacity], free[at]
                # a sequence that took one has the least room that fits the next
                each = capacity // length
                whole, rest = divmod(count - rank, each)
                for m, per in ((min(n, whole), each), (int(whole < n), rest)):
                    if m and per:
                        for j in range(per):
                            slots.append((length, rank, m, first, limit - capacity + j * length))
                            rank += m
                        give(capacity - per * length, first, m)
                        first, n = first + m, n - m
                give(capacity, first, n)
                continue
            each = limit // length
            whole, rest = divmod(count - rank, each)
            for n, per in ((whole, each), (1, rest)):
                if n and per:
                    for j in range(per):
                        slots.append((length, rank, n, sequences, j * length))
                        rank += n
                    give(limit - per * length, sequences, n)
                    sequences += n
    return slots


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds sequence_id and offset to materialised pieces (length, task, place, ...)."""
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    by_task = by_task.select("task", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``limit`` rows
    slots = np.array(sorted(plan(histogram, limit)), "i8").reshape(-1, 5)
    ranked = pieces.join(by_task.select("task", "length", "earlier"), ["task", "length"])
    ranked = ranked.withColumn("rank", F.col("earlier") + F.col("place")).drop("earlier", "task", "place")
    key = slots[:, 0] << 44 | slots[:, 1]  # ranks of a length below 2**44

    fields = [f for f in ranked.schema.fields if f.name != "rank"]
    kept = [f.name for f in fields]

    def start():
        def step(batch: pa.RecordBatch) -> dict:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            slot = slots[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            return {c: batch.column(c) for c in kept} | {"sequence_id": pa.array(slot[:, 3] + rank - slot[:, 1]), "offset": pa.array(slot[:, 4])}
        return step

    return map_batches(ranked, start, T.StructType(fields).add("sequence_id", "long").add("offset", "long"))


COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(docs: DataFrame, limit: int = LIMIT, name: str = VOCABULARY) -> DataFrame:
    """All documents as pieces placed in as few sequences as best fit finds."""
    return pack(cut(pieces_of(docs, limit, name)), limit).select(*COLUMNS)
