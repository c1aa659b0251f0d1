"""Byte-level BPE encoding over overlapping chunks, and decoding.

A long text is dealt out as chunks that overlap. Each chunk is pre-tokenised
from its own start, which may lie within a pre-token. Where, in the overlap,
the boundaries of a chunk and of the one before it meet, both go on alike; so
the earlier chunk ends there and the later one begins. Only the boundaries are
brought together by document for that. The pieces between these points are
encoded wherever their chunks are; chunks that meet nowhere in their overlap
are first joined with their neighbours, and only these. Decoding joins the raw
bytes of the ids. The digests of a document run over its pieces in order, so
that no task holds more of a long text than one piece.

Defined results: a null text encodes as an empty one, to no ids; a null id is
passed through; repeated rows give equal rows; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowcubes.llm.common import documents, map_batches, split_long, stored
from flowcubes.llm.packing import rank_file

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CHUNK, OVERLAP = 16_384, 512
#: Rows of pieces that a Python step takes or gives at a time.
PIECES = 64


class Codec:
    """Encoding of text to ids and decoding of ids to bytes by a rank file."""

    def __init__(self, name: str = VOCABULARY):
        import tiktoken

        ranks = rank_file(name)
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.raw = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.raw[rank] = token

    def encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids.tolist()))


#: The pattern with the white space of Unicode, which Python's \s is not.
PRE_TOKEN = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def boundaries(text: str, start: int, end: int, whole: bool) -> list[int]:
    """Ends of pre-tokens between two places of a chunk. Those after white
    space, and the last ones unless the text ends there, are left out: what
    follows might change them."""
    last = len(text) if whole else len(text) - 1
    return [e for m in PRE_TOKEN.finditer(text) if start <= (e := m.end()) < min(end, last) and not text[e - 1].isspace()]


def whole_texts(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of texts that are encoded in one go."""

    def start():
        codec = Codec(name)
        return lambda b: {"doc_id": b.column("doc_id"), "ids": [codec.encode(t).tobytes() for t in b.column("text").to_pylist()]}

    return map_batches(docs, start, "doc_id long, ids binary")


def stitched(chunks: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, k, run, lo, hi, alone): where the piece of each chunk begins and ends.
    Chunks that do not meet are of one ``run``. No text is shuffled for it."""

    def edges():
        def step(batch: pa.RecordBatch) -> dict:
            texts, ks, lasts = (batch.column(c).to_pylist() for c in ("text", "k", "last"))
            head = [boundaries(t[:overlap], 1, overlap, False) if k else [] for t, k in zip(texts, ks)]
            tail = [[] if last else [e - chunk for e in boundaries(t, chunk, len(t), False)] for t, last in zip(texts, lasts)]
            return {c: batch.column(c) for c in ("row", "k", "last")} | {"head": head, "tail": tail}
        return step

    order = W.partitionBy("row").orderBy("k")
    found = map_batches(chunks, edges, "row long, k int, last boolean, head array<int>, tail array<int>")
    found = found.select("row", "k", "last", F.when(F.col("k") == 0, 0).otherwise(F.array_min(F.array_intersect(F.lag("tail").over(order), "head"))).alias("lo"))
    found = found.select("row", "k", "lo", (F.col("lo").isNotNull() & (F.col("last") | F.lead("lo").over(order).isNotNull())).alias("alone"),
                         F.lead("lo").over(order).alias("hi"), F.sum(F.col("lo").isNotNull().cast("int")).over(order).alias("run"))
    return found


def pieces(docs: DataFrame, name: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(row, doc_id, run, ids): the pieces of long texts, by their order ``run``."""
    chunks = stored(split_long(docs, chunk, overlap), "chunks")
    placed = chunks.join(stitched(chunks, chunk, overlap), ["row", "k"])
    kind = T.StructType.fromDDL("row long, doc_id long, run long, ids binary")
    arrow = to_arrow_schema(kind)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, parts, of = Codec(name), [], None
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
            out.clear()
            return made

        def end() -> None:
            out.append((*of, codec.encode("".join(parts)).tobytes()))
            parts.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, PIECES):
                for r in batch.slice(at, PIECES).to_pylist():
                    key = (r["row"], r["doc_id"], r["run"])
                    if key != of and of is not None:
                        end()
                        if len(out) >= PIECES:
                            yield flush()
                    of = key
                    text = r["text"] if r["last"] else r["text"][:chunk + (r["hi"] or 0)]
                    parts.append(text[r["lo"] or 0:])
        if of is not None:
            end()
        if out:
            yield flush()

    columns = ["row", "doc_id", "run", "k", "last", "lo", "hi", "text"]
    # chunks of a run that meet nowhere come together, in order
    apart = placed.where("not alone").select(*columns).repartition("row", "run").sortWithinPartitions("row", "run", "k")
    return placed.where("alone").select(*columns).mapInArrow(encoded, kind).unionByName(apart.mapInArrow(encoded, kind))


def encode_documents(docs: DataFrame, name: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids as little-endian unsigned 32-bit integers): all ids of a
    document in one value."""
    docs = documents(docs)
    long = pieces(docs.where(F.length("text") > chunk), name, chunk, overlap)
    joined = F.array_sort(F.collect_list(F.struct("run", "ids"))).alias("parts")
    empty = F.lit(b"")
    long = long.groupBy("row").agg(F.first("doc_id").alias("doc_id"), joined).select("doc_id", F.aggregate("parts", empty, lambda a, x: F.concat(a, x["ids"])).alias("ids"))
    return whole_texts(docs.where(F.length("text") <= chunk), name).unionByName(long)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, name: str = VOCABULARY, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Per document: n_tokens, and the digests of its ids and of the bytes that
    these decode to."""
    docs = documents(docs)

    def start():
        codec = Codec(name)

        def step(batch: pa.RecordBatch) -> dict:
            ids = [codec.encode(t) for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "n_tokens": [len(x) for x in ids], "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(codec.decode(x)).hexdigest() for x in ids]}
        return step

    kind = T.StructType.fromDDL(DIGESTS)
    arrow = to_arrow_schema(kind)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, of, n, hashes = Codec(name), None, 0, ()
        out: list[dict] = []

        def end() -> None:
            out.append(dict(zip(arrow.names, (of[1], n, *(h.hexdigest() for h in hashes)))))

        for batch in batches:
            for at in range(0, batch.num_rows, PIECES):
                for r in batch.slice(at, PIECES).to_pylist():
                    if (r["row"], r["doc_id"]) != of:
                        if of is not None:
                            end()
                        of, n, hashes = (r["row"], r["doc_id"]), 0, (hashlib.sha256(), hashlib.sha256())
                    n += len(r["ids"]) // 4
                    hashes[0].update(r["ids"])
                    hashes[1].update(codec.decode(np.frombuffer(r["ids"], "<u4")))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out.clear()
        if of is not None:
            end()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    long = pieces(docs.where(F.length("text") > chunk), name, chunk, overlap)
    long = long.repartition("row").sortWithinPartitions("row", "run").mapInArrow(digests, kind)
    return map_batches(docs.where(F.length("text") <= chunk), start, DIGESTS).unionByName(long)
