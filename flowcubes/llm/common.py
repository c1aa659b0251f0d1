"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowcubes.session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows per Arrow batch: bounds what a Python worker holds of very long texts.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package and bound their batches."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH")) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, cutting lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write compressed Parquet to the shared checkpoint folder and read it from
    there: for tables of some size, and rows whose numbers must not change."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def map_batches(df: DataFrame, fn: Callable[[], Callable[[pa.RecordBatch], dict | pa.RecordBatch | None]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow over batches. ``fn()`` is called once a task and gives the
    function of a batch, which returns columns by name (or a batch)."""
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = fn()
        for batch in batches:
            if not batch.num_rows:
                continue
            out = step(batch)
            if out is None:
                continue
            if isinstance(out, dict):
                arrays = [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow]
                out = pa.RecordBatch.from_arrays(arrays, schema=arrow)
            if out.num_rows:
                yield out

    return df.mapInArrow(run, kind)


def map_whole(df: DataFrame, fn: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """`map_batches` that keeps all columns, whatever their names are: the
    function gets and returns batches whose columns are in the order of ``df``."""
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return map_batches(plain, fn, plain.schema).toDF(*df.columns)


def held_out(doc_id: str, folds: int, fold: int):
    """Whether crc32 of the id as text falls into the fold; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(True))


#: Samples of no more rows are broadcast; what is sampled is then not shuffled.
BROADCAST_ROWS = 200_000


def sample_by(rows: DataFrame, kind: str, most: int, kinds: int = 256) -> DataFrame:
    """At most ``most`` distinct (doc_id, kind) of each of the ``kinds`` most
    frequent kinds: those of least hash of the id. Rows far above that are left out by their hash first, so
    that the ranking sees a few times ``most`` rows of each kind, however many
    there are; only the counts by kind come to the driver."""
    rows = rows.select("doc_id", kind).where(F.col(kind).isNotNull())
    counts = {r[kind]: r["n"] for r in rows.groupBy(kind).agg(F.count("*").alias("n")).orderBy(F.desc("n"), kind).limit(kinds).collect()}
    if not counts:
        return rows.limit(0)
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4 * most / n))]), F.col(kind))
    place = F.xxhash64("doc_id").bitwiseAND(F.lit(2**53 - 1)) / F.lit(float(2**53))
    rows = rows.where(place < share).distinct()
    at = F.row_number().over(W.partitionBy(kind).orderBy(place, "doc_id"))
    rows = rows.withColumn("at", at).where(F.col("at") <= most).drop("at")
    return F.broadcast(rows) if len(counts) * most <= BROADCAST_ROWS else rows


#: Edge lists of no more rows are worked on in one task, without shuffles.
SMALL_EDGES = 200_000


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of (a, b) long pairs: (node, component = smallest
    node), for the nodes that have edges.

    Alternating large-star and small-star rounds, each a grouped minimum joined
    back on the node, so that a hub is pre-aggregated and its rows can be split;
    every round is checkpointed. Logarithmically many rounds in practice; it
    raises when ``max_rounds`` do not suffice, and never returns a partial answer.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    for _ in range(max_rounds):
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before, small = state, state[0] <= SMALL_EDGES

        def together(df: DataFrame) -> DataFrame:
            return df.coalesce(1) if small else df

        both = together(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        shorter = large.join(low, "a").select(F.col("b").alias("x"), "m").where("x <> m").toDF("a", "b").unionByName(low.toDF("a", "b"))
        e = cut(together(shorter).distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def split_long(docs: DataFrame, size: int, overlap: int) -> DataFrame:
    """Texts as chunks of ``size`` code points, each with up to ``overlap`` more
    of what follows: (row, doc_id, k, last, text), dealt out over all tasks."""

    def start():
        def step(batch: pa.RecordBatch) -> dict:
            out = {"row": [], "doc_id": [], "k": [], "last": [], "text": []}
            for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                n = max(1, -(-len(text) // size))
                out["row"] += [row] * n
                out["doc_id"] += [doc_id] * n
                out["k"] += range(n)
                out["last"] += [k == n - 1 for k in range(n)]
                out["text"] += [text[k * size:(k + 1) * size + overlap] for k in range(n)]
            return out
        return step

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    chunks = map_batches(rows, start, "row long, doc_id long, k int, last boolean, text string")
    return chunks.repartition(F.col("row"), F.col("k"))


def documents(docs: DataFrame) -> DataFrame:
    """doc_id as long and text, null as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[], Callable[[pa.RecordBatch], dict | None]], schema: str) -> DataFrame:
    """``fn()`` of each group of rows with equal keys, as one batch. Groups are
    dealt out by hash and streamed from sorted partitions, so that very many
    small ones cost little; the caller bounds their sizes."""
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, rest = fn(), None
        out: dict[str, list] = {f.name: [] for f in arrow}
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            held = 0
            made = pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
            for v in out.values():
                v.clear()
            return made

        def take(group: pa.Table) -> None:
            nonlocal held
            found = step(group.combine_chunks().to_batches()[0])
            if found:
                for name, v in out.items():
                    v.extend(found[name])
                held = len(v)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if rest is not None:
                rows = pa.concat_tables([rest, rows])
            ends = [c.combine_chunks() for c in (rows.column(k) for k in keys)]
            change = np.zeros(max(0, rows.num_rows - 1), bool)
            for c in ends:
                codes = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c).dictionary_encode(null_encoding="encode").indices.to_numpy()
                change |= codes[1:] != codes[:-1]
            at = [0, *(np.flatnonzero(change) + 1).tolist()]
            for a, b in zip(at, at[1:]):
                take(rows.slice(a, b - a))
                if held >= 10_000:
                    yield flush()
            rest = rows.slice(at[-1]) if rows.num_rows else None
        if rest is not None and rest.num_rows:
            take(rest)
        if held:
            yield flush()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, kind)
