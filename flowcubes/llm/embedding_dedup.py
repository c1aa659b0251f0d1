"""Near-duplicate vectors by collision-counting projections.

Vectors with equal components and label are one class. Each class vector is
projected on many directions. Tables of some directions each put it in a
cell, and only vectors that share a cell of some table are compared. Within a
cell the vectors are sorted along each of ``COUNTED`` further projections; a
window around every query marks those it collides with; and pairs that collide
in at least ``needed()`` of them are verified by their cosine. The window and
the count are set so that a pair at the threshold passes with probability of
at least 0.9999; the tables, so that it shares a cell with as much, and nearer
pairs with more.

A table has as many directions as keep its cells at about half a block for the
classes of the largest label (`bits_for`), and there are as many tables as the
recall needs at that number, so that cells stay as small, and recall as high, as
the input grows. A cell of more than ``BLOCK`` vectors is dealt out as pairs of
blocks. A pair counts in the first table whose cell it shares. A block returns
the number of links of each vector and a spanning star of each linked set, never
its pairs. Vectors join their cells last, in the precision of the table, so that
each is shuffled once a table.

Defined results: vectors that are null, empty, zero, or hold a null or a
non-finite number, and vectors without a label link with nothing, as do vectors
of different length; repeated rows are vectors of their own that link; a null
id is never the smallest unless there is no other; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowcubes.llm.common import components, cut, map_batches, map_groups, stored
from flowcubes.llm.hashing import mix

COSINE = 0.93
BITS, CELL = 8, 2.0
COUNTED, RECALL = 48, 0.9999
BLOCK = 1024
#: Fewest directions of a table.
LEAST_BITS = 4
#: Keys of more rows than this share of all, at most 1,000 keys, are broadcast.
HOT_SHARE, HOT_ROWS = 1000, 1000
SEED = 20240517


def spread(cosine: float) -> float:
    """Deviation of the difference of two unit vectors along a direction."""
    return math.sqrt(2 * (1 - cosine))


def side(c: float) -> float:
    """Probability that two points whose difference is normal, of a deviation of
    ``c`` cells, lie in the same cell of a line."""
    return math.erf(1 / c / math.sqrt(2)) - c * math.sqrt(2 / math.pi) * (1 - math.exp(-1 / (2 * c * c)))


def sharing(tables: int, cosine: float = COSINE, bits: int = BITS) -> float:
    """Probability that a pair at the threshold shares a cell of some table."""
    return 1 - (1 - side(spread(cosine) / CELL) ** bits) ** tables


def tables_for(bits: int, cosine: float = COSINE) -> int:
    """The fewest tables in which a pair at the threshold shares a cell with ``RECALL``."""
    return math.ceil(math.log(1 - RECALL) / math.log(1 - side(spread(cosine) / CELL) ** bits))


TABLES = tables_for(BITS)


def bits_for(n: int) -> int:
    """Directions a table, so that a cell holds about half a block of n vectors
    of no relation."""
    return max(LEAST_BITS, math.ceil(math.log(max(1, 2 * n / BLOCK)) / -math.log(side(spread(0) / CELL))))


def needed(cosine: float = COSINE, counted: int = COUNTED, recall: float = RECALL) -> int:
    """The largest count that a pair at the threshold reaches with ``recall``,
    for windows of two deviations to either side."""
    p = math.erf(2 / math.sqrt(2))
    at_least = 0.0
    for k in range(counted, -1, -1):
        at_least += math.comb(counted, k) * p**k * (1 - p) ** (counted - k)
        if at_least >= recall:
            return k
    return 0


def directions(size: int, bits: int = BITS, tables: int = TABLES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions of the tables, their offsets, and the counted directions."""
    rng = np.random.default_rng([SEED, size])
    return rng.standard_normal((size, tables * bits)), rng.uniform(0, CELL, tables * bits), rng.standard_normal((size, COUNTED))


def collisions(queries: np.ndarray, data: np.ndarray, half: float) -> np.ndarray:
    """How often each data row lies in the window around each query row, over
    the projections (columns), each sorted once: a window is a range of ranks,
    and one unsigned comparison tells whether a rank is in it."""
    count = np.zeros((len(queries), len(data)), "i1")
    kind = "u2" if len(data) < 1 << 16 else "u4"
    rank = np.empty(len(data), kind)
    for q, d in zip(queries.T, data.T):
        order = np.argsort(d)
        edges = d[order]
        rank[order] = np.arange(len(d))
        lo, hi = (np.searchsorted(edges, x, s).astype(kind)[:, None] for x, s in ((q - half, "left"), (q + half, "right")))
        count += rank - lo < hi - lo
    return count


def near(x: np.ndarray, q: np.ndarray, d: np.ndarray, passing: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The passing pairs of rows q and d of the unit vectors x that reach the cosine."""
    if passing.mean() > 0.02:  # one product costs less than so many rows gathered
        i, j = np.nonzero(passing & (x[q] @ x[d].T >= cosine))
        return q[i], d[j]
    i, j = np.nonzero(passing)
    ok = np.einsum("ij,ij->i", x[q[i]], x[d[j]]) >= cosine
    return q[i[ok]], d[j[ok]]


def _usable(vector: list | None) -> bool:
    return bool(vector) and None not in vector and all(map(math.isfinite, vector)) and any(vector)


def _dealt(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join on the key; ``n`` of the right side is how many left rows have
    it. Keys of a thousandth of all rows, of which there are at most a thousand,
    are broadcast, so that no task gets all rows of one."""
    most = max(HOT_ROWS, total // HOT_SHARE)
    hot = F.broadcast(right.where(F.col("n") > most).drop("n"))
    rest = left.join(hot.select(key), key, "left_anti").join(right.where(F.col("n") <= most).drop("n"), key)
    return left.join(hot, key).unionByName(rest)


def links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    kind = vectors.schema["embedding"].dataType
    width = "f4" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "f8"
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))

    def usable():
        def step(batch: pa.RecordBatch) -> dict:
            out = {c: batch.column(c) for c in ("row", "vec_id", "label")} | {"key": [], "size": [], "vector": []}
            for label, vector in zip(batch.column("label").to_pylist(), batch.column("vector").to_pylist()):
                raw = key = None
                if label is not None and _usable(vector):
                    raw = (np.array(vector, width) + 0.0).tobytes()  # no negative zeros
                    key = hashlib.blake2b(label.encode("utf-8", "surrogatepass") + b"\0" + raw, digest_size=16).digest()
                out["key"].append(key)
                out["size"].append(len(vector or ()))
                out["vector"].append(raw)
            return out
        return step

    rows = stored(map_batches(rows, usable, "row long, vec_id long, label string, key binary, size int, vector binary"), "vectors")
    able = rows.where("key is not null")
    classes = able.groupBy("key").agg(F.min("row").alias("rep"), F.count("*").alias("n"), F.min("vec_id").alias("least"), *(F.first(c).alias(c) for c in ("label", "size", "vector")))
    classes = stored(classes, "classes")
    largest = classes.groupBy("label", "size").agg(F.count("*").alias("of")).agg(F.max("of")).first()[0] or 0
    bits = bits_for(largest)
    tables = tables_for(bits, cosine)

    def units(raw: list[bytes], size: int) -> np.ndarray:
        x = np.frombuffer(b"".join(raw), width).reshape(len(raw), size).astype("f8")
        x /= np.abs(x).max(1, keepdims=True)
        return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]

    def signed():
        by_size: dict[int, tuple] = {}

        def step(batch: pa.RecordBatch) -> dict:
            cells = []
            for size, raw in zip(batch.column("size").to_pylist(), batch.column("vector").to_pylist()):
                if size not in by_size:
                    by_size[size] = directions(size, bits, tables)[:2]
                table, offset = by_size[size]
                where = np.floor((units([raw], size)[0] @ table + offset) / CELL).astype("i8").view("u8").reshape(tables, bits)
                key = np.zeros(tables, "u8")
                for j in range(bits):
                    key = mix(key + where[:, j])
                cells.append((key >> np.uint64(32)).astype("u4").view("i4"))
            return {c: batch.column(c) for c in ("rep", "n", "label", "size", "vector")} | {"cells": cells}
        return step

    signed_rows = stored(map_batches(classes.select("rep", "n", "label", "size", "vector"), signed, "rep long, n long, label string, size int, vector binary, cells array<int>"), "cells")
    cell = ["label", "size", "t", "cell"]
    placed = signed_rows.select("rep", "label", "size", F.posexplode("cells").alias("t", "cell"))
    shared = placed.groupBy(*cell).agg(F.count("*").alias("held")).where("held > 1")
    blocks = F.ceil(F.col("held") / BLOCK).cast("int")
    placed = placed.join(shared, cell).withColumn("blocks", blocks).withColumn("b", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    paired = placed.select(*cell, "rep", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    paired = paired.withColumns({"lo": F.least("b", "other"), "hi": F.greatest("b", "other")}).withColumn("first", F.col("b") == F.col("lo")).drop("b", "other")
    paired = paired.join(signed_rows.select("rep", "n", "vector", "cells"), "rep").withColumn("cells", F.slice("cells", F.lit(1), F.col("t")))

    def compare():
        count, half, by_size = needed(cosine), 2 * spread(cosine), {}

        def step(batch: pa.RecordBatch) -> dict | None:
            size, t = batch.column("size")[0].as_py(), batch.column("t")[0].as_py()
            x = units(batch.column("vector").to_pylist(), size)
            cells = batch.column("cells").flatten().to_numpy().reshape(len(x), t)  # of the tables before
            reps, n = batch.column("rep").to_numpy(), batch.column("n").to_numpy()
            alone = batch.column("lo")[0].as_py() == batch.column("hi")[0].as_py()
            first = batch.column("first").to_numpy(zero_copy_only=False)
            q, d = (np.arange(len(x)),) * 2 if alone else (np.flatnonzero(first), np.flatnonzero(~first))
            if not len(q) or not len(d) or len(x) < 2:
                return None
            if size not in by_size:
                by_size[size] = directions(size, bits, tables)[2]
            p = x @ by_size[size]
            passing = collisions(p[q], p[d], half) >= count
            if alone:
                passing = np.triu(passing, 1)
            a, b = near(x, q, d, passing, cosine)
            new = (cells[a] != cells[b]).all(1)
            a, b = a[new], b[new]
            if not len(a):
                return None
            linked = np.bincount(a, n[b], len(x)) + np.bincount(b, n[a], len(x))
            root = reps.copy()
            while True:
                before = root.copy()
                np.minimum.at(root, a, root[b])
                np.minimum.at(root, b, root[a])
                if (before == root).all():
                    break
            hot = np.flatnonzero(linked)
            return {"rep": reps[hot].tolist(), "links": linked[hot].astype("i8").tolist(), "root": root[hot].tolist()}
        return step

    found = cut(map_groups(paired, [*cell, "lo", "hi"], compare, "rep long, links long, root long"))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    reps = classes.select("key", "rep", "n", "least").join(linked, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    reps = cut(reps.select("key", "n", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")))
    least = cut(reps.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    named = cut(_dealt(reps.withColumnRenamed("n", "copies"), least, "component", reps.count()).select("key", "n_links", "component_id", F.col("copies").alias("n")))
    out = _dealt(able.select("key", "vec_id"), named, "key", able.count()).select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


TWIN = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
), l AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.x, b.x) BETWEEN {COSINE} AND 2
), reach(node, other) AS (
    SELECT a, b FROM l
    UNION
    SELECT r.node, l.b FROM reach r JOIN l ON l.a = r.other
), c AS (
    SELECT node, least(node, min(other)) AS component_id FROM reach GROUP BY node
)
SELECT v.vec_id, coalesce(k.n, 0) AS n_links, coalesce(c.component_id, v.vec_id) AS component_id,
       coalesce(c.component_id, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) k ON k.a = v.vec_id LEFT JOIN c ON c.node = v.vec_id
"""
