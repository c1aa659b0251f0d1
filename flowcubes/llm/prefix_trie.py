"""The prefix trie of conversations, by adaptive radix trees.

A turn's id is a digest of its role and text, of fixed width; a conversation is
the string of its turns' ids. Tasks take ranges of these strings in order and
put each into an adaptive radix tree (`radix`); only depths that end a turn are
nodes of the trie. What a task says of a node is added up over the tasks that
share it: these are the prefixes of the first and last string of each task, few
rows, as every task knows the strings next to its own (``Edges``) and counts
nothing that an earlier one has counted.

Conversations of any length are cut into segments of ``SEGMENT`` turns. A
segment is one string, and belongs to the tree of all segments that follow the
same turns (a sum of position-bound digests, so that it is found without
reading a conversation in one go). The node between two segments is the root of
the later one's tree, and each conversation that reaches it has a row there. A
tree's leaves and saved bytes are given to the tree's smallest conversation, and
so are counted once at every node above it.

Defined results: rows without conv_id belong to no conversation; equal rows are
turns of their own; rows with equal conv_id and turn (null turns come first)
are in the order of their ids; a null role or text is an empty one; an empty
table has no nodes; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowcubes.llm.common import cut, map_batches
from flowcubes.llm.radix import Node, Tree

#: Bytes of a turn's id.
WIDTH = 16
#: Turns of a segment.
SEGMENT = 256
#: A conversation takes its first turns from that of the next lower multiple of
#: ``FAMILY``: as many as the checksum of its id modulo ``SHARED`` says.
FAMILY, SHARED = 5, 9
#: Turns that one task puts into its trees.
TASK_TURNS = 250_000
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
EMPTY = hashlib.sha256(b"").hexdigest()


def share(conv_id: str) -> Column:
    """How many turns a conversation takes from another."""
    return (F.crc32(F.col(conv_id).cast("string").cast("binary")) % SHARED).cast("int")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, family, turn, id, size): the texts end here."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    # the length keeps the end of the role apart from the start of the text
    spelled = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        conv.alias("conv_id"), (conv - F.pmod(conv, F.lit(FAMILY))).alias("family"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(spelled.cast("binary"), 256), 1, 2 * WIDTH)).alias("id"), F.octet_length(text).cast("long").alias("size"))


def ordered(rows: DataFrame, per_task: int) -> DataFrame:
    """Turns in order, each with its place among those of its conversation in
    the same task, ``part`` (family, conv_id, part, at, id, size)."""
    tasks = max(1, -(-rows.count() // per_task))
    keys = ["family", "conv_id", F.asc_nulls_first("turn"), "id"]
    rows = rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)

    def start():
        state = {"conv": None, "at": 0}

        def step(batch: pa.RecordBatch) -> dict:
            at, conv, n = [], state["conv"], state["at"]
            for c in batch.column("conv_id").to_pylist():
                n = n + 1 if c == conv else 1
                conv = c
                at.append(n)
            state["conv"], state["at"] = conv, n
            return {c: batch.column(c) for c in ("family", "conv_id", "part", "id", "size")} | {"at": at}
        return step

    rows = rows.withColumn("part", F.spark_partition_id())
    return cut(map_batches(rows, start, "family long, conv_id long, part int, at long, id binary, size long"))


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, id, size) of the rebuilt conversations, depths from 1,
    and the number of turns of each, 0 included. Only one row a conversation and
    task is gathered, never its turns."""
    runs = rows.groupBy("family", "conv_id", "part").agg(F.count("*").alias("n"))
    family = W.partitionBy("family")
    before = W.partitionBy("family", "conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                       F.coalesce(F.sum(F.when(F.col("family") == F.col("conv_id"), F.col("n"))).over(family), F.lit(0)).alias("given"))
    runs = cut(runs.withColumn("h", share("conv_id")).withColumn("taken", F.least("h", "given")))
    convs = runs.groupBy("conv_id").agg(F.first("family").alias("family"), F.first("h").alias("h"), F.first("taken").alias("taken"), F.sum("n").alias("n"))
    own = rows.join(runs.select("conv_id", "part", "before", "h", "taken"), ["conv_id", "part"])
    own = own.withColumn("place", F.col("before") + F.col("at")).where("place > h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "id", "size")
    # the first turns of the family's first conversation, to all that are there
    first = rows.where(f"conv_id = family and at < {SHARED}").join(runs.select("conv_id", "part", "before"), ["conv_id", "part"])
    first = first.withColumn("depth", F.col("before") + F.col("at")).where(f"depth < {SHARED}").select("family", "depth", "id", "size")
    lent = convs.select("conv_id", "family", "h").join(first, "family").where("depth <= h").select("conv_id", "depth", "id", "size")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    return own.unionByName(lent), lengths


LANES = 4


def segments(rows: DataFrame, lengths: DataFrame, size: int) -> DataFrame:
    """One string a segment: (seg, prefix, key, conv_id, ends, sizes, top, next).
    ``top`` is the size of the turn before the segment, ``next`` the prefix of
    the following one; a conversation that fills its last segment has an empty
    one after it."""
    rows = rows.withColumn("seg", F.floor((F.col("depth") - 1) / size).cast("long"))
    packed = rows.groupBy("conv_id", "seg").agg(F.array_sort(F.collect_list(F.struct("depth", "id", "size"))).alias("t"))  # ``size`` turns at most
    packed = packed.select("conv_id", "seg", F.array_join(F.transform("t", lambda x: F.hex(x["id"])), "").alias("key"), F.transform("t", lambda x: x["size"]).alias("sizes"))
    # a conversation that ends with a full segment, or has no turn, ends in an empty one
    tail = lengths.where(F.col("n_turns") % size == 0).select("conv_id", F.floor(F.col("n_turns") / size).cast("long").alias("seg"), F.lit("").alias("key"), F.expr("array()").cast("array<long>").alias("sizes"))
    packed = packed.unionByName(tail)
    own = F.sha2(F.concat_ws(":", "seg", "key"), 256)
    lanes = [F.conv(F.substring(own, 8 * i + 1, 8), 16, 10).cast("long") for i in range(LANES)]  # 32 bits each: their sums do not overflow
    packed = packed.select("*", *(x.alias(f"lane{i}") for i, x in enumerate(lanes)))
    order = W.partitionBy("conv_id").orderBy("seg")
    before, until = (order.rowsBetween(W.unboundedPreceding, end) for end in (-1, W.currentRow))

    def prefix(frame) -> Column:
        return F.concat_ws(":", *(F.sum(f"lane{i}").over(frame) for i in range(LANES)))

    ends = F.lead("seg").over(order).isNull()
    out = packed.select("seg", F.when(F.col("seg") == 0, "").otherwise(prefix(before)).alias("prefix"), F.unhex("key").alias("key"), "conv_id", ends.alias("ends"), "sizes",
                        F.coalesce(F.element_at(F.lag("sizes").over(order), -1), F.lit(0)).alias("top"), F.when(~ends, prefix(until)).alias("next"))
    return out


class Edges(NamedTuple):
    """The strings next to a task's own, as (seg, prefix, key): the last of the
    task before, the first of the task after, and the first one after this
    task's last that differs from it."""

    before: tuple | None
    first: tuple | None
    after: tuple | None


def edges(rows: DataFrame) -> dict[int, Edges]:
    """`Edges` of every task, from three strings of each: no more rows than
    tasks come to the driver, of ``SEGMENT`` ids at most."""
    kind = T.StructType.fromDDL("part int, place int, seg long, prefix string, key binary")
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list = []  # the first, the first other one, the last
        part = 0
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column("part")[0].as_py()
            groups = b.select(["seg", "prefix", "key"])
            for i in range(b.num_rows) if len(found) < 2 else ():
                row = tuple(c[i].as_py() for c in groups.columns)
                if not found or row != found[0]:
                    found.append(row)
                    if len(found) == 2:
                        break
            last = tuple(c[b.num_rows - 1].as_py() for c in groups.columns)
        if found:
            rows = [*((0 if i == 0 else 1, *r) for i, r in enumerate(found)), (2, *last)]
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, (part, *r))) for r in rows], schema=arrow)

    at: dict[int, dict[int, tuple]] = {}
    for r in rows.select("part", "seg", "prefix", "key").mapInArrow(run, kind).collect():
        at.setdefault(r["part"], {})[r["place"]] = (r["seg"], r["prefix"], bytes(r["key"]))
    parts = sorted(at)
    out = {}
    for i, part in enumerate(parts):
        last, after = at[part][2], None
        for later in parts[i + 1:]:
            after = next((at[later][p] for p in (0, 1) if p in at[later] and at[later][p] != last), None)
            if after:
                break
        out[part] = Edges(at[parts[i - 1]][2] if i else None, at[parts[i + 1]][0] if i + 1 < len(parts) else None, after)
    return out


#: What a task says of a node. ``open``: other tasks may say more of it. ``mark``
#: and ``parent_mark`` name open nodes; ``stub`` rows name a node between two
#: segments by its prefix and give its parent. ``total`` counts the bytes of all
#: members at and below the node, ``once`` those of every node there.
SAID = ("seg long, prefix string, depth long, conv_id long, n_convs long, n_children long, n_leaves long, total long, once long, more long, ends string, "
        "ids string, open boolean, mark string, parent_conv_id long, parent_mark string, stub string, part int, own_leaves long")


class Totals:
    """Of a node of the radix tree and all below it."""

    __slots__ = ("n", "least", "row", "total", "once", "more", "leaves", "own_leaves", "tops", "fresh_tops")

    def __init__(self) -> None:
        self.n = self.total = self.once = self.more = self.leaves = self.own_leaves = self.tops = self.fresh_tops = 0
        self.least = self.row = None


class Forest:
    """The radix trees of one task."""

    def __init__(self, edge: Edges, part: int, size: int):
        self.edge, self.part, self.size = edge, part, size

    def of(self, seg: int, prefix: str, rows: list[dict]) -> Iterator[dict]:
        """The nodes of one tree: ``rows`` (conv_id, key, sizes, ends, top, next,
        leaves, saved) in the order of key and conv_id."""
        here = (seg, prefix)
        before, first, after = (e[2] if e and e[:2] == here else None for e in self.edge)
        tree = Tree()
        for r in rows:
            tree.insert(r["key"], r)
        last = rows[-1]["key"]
        extends_last = after is not None and after.startswith(last)

        def common(other: bytes | None, key: bytes) -> int:
            """Turns that a string begins with alike; -1 for no string."""
            if other is None:
                return -1
            n = min(len(other), len(key)) // WIDTH
            return next((i for i in range(n) if other[i * WIDTH:(i + 1) * WIDTH] != key[i * WIDTH:(i + 1) * WIDTH]), n)

        order: list[tuple[Node, int, int | None]] = []  # node, bytes above it, its parent's place
        stack: list[tuple[Node, int, int | None]] = [(tree.root, 0, None)]
        while stack:
            node, above, parent = stack.pop()
            at = len(order)
            order.append((node, above, parent))
            stack += [(child, above + len(node.path), at) for child in node.children()]
        totals = [Totals() for _ in order]
        seen_to, open_to = [-1] * len(order), [-1] * len(order)

        def levels(i: int) -> tuple[int, int]:
            """First and last depth in this segment whose nodes lie on the path of a node."""
            node, above, _ = order[i]
            return (0 if i == 0 else above // WIDTH + 1), (above + len(node.path)) // WIDTH

        def size_at(row: dict, depth: int) -> int:
            return row["sizes"][depth - 1] if depth else row["top"]

        for i in range(len(order) - 1, -1, -1):
            node, _, parent = order[i]
            t = totals[i]
            lo, hi = levels(i)
            for r in node.values:
                t.n += 1
                t.more += r["saved"]
                t.leaves += r["leaves"]
                if t.least is None or r["conv_id"] < t.least:
                    t.least = r["conv_id"]
                t.row = t.row or r
            key = t.row["key"]
            seen_to[i] = max(common(before, key), -1)
            open_to[i] = max(seen_to[i], common(first, key))
            # a conversation ends here, nothing goes on from here, and no earlier task has said so
            if node.values and node.values[0]["ends"] and not t.tops and seen_to[i] < hi and not (key == last and extends_last):
                t.leaves += 1
                t.own_leaves += 1
            for depth in range(lo, min(hi, self.size - 1) + 1):
                t.total += t.n * size_at(t.row, depth)
                t.once += size_at(t.row, depth) if depth > seen_to[i] else 0
            if parent is not None:
                p = totals[parent]
                p.n += t.n
                p.total += t.total
                p.once += t.once
                p.more += t.more
                p.leaves += t.leaves
                p.own_leaves += t.own_leaves
                p.row = t.row if p.row is None else p.row
                p.least = t.least if p.least is None else min(p.least, t.least)
                # the nodes one turn below the parent's: this one's first, or those below it
                p.tops += 1 if lo <= hi else t.tops
                p.fresh_tops += (seen_to[i] < lo) if lo <= hi else t.fresh_tops

        def mark(key: bytes, depth: int) -> str:
            return hashlib.blake2b(key[:depth * WIDTH], digest_size=16).hexdigest()

        #: of each radix node: the last trie node on or above its path, as (conv_id, depth, open)
        reached: list[tuple | None] = [None] * len(order)
        for i, (node, _, parent) in enumerate(order):
            t = totals[i]
            lo, hi = levels(i)
            key = t.row["key"]
            above = reached[parent] if parent is not None else None
            # upper nodes of a path count what is below them, from its end up
            below_total = below_once = 0
            if hi >= lo:
                full = min(hi, self.size - 1)
                below_total, below_once = t.total, t.once
            for depth in range(lo, hi + 1):
                is_open = depth <= open_to[i]
                out = dict.fromkeys(SAID_NAMES)
                out |= {"seg": seg, "prefix": prefix, "depth": seg * self.size + depth, "conv_id": t.least, "part": self.part,
                        "parent_conv_id": above[0] if above and not above[2] else None, "parent_mark": mark(key, depth - 1) if above and above[2] else None}
                if depth == self.size:
                    yield out | {"stub": t.row["next"], "open": False}
                    break
                ending = depth == hi and node.values and node.values[0]["ends"]
                ids = ",".join(str(r["conv_id"]) for r in node.values) if ending else ""
                children, fresh = (t.tops, t.fresh_tops) if depth == hi else (1, int(depth + 1 > seen_to[i]))
                out |= {"n_convs": t.n, "n_children": fresh if is_open else children, "n_leaves": t.leaves, "own_leaves": t.own_leaves, "total": below_total, "once": below_once, "more": t.more, "open": is_open}
                out |= {"mark": mark(key, depth), "ids": ids or None} if is_open else {"ends": hashlib.sha256(ids.encode()).hexdigest() if ids else EMPTY}
                yield out
                below_total -= t.n * size_at(t.row, depth)
                below_once -= size_at(t.row, depth) if depth > seen_to[i] else 0
                above = (t.least, depth, is_open)
            reached[i] = above


SAID_NAMES = [field.split()[0] for field in SAID.split(", ")]


def said(rows: DataFrame, size: int, per_task: int) -> DataFrame:
    """What the tasks say of the nodes of all trees (``SAID``)."""
    keys = ["seg", "prefix", "key", "conv_id"]
    turns_held = rows.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    placed = rows.repartitionByRange(max(1, -(-turns_held // per_task)), *keys).sortWithinPartitions(*keys)
    placed = cut(placed.withColumn("part", F.spark_partition_id()))  # the same ranges for the edges and the trees
    around = edges(placed)
    arrow = to_arrow_schema(T.StructType.fromDDL(SAID))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, forest, out = None, [], None, []

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, schema=arrow)
            out.clear()
            return made

        def grown() -> Iterator[pa.RecordBatch]:
            for node in forest.of(*group, held):
                out.append(node)
                if len(out) == 2_000:
                    yield flush()
            held.clear()

        for batch in batches:
            for r in batch.to_pylist():
                forest = forest or Forest(around[r["part"]], r["part"], size)
                if (r["seg"], r["prefix"]) != group:
                    if held:
                        yield from grown()
                    group = (r["seg"], r["prefix"])
                held.append(r)
        if held:
            yield from grown()
        if out:
            yield flush()

    return cut(placed.mapInArrow(run, SAID))


def merged(parts: DataFrame) -> DataFrame:
    """The open nodes, each once: prefixes of the edges of tasks, so no more than
    two strings a task, ``SEGMENT`` nodes each."""
    nodes = parts.where("open").groupBy("seg", "prefix", "depth", "mark").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "own_leaves", "total", "once", "more")), F.max("parent_mark").alias("parent_mark"))
    ids = parts.where("ids is not null").select("seg", "prefix", "depth", "mark", "part", "ids")

    def start() -> Callable[[pa.RecordBatch], dict | None]:
        state: dict = {"of": None, "sha": None}

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in ("seg", "prefix", "depth", "mark", "ends", "at")}
            for r in batch.to_pylist():
                of = tuple(r[c] for c in ("seg", "prefix", "depth", "mark"))
                if of == state["of"]:
                    state["sha"].update(b"," + r["ids"].encode())
                else:
                    state.update(of=of, sha=hashlib.sha256(r["ids"].encode()))
                for c, v in zip(("seg", "prefix", "depth", "mark"), of):
                    out[c].append(v)
                out["ends"].append(state["sha"].hexdigest())
                out["at"].append(r["part"])
            return out
        return step

    # the texts of a node's ids pass one after the other; the last digest is that of all
    key = ["seg", "prefix", "depth", "mark"]
    digests = map_batches(ids.repartition(*key).sortWithinPartitions(*key, "part"), start, "seg long, prefix string, depth long, mark string, ends string, at int")
    digests = digests.groupBy(*key).agg(F.max_by("ends", "at").alias("ends"))
    return cut(nodes.join(digests, key, "left").withColumn("ends", F.coalesce("ends", F.lit(EMPTY))))


def trie(conversations: DataFrame, segment: int = SEGMENT, per_task: int = TASK_TURNS) -> DataFrame:
    """One row per node: conv_id (the smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, lengths = rebuilt(ordered(cut(turns(conversations)), per_task))
    strings = segments(rows, lengths, segment)
    none = [F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved")]
    strings = cut(strings.select("*", *none))
    deep = not strings.where("seg > 0").isEmpty()
    if deep:
        strings = cut(_with_later(strings, segment, per_task))
    parts = said(strings, segment, per_task)
    whole = merged(parts)
    saved = F.col("total") - F.col("once") + F.col("more")
    columns = ["seg", "prefix", "depth", "conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    parents = F.broadcast(whole.select("seg", "prefix", (F.col("depth") + 1).alias("depth"), F.col("mark").alias("parent_mark"), F.col("conv_id").alias("parent")))  # few: see `merged`
    found = parts.where("not open").select(*columns, "stub", "parent_conv_id", "parent_mark").unionByName(
        whole.select(*columns, F.lit(None).cast("string").alias("stub"), F.lit(None).cast("long").alias("parent_conv_id"), "parent_mark"))
    found = found.join(parents, ["seg", "prefix", "depth", "parent_mark"], "left").withColumn("parent_conv_id", F.coalesce("parent", "parent_conv_id")).drop("parent", "parent_mark")
    if not deep:
        return found.drop("stub").select(*COLUMNS)
    found = cut(found)
    between = found.where("stub is not null").groupBy(F.col("stub").alias("prefix"), (F.col("seg") + 1).alias("seg")).agg(F.min("parent_conv_id").alias("up"))
    roots = found.where((F.col("seg") > 0) & (F.col("depth") == F.col("seg") * segment)).where("stub is null").drop("parent_conv_id", "stub")
    roots = roots.join(between, ["seg", "prefix"], "left").withColumnRenamed("up", "parent_conv_id")
    rest = found.where(~((F.col("seg") > 0) & (F.col("depth") == F.col("seg") * segment)) & F.col("stub").isNull()).drop("stub")
    return rest.unionByName(roots).select(*COLUMNS)


def _with_later(strings: DataFrame, segment: int, per_task: int) -> DataFrame:
    """The segments with, for each conversation, the leaves and saved bytes of
    the later trees of which it is the smallest."""
    parts = said(strings.where("seg > 0"), segment, per_task)
    root = F.col("depth") == F.col("seg") * segment
    whole = merged(parts.where(root | F.col("open")))
    columns = ["seg", "prefix", "conv_id", F.col("own_leaves").alias("tree_leaves"), (F.col("total") - F.col("once")).alias("tree_saved")]
    trees = parts.where("not open and stub is null").where(root).select(*columns).unionByName(whole.where(root).select(*columns))
    later = W.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(W.unboundedPreceding, -1)
    both = strings.drop("leaves", "saved").join(trees, ["seg", "prefix", "conv_id"], "left")
    return both.select("*", *(F.coalesce(F.sum(f"tree_{c}").over(later), F.lit(0)).alias(c) for c in ("leaves", "saved"))).drop("tree_leaves", "tree_saved")


#: The same rows in DuckDB. The checksum is worked out bit by bit (polynomial 0xEDB88320).
TWIN = """
WITH said AS (
    SELECT conv_id AS c, turn, octet_length(encode(coalesce(text, ''))) AS size,
           left(sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS id
    FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT c, size, id, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, id) AS place FROM said
), convs AS (
    SELECT c, c - c % 5 AS family, count(*) AS n,
           (4294967295 - list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
               lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)) + y))) % 9 AS h
    FROM placed GROUP BY c
), rebuilt AS (
    SELECT v.c, d.place AS depth, d.id, d.size FROM convs v JOIN placed d ON d.c = v.family AND d.place <= v.h
    UNION ALL
    SELECT v.c, o.place - v.h + least(v.h, coalesce(b.n, 0)), o.id, o.size
    FROM convs v JOIN placed o ON o.c = v.c AND o.place > v.h LEFT JOIN convs b ON b.c = v.family
), paths AS (
    SELECT c, depth, size, string_agg(id, '') OVER (PARTITION BY c ORDER BY depth) AS path FROM rebuilt
    UNION ALL SELECT c, 0, 0, '' FROM convs
), lengths AS (
    SELECT c, max(depth) AS n_turns FROM paths GROUP BY c
), nodes AS (
    SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
           coalesce(string_agg(CASE WHEN depth = n_turns THEN c::VARCHAR END, ',' ORDER BY c), '') AS ids
    FROM paths JOIN lengths USING (c) GROUP BY path, depth
), counted AS (
    SELECT u.*, (SELECT count(*) FROM nodes v WHERE v.depth = u.depth + 1 AND starts_with(v.path, u.path)) AS n_children FROM nodes u
), upward AS (
    SELECT left(path, 32 * unnest(range(depth + 1))::INT) AS path, n_children, n_convs, size FROM counted
), summed AS (
    SELECT path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved FROM upward GROUP BY path
)
SELECT u.conv_id, u.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, u.n_convs::BIGINT AS n_convs, u.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(u.ids) AS ends_sha256
FROM counted u JOIN summed s USING (path) LEFT JOIN nodes p ON u.depth > 0 AND p.path = left(u.path, 32 * (u.depth - 1)::INT)
"""
