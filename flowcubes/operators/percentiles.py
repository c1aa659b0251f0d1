"""Exact discrete percentiles by distributed selection.

``percentile_disc`` keeps one count per distinct value of a group and merges
them in a single task, so a hot group (one day or one resolver holding a
third of all rows) is unbounded there. This operator gets the same exact
answer -- the value of rank ``max(1, ceil(p * n))`` in the group's sorted
non-NULL values -- by narrowing a bracket of values around each answer:

1. one aggregate per group: the count, the extremes and a fixed-size
   ``percentile_approx`` sketch read at ``p - m`` and ``p + m``; with rank
   error at most ``n / accuracy`` and ``m = 3 / accuracy`` the exact answer
   lies inside that bracket, and at most ``8 n / accuracy`` values lie
   strictly between its ends;
2. while a bracket may still hold more than ``last`` values between its ends,
   one more aggregate over the rows of such brackets: how many lie below,
   on the lower end and between, and a sketch of those between read on a
   grid of ranks. The grid cells around the rank that is left become the new
   bracket, so each round leaves about a hundredth of the values;
3. one pass counts the values of each bracket, and a window over them, at
   most ``last`` and the two ends, finds the first one whose cumulative rank
   reaches the target.

Every pass aggregates before it shuffles: sketches in 1 and 2, one row a task
of all that lies below and the values of the brackets, spread by value, in 3.
The brackets of the ``groups`` largest groups (one short row each) go to the
tasks as a broadcast of that proven size. Only when there are more groups
are the rows of the others joined on the group, and each of those has at most
``1 / groups`` of all rows.

Spark documents the sketch's bound as ``floor((p - e) n) <= rank <=
ceil((p + e) n)`` with ``e = 1 / accuracy``, so the brackets always hold; a
miss would raise instead of returning a wrong value. Building the result runs
the aggregates of 1 and 2; the pass of 3 runs with the caller's action.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 10_000
LAST = 1_000_000   # values a bracket may hold in the last window
GROUPS = 20_000    # groups whose brackets are broadcast, the largest first
FEW = 100          # and the fewest that ``last`` may ask for
GRID = 200         # ranks at which a narrowing round reads its sketch


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, ps: Mapping[str, float],
                      accuracy: int = ACCURACY, last: int = LAST, groups: int = GROUPS) -> DataFrame:
    """``keys`` + one DOUBLE column per entry of ``ps`` (name -> p), one row
    per group with at least one non-NULL value; NULL is a key like any other.
    ``keys=()`` is a global percentile (one row, or none for empty input)."""
    names, probs = list(ps), [float(ps[n]) for n in ps]
    gk = list(keys) or ["_g"]
    src = df if keys else df.withColumn("_g", F.lit(0))
    base = src.select(*gk, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())

    bounds = _first_brackets(base, gk, probs, accuracy)
    largest = bounds.orderBy(F.col("_n").desc()).limit(groups + 1).collect()
    known, more = largest[:groups], len(largest) > groups
    brackets = [[(r["_lo"][i], r["_hi"][i]) for i in range(len(probs))] for r in known]
    _narrow(base, keys, known, brackets, accuracy, max(last, FEW))

    tagged = _tagged(_attach(base, keys, known, [
        (*map(list, zip(*b)), r["_k"]) for b, r in zip(brackets, known)], "_lo array<double>, _hi array<double>, _k array<bigint>"),
        gk, len(probs))
    if more:  # smaller groups than any of the known: none has 1 / groups of the rows
        met = _same(gk, "_s_")
        keys_of = F.broadcast(_frame(base, gk, known, [()] * len(known), T.StructType()))
        other = bounds.join(keys_of, met, "left_anti").select(
            *[F.col(k).alias("_s_" + k) for k in gk], "_lo", "_hi", "_k")
        rest = base.join(keys_of, met, "left_anti").join(other, met)
        tagged = tagged.unionByName(_tagged(rest, gk, len(probs)))

    # Counting per (group, i, value) and summing in value order, the rows below
    # as a NULL first, gives every value of a bracket its exact rank.
    counts = tagged.groupBy(*gk, "_i", "_bv").agg(F.count(F.lit(1)).alias("_c"), F.max("_k").alias("_k"))
    w = (Window.partitionBy(*gk, "_i").orderBy(F.col("_bv").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.select(*gk, "_i", "_bv", "_k", F.sum("_c").over(w).alias("_cum"))
    # Cumulative ranks only grow along a bracket, so the answer is the smallest
    # value whose rank reaches the target. Every group has tagged rows (its
    # minimum is below the bracket or in it), so it appears even on a miss.
    hit = F.col("_bv").isNotNull() & (F.col("_cum") >= F.col("_k"))
    wide = ranked.groupBy(*gk).agg(*[F.min(F.when(hit & (F.col("_i") == i), F.col("_bv"))).alias(names[i])
                                     for i in range(len(probs))])
    out = wide.select(*gk, *[
        F.when(F.col(n).isNull(), F.raise_error(F.lit(f"percentile bracket missed for {n}")))
        .otherwise(F.col(n)).cast("double").alias(n)
        for n in names
    ])
    return out if keys else out.drop("_g")


def _first_brackets(base: DataFrame, gk: list[str], probs: list[float], accuracy: int) -> DataFrame:
    """Per group: its count, and by percentile the lower and upper end of the
    bracket and the target rank."""
    m = 3.0 / accuracy
    lows, highs = [max(0.0, p - m) for p in probs], [min(1.0, p + m) for p in probs]
    stats = base.groupBy(*gk).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", lows + highs, accuracy).alias("_q"))
    return stats.select(
        *gk, "_n",
        F.array(*[F.col("_min") if p == 0.0 else F.col("_q")[i] for i, p in enumerate(lows)]).alias("_lo"),
        F.array(*[F.col("_max") if p == 1.0 else F.col("_q")[len(lows) + i]
                  for i, p in enumerate(highs)]).alias("_hi"),
        F.array(*[F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("_n"))).cast("bigint") for p in probs]).alias("_k"))


def _narrow(base: DataFrame, keys: Sequence[str], known: list, brackets: list, accuracy: int, last: int) -> None:
    """Narrow, in place, every bracket that may hold more than ``last`` values
    between its ends. Such groups are large, so they are few."""
    between = {(g, i): 8 * r["_n"] // accuracy + 1 for g, r in enumerate(known) for i in range(len(brackets[g]))}
    while True:
        wide = [at for at, n in between.items() if n > last and brackets[at[0]][at[1]][0] < brackets[at[0]][at[1]][1]]
        if not wide:
            return
        spots = {}
        for g, i in wide:
            spots.setdefault(g, []).append((i, *brackets[g][i], known[g]["_k"][i]))
        near = _attach(base, keys, [known[g] for g in spots], [(g, *map(list, zip(*s))) for g, s in spots.items()],
                       "_at int, _i array<int>, _lo array<double>, _hi array<double>, _k array<bigint>")
        v, lo, hi = F.col("_v"), F.col("_b._lo"), F.col("_b._hi")
        inside = (v > lo) & (v < hi)
        found = (
            near.select("_at", "_v", F.explode(F.arrays_zip("_i", "_lo", "_hi", "_k")).alias("_b")).where(v < hi)
            .groupBy("_at", F.col("_b._i").alias("_i"), lo.alias("_lo"), hi.alias("_hi"), F.col("_b._k").alias("_k"))
            .agg(F.count_if(v <= lo).alias("_to_lo"), F.count_if(inside).alias("_in"),
                 F.percentile_approx(F.when(inside, v), [j / GRID for j in range(GRID + 1)], accuracy).alias("_q"))
        ).collect()  # a row a bracket
        for r in found:
            lo, hi, left = r["_lo"], r["_hi"], r["_k"] - r["_to_lo"]
            if left <= 0:
                new, size = (lo, lo), 0
            elif left > r["_in"]:
                new, size = (hi, hi), 0
            else:
                new, size = _cells(r["_q"], left, r["_in"], lo, hi, accuracy)
            brackets[r["_at"]][r["_i"]] = new
            between[r["_at"], r["_i"]] = min(size, between[r["_at"], r["_i"]] - 1)


def _cells(grid: list[float], left: int, n: int, lo: float, hi: float, accuracy: int) -> tuple[tuple[float, float], int]:
    """The grid points that enclose rank ``left`` of n for certain, and how
    many values lie strictly between them at most. The sketch may be off by
    e n + 1 ranks, and reads a rank on either side of a whole one."""
    slack = n / accuracy + 2
    low = int((left - slack) * GRID / n)
    while low >= 0 and low * n / GRID + slack > left:
        low -= 1
    high = int((left + slack) * GRID / n)
    while high <= GRID and high * n / GRID - slack < left:
        high += 1
    start, end = (low if low >= 0 else 0), (high if high <= GRID else GRID)
    size = int((end - start) * n / GRID + 2 * slack) + 1
    return (grid[low] if low >= 0 else lo, grid[high] if high <= GRID else hi), size


def _frame(base: DataFrame, gk: Sequence[str], known: list, values: list, more: T.StructType) -> DataFrame:
    """The known groups' keys, under a prefix, and their values."""
    fields = [T.StructField("_s_" + k, base.schema[k].dataType) for k in gk]
    return base.sparkSession.createDataFrame(
        [(*[r[k] for k in gk], *v) for r, v in zip(known, values)], T.StructType(fields + more.fields))


def _attach(base: DataFrame, keys: Sequence[str], known: list, values: list, columns: str) -> DataFrame:
    """The rows of the known groups with their group's values: a broadcast join
    on the keys, or literals where there is but one group."""
    more = T.StructType.fromDDL(columns)
    if keys:
        return base.join(F.broadcast(_frame(base, keys, known, values, more)), _same(keys, "_s_"))
    row = values[0] if values else [None] * len(more)
    cols = [F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(row, more.fields)]
    return base.select("*", *cols).where(F.lit(bool(values)))


def _same(gk: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in gk])


def _tagged(rows: DataFrame, gk: list[str], n: int) -> DataFrame:
    """A row below a bracket becomes (i, NULL), a row in it (i, value); rows
    above it go. Each carries its target rank."""
    v = F.col("_v")
    tags = F.array(*[
        F.when(v <= F.col("_hi")[i],
               F.struct(F.lit(i).alias("i"), F.when(v >= F.col("_lo")[i], v).alias("v"), F.col("_k")[i].alias("k")))
        for i in range(n)])
    return (rows.select(*gk, F.explode(tags).alias("_t")).where(F.col("_t").isNotNull())
            .select(*gk, F.col("_t.i").alias("_i"), F.col("_t.v").alias("_bv"), F.col("_t.k").alias("_k")))


def percentiles(df: DataFrame, keys: Sequence[str], value: str, ps: Mapping[str, float],
                exact: bool = True, accuracy: int = ACCURACY) -> DataFrame:
    """Per-group percentiles: exact (``exact_percentiles``) or one-pass
    approximate sketches (``percentile_approx``, rank error n / accuracy)."""
    if exact:
        return exact_percentiles(df, keys, value, ps, accuracy)
    v = F.col(value).cast("double")
    aggs = [F.percentile_approx(v, p, accuracy).cast("double").alias(n) for n, p in ps.items()]
    base = df.where(v.isNotNull())
    return base.groupBy(*keys).agg(*aggs) if keys else base.agg(*aggs).where(F.col(list(ps)[0]).isNotNull())
