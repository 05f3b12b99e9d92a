"""Mixing of sources to target weights by subset-sum budget fitting (operator 5).

Sizes are words. Every source gets a target; what whole passes over the source don't fill is its remaining budget. From
a histogram of exact sizes each size gives about the same share of its documents, a few less, and a bounded-knapsack
dynamic program over all that are left fits the rest as closely as it can. Then documents are selected within each size by a seeded hash, as many as the histogram plan says.

The plan of a source reads its histogram, never its documents: it is bounded by the number of different sizes.
Documents of one size are dealt into slices of the seeded hash; only the slice in which the cut falls ranks its rows,
so one size or one source may hold most of all rows.

Edge cases: a null text has size 0; documents of size 0 are never taken. A null source is one source, after all others.
Repeated rows are different documents to the mix. Rows without an id are drawn by their text. Ties of the seeded hash go
by id. Texts are counted whole by the JVM, whatever their length. An empty table gives an empty table. ``mix`` returns no
other columns; ``take`` returns all of them, whatever their names, and no more.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitforge.storage import written

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
#: Sums that the dynamic program keeps, about, and documents that are left to it.
SUMS, ROOM = 1 << 17, 4096
#: Rows of one (source, size, slice) that are ranked together, about.
SLICE_ROWS = 50_000
#: Sources, and ids with their copies, that may be broadcast after a count; more go through a shuffle join.
BROADCAST_SOURCES, BROADCAST_IDS = 10_000, 1_000_000


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target from one row for each source.

    Resharing what lies above the limits by weight ends where every source has a common rate times its weight, or its
    limit. Each round finds the sources that the rate of the last one brings to their limits, until none is new: rounds are
    sums over the sources, of which there may be very many.
    """
    sized = written(_numbered(sources).withColumn("bound", F.col("source_size") * most).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))))
    whole, rate, full = share * (sized.agg(F.sum("source_size")).first()[0] or 0), 0.0, -1
    while True:
        over = F.col("bound") < rate * F.col("weight")
        n, bounds, free = sized.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("bound"))), F.lit(0.0)), F.sum(F.when(~over, F.col("weight")))).first()
        if n == full or not free:
            break
        full, rate = n, (whole - bounds) / free
    target = F.least("bound", rate * F.col("weight")) if free else F.col("bound")
    return sized.select("source", "source_size", target.cast("double").alias("target"))


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, from 1 on in order of names by code point, null last: ranges of names, and their offsets."""
    ranges = written(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", before.alias("before"))
    inner = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last()))
    return ranges.withColumn("inner", inner).join(offsets, "range").withColumn("place", F.col("inner") + F.col("before")).drop("range", "inner", "before")


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many documents of each of the ascending ``sizes`` to take, so that their words come near to ``budget``.

    Even shares but for some documents of each size, then the dynamic program, then exchanges of single documents of any
    size while they come nearer.
    Sizes are divided by what they have in common.
    """
    unit = int(np.gcd.reduce(sizes)) or 1
    sizes, budget = sizes // unit, (budget + unit // 2) // unit
    return _nearer(sizes, counts, _filled(sizes, counts, budget, seed), budget)


def _filled(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """Even shares, less a slack of documents of each size, and the program for all that this leaves open.

    The slack is ROOM documents over all sizes: a source of few documents is wholly the program's, and of one with many sizes
    at least one document of each is. The program keeps the sums that it reaches, and the step that first reached each; sizes
    are added in seeded order, with counts in powers of two. Where there can be more than SUMS sums and they are larger than
    that, it keeps one for each stretch of equal width.
    """
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return np.zeros(len(sizes), np.int64)
    if budget >= total:
        return counts.astype(np.int64)
    slack = max(1, ROOM // len(sizes))
    taken = np.array([max(0, int(c) * budget // total - slack) for c in counts.tolist()], np.int64)
    goal = budget - int((sizes * taken).sum())
    # sums beyond the goal by up to one document may be nearer than those below it
    most = goal + min(goal, int(sizes.max()))
    few = float(np.log2(counts - taken + 1.0).sum()) <= np.log2(SUMS)
    width = 1 if few else most // SUMS + 1
    sums, before, by, steps = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), []
    reached = None if few else np.zeros(most // width + 1, bool)
    if not few:
        reached[0] = True
    for i in np.random.default_rng(seed).permutation(len(sizes)):
        size = int(sizes[i])
        have, power = min(int(counts[i] - taken[i]), most // size) if size else 0, 1
        while have > 0 and not (reached[goal // width] if not few else (sums == goal).any()):
            n = min(power, have)
            old = np.flatnonzero(sums + n * size <= most)
            new = (sums[old] + n * size) // width
            if few:
                fresh = old[~np.isin(new, sums)]
            else:
                old, new = old[~reached[new]], new[~reached[new]]
                first = np.empty(len(reached), np.int64)
                first[new[::-1]] = old[::-1]  # of those that fall together the one that was reached first
                fresh = first[new[first[new] == old]]
                reached[new] = True
            sums, before, by = np.append(sums, sums[fresh] + n * size), np.append(before, fresh), np.append(by, np.full(len(fresh), len(steps)))
            steps.append((int(i), n))
            have, power = have - n, power * 2
    at = int(np.lexsort((sums, np.abs(sums - goal)))[0])  # of two that are equally near, the smaller
    while at:
        i, n = steps[by[at]]
        taken[i] += n
        at = int(before[at])
    return taken


def _nearer(sizes: np.ndarray, counts: np.ndarray, taken: np.ndarray, budget: int) -> np.ndarray:
    """``taken`` after adding, leaving out or exchanging single documents of any size, as long as that comes nearer."""
    some = sizes > 0
    while off := budget - int((sizes * taken).sum()):
        more, less = np.flatnonzero(some & (taken < counts)), np.flatnonzero(some & (taken > 0))
        gains, losses = np.append(0, sizes[more]), np.append(0, sizes[less])  # in order of size
        at = np.searchsorted(gains, losses + off)
        tries = [(abs(int(off - gains[g] + losses[k])), g, k) for c in (at - 1, at) for k, g in enumerate(np.clip(c, 0, len(gains) - 1).tolist())]
        left, g, k = min(tries)
        if left >= abs(off):
            break
        if g:
            taken[more[g - 1]] += 1
        if k:
            taken[less[k - 1]] -= 1
    return taken


def _plan(seed: int):
    """For one source's histogram: whole passes and the number of documents that are taken once more, by size."""

    def of_source(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", kind="stable").reset_index(drop=True)
        sizes, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        total, target = int((sizes * counts).sum()), float(rows["target"].iloc[0])
        passes = int(target // total) if total else 0
        extra = fit(sizes, counts, round(target - passes * total), seed)
        return pd.DataFrame({"source": rows["source"], "size": sizes, "passes": passes, "extra": extra})

    return of_source


def copies(docs: DataFrame, text: str, source: str, id_col: str, seed: int, weights: tuple[int, ...], share: float, most: float, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, of, size, copies) of every row, where ``of`` is its source, and (source, source_size, target).

    ``row`` is a column that tells rows without an id apart.
    """
    draw = F.when(F.col(id_col).isNotNull(), F.xxhash64(F.lit(seed), F.col(id_col), F.col(source).cast("string"))).otherwise(F.xxhash64(F.lit(seed), F.col(text), F.col(source).cast("string")))
    number = F.col(row) if row else F.lit(None)
    rows = docs.select(F.col(id_col).alias("doc_id"), number.cast("bigint").alias("row"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), F.shiftrightunsigned(draw, 1).alias("draw"))
    rows = written(rows)
    slices = max(1, rows.count() // SLICE_ROWS)
    rows = rows.withColumn("slice", F.col("draw") % slices)

    histogram = written(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(totals, weights, share, most)
    same = F.col("source").eqNullSafe(F.col("source_"))
    goals = written(targets)
    wanted = histogram.filter("size > 0").join(goals.select(F.col("source").alias("source_"), "target"), same).drop("source_")
    kinds = "source string, size bigint, passes int, extra bigint"
    plan = wanted.groupBy("source").applyInPandas(_plan(seed), kinds)

    # how many of each slice are taken once more: the slices before the cut whole, the slice of the cut in part
    sliced = rows.filter("size > 0").groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sliced = sliced.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    renamed = plan.select(F.col("source").alias("s"), F.col("size").alias("z"), "passes", "extra")
    quota = sliced.join(renamed, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("slice").alias("c"), "passes", F.least(F.greatest(F.col("extra") - F.col("before"), F.lit(0)), "n").alias("quota")
    )
    place = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("draw", "doc_id", "row"))
    ranked = rows.withColumn("place", place)
    joined = ranked.join(quota, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("slice") == F.col("c")), "left")
    times = F.coalesce(F.col("passes") + (F.col("place") <= F.col("quota")).cast("int"), F.lit(0))
    return joined.select("doc_id", "row", F.col("source").alias("of"), "size", times.cast("bigint").alias("copies")), goals


def mix(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", seed: int = 7, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """doc_id, size, source_size, target (of its source), taken (words that the mix takes, repeats counted)."""
    out, goals = copies(docs, text, source, id_col, seed, weights, share, most)
    sized = F.broadcast(goals) if goals.count() <= BROADCAST_SOURCES else goals
    return out.join(sized, F.col("of").eqNullSafe(F.col("source")), "left").select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def take(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", seed: int = 7, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The rows of the mix with all their columns, each as often as it is taken. Rows of one id are taken alike.

    Only ids and numbers of copies are joined to the texts: by a broadcast after a count, else by a shuffle.
    """
    key, times, nth, row = (max(docs.columns, key=len, default="") + end for end in ("_id", "_copies", "_nth", "_row"))  # clash with no column
    # rows without an id get a number once, which is written with them
    nameless = written(docs.filter(F.col(id_col).isNull()).withColumn(row, F.monotonically_increasing_id()))
    numbered = docs.filter(F.col(id_col).isNotNull()).withColumn(row, F.lit(None).cast("bigint")).unionByName(nameless)
    out = written(copies(numbered, text, source, id_col, seed, weights, share, most, row)[0].filter("copies > 0"))
    wanted = written(out.filter("doc_id is not null").groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(times)))
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    chosen = docs.join(wanted, F.col(id_col) == F.col(key)).select(*docs.columns, times)
    others = nameless.join(out.filter("row is not null").select(F.col("row").alias(row), F.col("copies").alias(times)), row).select(*docs.columns, times)
    return chosen.unionByName(others).withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
