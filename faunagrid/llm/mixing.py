"""Mixing sources to target sizes by subset-sum budget fitting.

Documents are counted by source and exact length. A source's target takes whole passes over
the source first; the rest of the budget is fitted on the counts alone: a share of every
length, then bounded-knapsack dynamic programming for what is left, over counts of lengths
not yet taken, whatever is left. At last, of each source and length the wanted number of documents is selected
in a seeded order. The counts are bounded: different lengths of a source sum to its size at
most, so there are fewer than sqrt(2 * size) of them.

Defined cases: a null text has size 0; a null source is a source and comes last; documents of
size 0 are never taken; a source of size 0 has target 0; repeated rows are separate documents
(of equal ids and sizes, any may be chosen: they are alike in the result); an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faunagrid.llm.storage import stored, table

SEED = 20240229
WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
#: Words that the shares leave to the dynamic program at least, and lengths of the longest document.
#: Besides, carrying on leaves less than one such length, which bounds the program's state.
BUDGET, LONGEST = 1 << 15, 8
#: Buckets of the seeded order; only one of each source and length is sorted.
BUCKETS = 1 << 12
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``_at``: places from 0 in the order of ``source``, null last. Sorted in ranges; the driver sees a number for each range."""
    order = F.col("source").asc_nulls_last()
    rows = stored(sizes.repartitionByRange(order).sortWithinPartitions(order).withColumn("_id", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("_id", 33)
    counts = sorted(rows.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for r in counts:
        starts.append((r["_part"], before))
        before += r["n"]
    offsets = sizes.sparkSession.createDataFrame(starts, "_part long, _before long")
    return rows.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("_at", F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_before", "_id")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """``sizes`` (source, source_size; a row for each source) with ``target``.

    Weights repeat over the sources by code point. Targets are min(cap, level * weight) for the
    level at which they sum to the budget. The level is raised from where no source were at its cap, each time
    to what the sources below their caps have left, until no further source comes to its cap; every
    step is one sum over the sources.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_at") % len(weights) + 1).cast("int")).cast("double")
    w = numbered(sizes).withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(passes)))
    total, every = w.agg(F.sum(F.col("source_size").cast("double")), F.sum("_w")).first()
    budget, level, before = share * (total or 0.0), 0.0, None
    level = budget / every if every else 0.0
    while True:
        full = F.col("_cap") <= F.lit(level) * F.col("_w")
        capped, n, rest = w.agg(F.sum(F.when(full, F.col("_cap")).otherwise(0.0)), F.count_if(full), F.sum(F.when(full, 0.0).otherwise(F.col("_w")))).first()
        if n == before or not rest:
            break
        level, before = (budget - capped) / rest, n
    return w.withColumn("target", F.least("_cap", F.lit(level) * F.col("_w"))).drop("_w", "_cap", "_at")


def fill(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each size, at most ``counts``, sum to ``budget`` or as near below it as can be.

    Bounded knapsack over the bits of one whole number, in units of the greatest divisor common to
    all sizes: ``first[s]`` is the item by which the sum s was reached first, so that walking back
    by that item until an earlier one's sum gives the fewest copies of it.
    """
    taken = np.zeros(len(sizes), np.int64)
    usable = (sizes > 0) & (sizes <= budget) & (counts > 0)
    if not usable.any():
        return taken
    unit = int(np.gcd.reduce(sizes[usable]))
    budget = min(budget, int((sizes * counts)[usable].sum())) // unit
    first = np.full(budget + 1, -1, np.int32)
    reached, below = 1, (1 << (budget + 1)) - 1
    for i in np.flatnonzero(usable).tolist():
        size = int(sizes[i]) // unit
        left = min(int(counts[i]), budget // size)
        step = 1
        while left:  # copies in powers of two reach every number up to the count
            n = min(step, left)
            new = (reached << (n * size)) & below
            new ^= new & reached
            note(first, new, i)
            reached |= new
            left -= n
            step *= 2
        if reached >> budget:
            break
    s = reached.bit_length() - 1
    while s:
        i = int(first[s])
        taken[i] += 1
        s -= int(sizes[i]) // unit
    return taken


def note(first: np.ndarray, bits: int, item: int) -> None:
    """Sets ``first`` to ``item`` at the places of ``bits``."""
    held = np.frombuffer(bits.to_bytes((len(first) + 7) // 8, "little"), np.uint8)
    at = np.flatnonzero(held)
    for k in range(0, len(at), 1 << 16):
        part = at[k : k + (1 << 16)]
        row, bit = np.nonzero(np.unpackbits(held[part, None], axis=1, bitorder="little"))
        first[part[row] * 8 + bit] = item


def fit(sizes: np.ndarray, counts: np.ndarray, target: float) -> np.ndarray:
    """How many documents of each size to take in all, passes included, to come to ``target`` words."""
    total = int((sizes * counts).sum())
    whole = min(PASSES, int(target // total)) if total else 0
    goal = round(target) - whole * total
    rest = min(max(BUDGET, LONGEST * int(sizes.max(initial=0))), goal)  # kept for the dynamic program
    order = np.argsort(-sizes, kind="stable")
    s, c = sizes[order], counts[order]
    # the same share of every length, from the largest on; what one leaves below its size is carried on
    wanted = np.cumsum(s * c) * ((goal - rest) / total if total else 0.0)
    extra, got = np.zeros(len(s), np.int64), 0
    for k, (size, count) in enumerate(zip(s.tolist(), c.tolist(), strict=True)):
        if size:
            extra[k] = max(0, min(count, int((wanted[k] - got) // size)))
            got += int(extra[k]) * size
    extra += fill(s, c - extra, goal - got)
    out = np.zeros(len(sizes), np.int64)
    out[order] = extra
    return whole * counts + out


def quotas(lengths: DataFrame) -> DataFrame:
    """For (source, size, n, target): ``passes``, and ``extra`` documents that are taken once more."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        n, sizes = group["n"].to_numpy(np.int64), group["size"].to_numpy(np.int64)
        taken = fit(sizes, n, float(group["target"].iloc[0]))
        return group[["source", "size"]].assign(passes=taken // n, extra=taken % n)

    return lengths.groupBy("source").applyInPandas(one, "source string, size long, passes long, extra long")


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, row: str | None = None) -> DataFrame:
    """For each row of ``df``: key, size, source_size, target, and ``taken``, a whole number of times its size.

    ``row`` names a column that tells rows of equal keys apart; it is kept beside the others.
    """
    marks = [F.col(row).alias("_mark")] if row else []
    docs = stored(df.select(F.col(key).alias("id"), F.col(source).cast("string").alias("source"), words(text).alias("size"), *marks), "sizes")
    docs = docs.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(BUCKETS)))
    lengths = docs.groupBy("source", "size").agg(F.count("*").alias("n"))
    sizes = targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    wide = lengths.alias("a").join(sizes.alias("b"), same).select("a.*", "b.source_size", "b.target")
    wanted = stored(quotas(wide.select("source", "size", "n", "target")).alias("a").join(sizes.alias("b"), same).select("a.*", "b.source_size", "b.target"), "quotas")
    # of each source and length: the buckets below ``whole`` are taken, the next one in part
    in_bucket = docs.groupBy("source", "size", "bucket").agg(F.count("*").alias("n"))
    counted = in_bucket.alias("a").join(wanted.alias("b"), same & (F.col("a.size") == F.col("b.size"))).select("a.*", "b.passes", "b.extra", "b.source_size", "b.target")
    order = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("room", F.col("extra") - F.coalesce(F.sum("n").over(order), F.lit(0)))
    # a row of ``counted`` for nearly every document, so never to be broadcast
    here = docs.alias("a").join(counted.alias("b").hint("merge"), same & (F.col("a.size") == F.col("b.size")) & (F.col("a.bucket") == F.col("b.bucket"))).select("a.*", "b.n", "b.passes", "b.room", "b.source_size", "b.target")
    within = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy(F.xxhash64(F.lit(seed + 1), "id"), "id", *(["_mark"] if row else [])))
    more = F.when(F.col("room") <= 0, 0).when(F.col("room") >= F.col("n"), 1).otherwise((within <= F.col("room")).cast("int"))
    return here.withColumn("taken", F.col("size") * (F.col("passes") + more)).select(F.col("id").alias(key), "size", "source_size", "target", "taken", *([F.col("_mark").alias(row)] if row else []))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
