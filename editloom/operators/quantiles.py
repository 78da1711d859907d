"""Exact quantiles of groups of any size, by selection of ranks from counts."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins for each factor of e between values: at most some thousand bins a group for counts of any size.
BINS = 64


def value_bin(value: Column) -> Column:
    """A whole number that never falls as the value rises."""
    size = F.floor(F.log1p(F.abs(value)) * BINS)
    return F.when(value < 0, -size).otherwise(size)


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: list[float] | tuple[float, ...]) -> DataFrame:
    """(keys, quantiles, n): linearly interpolated quantiles of the finite values of each group, and their number.

    Rows become counts of distinct values first, and those a histogram of bins. Only bins that hold a wanted rank, two for
    each share at most, are looked into: their values are numbered in order, each bin in a task of its own, by a running
    sum that spills. So no task holds the values of a group. Nulls don't count; a group without values is left out, but
    without keys there is always one row, with n null if there is no value. Null keys are a group.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    picked = rows.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], F.col(f"`{value}`").cast("double").alias("_v")).where("_v IS NOT NULL")
    counts = picked.groupBy(*names, "_v").agg(F.count("*").alias("_n")).withColumn("_bin", value_bin(F.col("_v")))

    upto = Window.partitionBy(*names).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # rows are bins
    bins = counts.groupBy(*names, "_bin").agg(F.sum("_n").alias("_m"))
    bins = bins.withColumn("_before", F.coalesce(F.sum("_m").over(upto), F.lit(0))).withColumn("_total", F.sum("_m").over(Window.partitionBy(*names)))
    place = [(F.col("_total") - 1) * F.lit(float(s)) for s in shares]  # from 0
    ranks = [(F.floor(p), F.ceil(p)) for p in place]
    within = lambda r, size: (r >= F.col("_before")) & (r < F.col("_before") + F.col(size))
    wanted = bins.where(reduce(or_, [within(r, "_m") for pair in ranks for r in pair], F.lit(False)))
    wanted = wanted.select(*[F.col(n).alias(f"_w{n}") for n in names], F.col("_bin").alias("_wbin"), F.col("_before").alias("_start"), "_total")

    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"_w{n}")) for n in names], F.col("_bin").eqNullSafe(F.col("_wbin")))  # null-safe, so that no filter makes the two uses of counts differ
    inside = Window.partitionBy(*names, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    found = counts.join(wanted, same).withColumn("_before", F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    at = [F.max(F.when(within(r, "_n"), F.col("_v"))).alias(f"_{end}{i}") for i, pair in enumerate(ranks) for end, r in zip(("low", "high"), pair)]
    ends = found.groupBy(*names).agg(F.max("_total").alias("_total"), *at)
    between = []
    for i, (p, (low, high)) in enumerate(zip(place, ranks)):
        a, b = F.col(f"_low{i}"), F.col(f"_high{i}")
        between.append(F.when(a == b, a).otherwise((high - p) * a + (p - low) * b))
    return ends.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], F.array(*between).alias("quantiles"), F.col("_total").alias("n"))
