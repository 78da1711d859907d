"""Sharding by minimax contiguous partition.

Groups of equal texts are atoms, ordered by their first document. The least capacity with which a greedy walk along the
running total of their sizes needs no more than the given number of shards is found by binary search; the walk's stops
are the cuts. The running totals stay in a table. The driver holds some of them, enough to bound where the walk stops:
the walk is tried with the least and the most favourable stops, and only where the two disagree are the totals in the
disputed intervals asked for, thousands at a time. The capacity is exact; the driver holds a bounded number of totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_count, constant_array, count_at_most, join_counted, order_key, range_cuts, range_number, with_running_total, written

FIRST_INTERVALS = 1 << 16
MORE_INTERVALS = 1 << 14


class Totals:
    """Running totals of group sizes (column `end`), known in part."""

    def __init__(self, groups: DataFrame):
        import numpy as np

        self.groups = groups
        self.total = groups.agg(F.max("end")).first()[0] or 0
        self.known = np.array([0, self.total], np.int64)
        self.open = np.array([self.total > 1])  # open[i]: there may be totals between known[i] and known[i + 1]
        self.ask([(0, self.total)], FIRST_INTERVALS)

    def ask(self, intervals: list[tuple[int, int]], buckets: int) -> None:
        """Gets more totals inside open intervals of neighbouring known totals."""
        import numpy as np

        highs = constant_array([b for _, b in intervals], "bigint")
        lows = constant_array([a for a, _ in intervals], "bigint")
        share = max(1, buckets // max(1, len(intervals)))
        at = count_at_most([a for a, _ in intervals], F.col("end") - 1) - 1
        rows = self.groups.select("end", at.alias("at")).where("at >= 0").where(F.col("end") < F.get(highs, F.col("at")))
        part = F.floor((F.col("end") - F.get(lows, F.col("at"))).cast("double") * share / (F.get(highs, F.col("at")) - F.get(lows, F.col("at"))))
        found = rows.groupBy("at", part.alias("part")).agg(F.min("end").alias("a"), F.max("end").alias("b"), F.count("*").alias("n")).collect()
        lowest = {int(a) for a, _ in intervals}
        was_open = dict(zip(self.known[:-1].tolist(), self.open.tolist(), strict=True))
        still = {r["a"] for r in found if r["n"] > 2}
        points = sorted({*self.known.tolist(), *(r["a"] for r in found), *(r["b"] for r in found)})
        self.known = np.array(points, np.int64)
        self.open = np.array([p in still or (was_open.get(p, False) and p not in lowest) for p in points[:-1]], bool)

    def walk(self, capacity: int, shards: int, hopeful: bool) -> tuple[list[int], set[int]]:
        """Stops of the greedy walk, and the open intervals in which it stopped; hopeful: as far in them as it could be."""
        at, stops, unsure = 0, [], set()
        for _ in range(shards):
            aim = at + capacity
            i = int(self.known.searchsorted(aim, side="right")) - 1
            if i >= len(self.known) - 1:
                at = self.total
            else:
                at = int(self.known[i])
                if self.open[i]:
                    unsure.add(i)
                    at = min(aim, int(self.known[i + 1]) - 1) if hopeful else at
            stops.append(at)
        return stops, unsure


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(capacity, the shards - 1 running totals at which to cut) for groups with the running total `end` of their sizes."""
    totals = Totals(groups)
    low, high = -(-totals.total // shards), totals.total
    best = [totals.total] * shards
    while low < high:
        capacity = (low + high) // 2
        safe, unsure = totals.walk(capacity, shards, False)
        if safe[-1] == totals.total:
            high, best = capacity, safe
            continue
        hoped, more = totals.walk(capacity, shards, True)
        if hoped[-1] < totals.total:
            low = capacity + 1
            continue
        # Also what lies between the two walks' stops: later tries stop there.
        for a, b in zip(safe, hoped, strict=True):
            i, j = (int(totals.known.searchsorted(x, side="right")) - 1 for x in (a, b))
            more |= {x for x in range(max(0, i), min(j + 1, len(totals.open))) if totals.open[x]}
        chosen = sorted(unsure | more)
        totals.ask([(int(totals.known[i]), int(totals.known[i + 1])) for i in chosen], max(MORE_INTERVALS, 4 * len(chosen)))
    if best[-1] != totals.total or high == totals.total:
        best = totals.walk(high, shards, False)[0]
    return high, best[:-1]


def shard_documents(documents: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot): groups of equal texts stay together, shard sizes are minimax.

    A document's size is its text's UTF-8 bytes plus 1. A null text counts as empty and is in the group of empty texts.
    Slots number a shard's rows from 0 in ascending key order, null keys last, rows of one key by a hash of their text.
    Fewer groups than shards leave the last shards empty; an empty table gives no rows. A text of very many rows is no
    hot key of the join, and rows of a hot key are spread by their texts.
    """
    spark = documents.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = written(documents.select(F.col(key).cast("long").alias("key"), (F.octet_length(body) + 1).cast("long").alias("size"),
                                    F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("text_id")), "shard-rows")
    place, tie = order_key(F.col("key")), F.shiftrightunsigned(F.xxhash64("text_id"), 2)
    cuts_of_keys = range_cuts(rows, F.col("key"), bucket_count(spark))
    groups = rows.groupBy("text_id").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min(place).alias("first"))
    groups = groups.withColumn("bucket", range_number(F.col("first"), tie, cuts_of_keys))
    groups = with_running_total(groups, [], "bucket", ["first", tie, "text_id"], "bytes", "start")
    groups = written(groups.select("text_id", "rows", "start", (F.col("start") + F.col("bytes")).alias("end")), "shard-groups")
    _, cuts = minimax_cuts(groups, shards)
    placed = join_counted(rows, groups.select("text_id", "rows", count_at_most(cuts, F.col("start")).alias("shard")), "text_id", "rows")
    placed = placed.withColumn("bucket", range_number(F.col("key"), tie, cuts_of_keys)).withColumn("one", F.lit(1))
    placed = with_running_total(placed, ["shard"], "bucket", [place, tie, "text_id"], "one", "slot")
    return placed.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot")
