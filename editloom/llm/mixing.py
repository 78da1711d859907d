"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, shuffled by a hash, are a stream of words cut into blocks of equal word counts. Slot i of the
schedule belongs to the source in whose share of the cumulative weights the point frac(i * golden ratio) lies, so any
stretch of the schedule is near the target weights. The r-th slot of a source takes its block r modulo its number of
blocks; the slots are joined with the blocks' parts of documents. No text moves, only keys and sizes. The mix depends on the
documents' keys, sources and sizes alone, not on how the session splits or shuffles them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_count, free_names, count_at_most, with_running_total, written

GOLDEN = 0.6180339887498949
WORD = r"[^\x20\x09-\x0D]+"
SLOTS = 1 << 18
LEAST_BLOCKS = 64
REPEATS = 3
#: Sources are rows of a table on the driver; more than this are refused.
MOST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycling_weights(sources: list) -> dict:
    """1, 2, 3, repeating, by code point, null last."""
    return {s: 1.0 + i % 3 for i, s in enumerate(sorted(sources, key=lambda s: (s is None, s or "")))}


def targets(sizes: dict, weights: dict, repeats: int = REPEATS) -> dict:
    """Shares of all words by weight; none is above repeats times its source's size, the excess is shared again."""
    left, open_, found = float(sum(sizes.values())), set(sizes), {}
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * unit > repeats * sizes[s]}
        if not full:
            return found | {s: weights[s] * unit for s in open_}
        found |= {s: float(repeats * sizes[s]) for s in full}
        left -= sum(found[s] for s in full)
        open_ -= full
    return found


class Mixture:
    """The plan of a mix: `docs` (place, key, source, size, start, s), `sources` and the schedule's `slots` (i, s, epoch, block)."""

    def __init__(self, documents: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weigh=cycling_weights,
                 slots: int = SLOTS, repeats: int = REPEATS, seed: int = 42):
        spark = documents.sparkSession
        docs = written(documents.select(F.col(key).cast("long").alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size")), "mix-sizes")
        found = docs.groupBy("source").agg(F.sum("size").alias("n")).limit(MOST_SOURCES + 1).collect()
        if len(found) > MOST_SOURCES:
            raise ValueError(f"more than {MOST_SOURCES} sources")
        sizes = {r["source"]: r["n"] for r in found}
        goal = targets(sizes, weigh(list(sizes)), repeats) if sum(sizes.values()) else {s: 0.0 for s in sizes}
        per_block = max(1.0, sum(sizes.values()) / slots)
        rows, upto, bounds = [], 0.0, []
        for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or ""))):
            n = sizes[s]
            length = max(1, -(-n // max(1, min(n, max(LEAST_BLOCKS, round(n / per_block))))))
            blocks = max(1, -(-n // length))
            rows.append((i, s, n, goal[s], length, blocks))
            upto += goal[s] / (n / blocks) if n else 0.0
            bounds.append(upto)
        schema = "s int, source string, source_size long, target double, length long, blocks long"
        self.sources = spark.createDataFrame(rows, schema)
        buckets, total = bucket_count(spark), round(upto)
        hashed = F.xxhash64(F.lit(seed), "key", "size")
        docs = docs.withColumn("h", hashed).join(F.broadcast(self.sources), docs["source"].eqNullSafe(self.sources["source"])).drop(self.sources["source"])
        # A stretch of the hash's values: documents are in the order of h, however many buckets there are.
        docs = docs.withColumn("bucket", F.shiftright((F.shiftright("h", 33) + F.lit(1 << 30)) * F.lit(buckets), 31).cast("int"))
        order = ["h", "key", "size"]
        docs = docs.withColumn("n", F.row_number().over(Window.partitionBy("s", "bucket").orderBy(*order)))
        docs = with_running_total(docs, ["s"], "bucket", order, "size", "start")
        self.docs = docs.withColumn("place", F.struct("s", "bucket", "n")).drop("h", "bucket", "n")

        i = F.col("i")
        point = (i + F.lit(0.5)) * F.lit(GOLDEN)
        at = (point - F.floor(point)) * F.lit(upto)
        plan = spark.range(total).withColumnRenamed("id", "i").withColumn(
            "s", F.least(count_at_most(bounds, at, "double"), F.lit(max(0, len(bounds) - 1))))
        plan = plan.withColumn("one", F.lit(1)).withColumn("bucket", F.floor(i * buckets / max(1, total)).cast("int"))
        plan = with_running_total(plan, ["s"], "bucket", ["i"], "one", "rank").join(F.broadcast(self.sources.select("s", "blocks")), "s")
        plan = plan.withColumn("epoch", F.floor(F.col("rank") / F.col("blocks"))).withColumn("block", F.col("rank") % F.col("blocks"))
        # The schedule may be a slot or two above a source's limit of repeats.
        self.slots = plan.where(F.col("epoch") < repeats).select("i", "s", "epoch", "block")

    def parts(self) -> DataFrame:
        """Documents by block: words first_word to end_word (exclusive) of a document lie in the block; no part for none."""
        a, n, length = F.col("start"), F.col("size"), F.col("length")
        blocks = F.when(n > 0, F.sequence(F.floor(a / length), F.floor((a + n - 1) / length)))
        parts = self.docs.withColumn("block", F.explode_outer(blocks))
        return parts.withColumn("first_word", F.greatest(a, F.col("block") * length) - a).withColumn(
            "end_word", F.least(a + n, (F.col("block") + 1) * length) - a)

    def rows(self) -> DataFrame:
        """The mix itself: (i, epoch, key, source, first_word, end_word) in the order of i."""
        return self.parts().join(self.slots, ["s", "block"]).select("i", "epoch", "key", "source", "first_word", "end_word")

    def taken(self, key: str = "doc_id") -> DataFrame:
        """Words that the mix takes of each document, repeats counted; 0 for documents without words."""
        times = self.slots.groupBy("s", "block").agg(F.count("*").alias("times"))
        parts = self.parts().join(times, ["s", "block"], "left")
        words = (F.col("end_word") - F.col("first_word")) * F.col("times")
        out = parts.groupBy("place", "key", "size", "source_size", "target").agg(F.coalesce(F.sum(words), F.lit(0)).cast("long").alias("taken"))
        return out.select(F.col("key").alias(key), "size", "source_size", "target", "taken")


def mixed_documents(documents: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **parameters) -> DataFrame:
    """Whole documents of the mix: each as many times (0 to `repeats`) as slots take the block with its first word.

    Documents without words are not taken. Documents with the same key count as one and come as often as the most taken
    of them. Columns are those of documents.
    """
    mix = Mixture(documents, key, source, text, **parameters)
    times = mix.slots.groupBy("s", "block").agg(F.count("*").alias("times"))
    first = mix.parts().where("first_word = 0 and size > 0")
    place, copies, copy = free_names(documents, "_key", "_copies", "_copy")
    counts = first.join(times, ["s", "block"]).groupBy(F.col("key").alias(place)).agg(F.max("times").cast("int").alias(copies))
    out = documents.join(counts, F.col(f"`{key}`").eqNullSafe(F.col(place))).where(word_count(F.col(f"`{text}`")) > 0)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).select(*[F.col(f"`{c}`") for c in documents.columns])
