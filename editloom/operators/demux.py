"""Demultiplexing read pairs by cell barcode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import first_token, reverse_complement, safe_pct
from ..params import DemuxParams
from .lookups import barcode_lookup_of


def locate(pairs: DataFrame, params: DemuxParams = DemuxParams()) -> DataFrame:
    """Adds c1 and c2, the 0-based first places of the constants in seq1 (-1: absent), and the barcode halves part1 and part2."""
    c1, c2 = F.instr("seq1", params.constant1) - 1, F.instr("seq1", params.constant2) - 1
    n = params.half_length
    return pairs.withColumn("c1", c1).withColumn("c2", c2).withColumn("part1", F.substring("seq1", 1, n)).withColumn(
        "part2", F.substring(F.col("seq1"), F.col("c1") + len(params.constant1) + 1, F.lit(n)))


def correct_barcodes(located: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds cell (null unless both halves are in the lookup) and corrected (the cell differs from what was read).

    The lookup is rebalanced, so that its rows are made once for both joins.
    """
    lookup = lookup.hint("rebalance")
    a = lookup.select(F.col("key").alias("part1"), F.col("value").alias("_v1"))
    b = lookup.select(F.col("key").alias("part2"), F.col("value").alias("_v2"))
    joined = located.join(a, "part1", "left").join(b, "part2", "left")
    cell = F.concat("_v1", "_v2")
    return joined.withColumn("cell", cell).withColumn("corrected", cell != F.concat("part1", "part2")).drop("_v1", "_v2")


def halves_seen(located: DataFrame) -> DataFrame:
    """(key): the different barcode halves of pairs."""
    return located.select(F.explode(F.array("part1", "part2")).alias("key")).where("key IS NOT NULL").distinct()


def lookup_of_pairs(pairs: DataFrame, barcodes: DataFrame, params: DemuxParams = DemuxParams()) -> DataFrame:
    """The rows of the whitelist's lookup for the barcode halves that pairs show, in order of keys."""
    return barcode_lookup_of(halves_seen(locate(pairs, params)), barcodes, params.barcode_mismatches).sortWithinPartitions("key")


def flag_pairs(pairs: DataFrame, barcodes: DataFrame, params: DemuxParams = DemuxParams(), lookup: DataFrame | None = None) -> DataFrame:
    """Adds the funnel's steps as cumulative booleans: has_c1, has_c2, valid, long_enough, clean; and rest1, seq1 after constant2, with rest_length.

    barcodes is the whitelist (ordinal, barcode). Its variants are looked up for the halves that the pairs show; pairs
    are read twice, so they should come from a table. lookup is what lookup_of_pairs gave for them, if it is at hand: of
    a table Spark knows the size before it shuffles whole pairs, and short barcodes make a small one of any number of pairs.
    """
    rest = F.col("c2") + len(params.constant2) + 1
    adapter = F.lit(False)
    for seq in ("seq1", "seq2"):
        adapter = adapter | F.col(seq).contains(params.adapter) | F.col(seq).contains(reverse_complement(F.lit(params.adapter)))
    # What follows from a pair alone is settled before its halves are joined, so counters do not take sequences through the joins.
    located = locate(pairs, params)
    df = located.withColumn("rest1", F.substring(F.col("seq1"), rest, F.length("seq1"))).withColumn("rest_qual1", F.substring(F.col("qual1"), rest, F.length("seq1")))
    df = df.withColumn("_length", F.length("rest1")).withColumn("_adapter", adapter).withColumn("has_c1", F.col("c1") >= 0).withColumn("has_c2", F.col("has_c1") & (F.col("c2") >= 0))
    df = correct_barcodes(df, lookup_of_pairs(pairs, barcodes, params) if lookup is None else lookup)
    df = df.withColumn("valid", F.col("has_c2") & F.col("cell").isNotNull())
    df = df.withColumn("long_enough", F.col("valid") & (F.col("_length") >= params.min_read_length) & (F.length("cell") >= 2 * params.half_length))
    return df.withColumn("clean", F.col("long_enough") & ~F.col("_adapter")).withColumn("rest_length", F.col("_length")).drop("_adapter", "_length")


def tag_reads(flagged: DataFrame) -> DataFrame:
    """(read_id, cell, seq1, qual1, seq2, qual2) of the pairs that passed: seq1 trimmed to what follows constant2."""
    return flagged.where("clean").select(first_token(F.col("name")).alias("read_id"), "cell", F.col("rest1").alias("seq1"), F.col("rest_qual1").alias("qual1"), "seq2", "qual2")


def funnel_counters() -> dict[str, Column]:
    """The nested counters of flagged pairs."""
    return {"total": F.count(F.lit(1)), "constant1": F.count_if("has_c1"), "constant2": F.count_if("has_c2"), "valid_barcode": F.count_if("valid"),
            "error_corrected": F.count_if(F.col("valid") & F.col("corrected")), "long_enough": F.count_if("long_enough"), "no_adapter": F.count_if("clean")}


def parse_funnel(flagged: DataFrame) -> DataFrame:
    """One row of nested counters."""
    return flagged.agg(*[c.alias(name) for name, c in funnel_counters().items()])


def lane_metrics(flagged: DataFrame, lane: str) -> DataFrame:
    """What each lane has counted: (lane, cell, counters), a row for each cell with tagged reads, of which no_adapter is the number, and one, cell null, for all other pairs."""
    return flagged.groupBy(lane, F.when(F.col("clean"), F.col("cell")).alias("cell")).agg(*[c.alias(name) for name, c in funnel_counters().items()])


def parse_funnel_pct(flagged: DataFrame) -> DataFrame:
    """The funnel's two percentages and the number of cells."""
    row = flagged.agg(F.count("*").alias("total"), F.count_if("long_enough").alias("long_enough"), F.count_if("clean").alias("no_adapter"), F.count_distinct(F.when(F.col("clean"), F.col("cell"))).alias("cells"))
    return row.select(safe_pct(F.col("long_enough"), F.col("total")).alias("long_pct"), safe_pct(F.col("no_adapter"), F.col("long_enough")).alias("no_adapter_pct"), "cells")


def merge_metrics(lanes: DataFrame) -> DataFrame:
    """(metric, cell, n): the counters of lanes (see lane_metrics) added up, cell null, and their reads_per_cell, added up by cell. Without lanes the counters are 0."""
    names = list(funnel_counters())
    none = lanes.sparkSession.range(1).select(F.lit(None).cast("string").alias("cell"), *[F.lit(0).cast("long").alias(c) for c in names])
    merged = lanes.select("cell", *names).unionByName(none).rollup("cell").agg(F.grouping("cell").alias("_all"), *[F.sum(c).alias(c) for c in names])
    metric = lambda name, cell, n: F.struct(F.lit(name).alias("metric"), cell.alias("cell"), F.col(n).alias("n"))
    counters, reads = F.array(*[metric(c, F.lit(None).cast("string"), c) for c in names]), F.array(metric("reads_per_cell", F.col("cell"), "no_adapter"))
    return merged.where("_all = 1 OR cell IS NOT NULL").select(F.explode(F.when(F.col("_all") == 1, counters).otherwise(reads)).alias("m")).select("m.*")


def reads_per_cell(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("cell").agg(F.count("*").alias("reads"))
