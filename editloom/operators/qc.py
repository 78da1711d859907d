"""Quality-control data sets. `dense` is the long cell by amplicon table; which counts a set uses is part of its definition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import QUALITY_CLASSES, QualityParams
from .quantiles import quantiles
from .summary import attach_quality, panel_array, quality_group, select_cells

THRESHOLDS = (1, 5, 10, 25, 50, 100)
SHARES = (1.0, 0.9, 0.8, 0.5)


def hundredths(pct: Column) -> Column:
    """A share with two decimals as an integer, so that sums are exact."""
    return F.round(pct * 100).cast("long")


def exact_mean(pct: Column) -> Column:
    """Mean of shares with two decimals; nulls don't count."""
    return F.sum(hundredths(pct)) / F.count(pct) / 100


def amplicon_mean_coverage(dense: DataFrame, quality: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Final reads per selected cell of each amplicon; cells without count stay in the denominator."""
    return select_cells(dense, quality, params).groupBy("amplicon").agg((F.coalesce(F.sum("tot"), F.lit(0)) / F.count("*")).alias("mean_coverage"))


def extreme_amplicons(coverage: DataFrame, n: int = 3) -> DataFrame:
    """The n amplicons of highest and of lowest mean coverage."""
    top = coverage.orderBy(F.desc("mean_coverage"), "amplicon").limit(n).withColumn("end", F.lit("highest"))
    low = coverage.orderBy("mean_coverage", "amplicon").limit(n).withColumn("end", F.lit("lowest"))
    return top.unionByName(low)


def cell_depths(dense: DataFrame, quality: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """(cell, quality_group, reads): final reads of each classified cell."""
    grouped = attach_quality(dense, quality).withColumn("quality_group", quality_group(params)).where("quality_group IS NOT NULL")
    return grouped.groupBy("cell", "quality_group").agg(F.coalesce(F.sum("tot"), F.lit(0)).cast("long").alias("reads"))


def depth_by_group(dense: DataFrame, quality: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Five-number summary of cell depths by quality group."""
    found = quantiles(cell_depths(dense, quality, params), ["quality_group"], "reads", [0.0, 0.25, 0.5, 0.75, 1.0])
    return found.select("quality_group", F.col("n").alias("cells"), *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(("least", "lower", "median", "upper", "most"))])


def mean_depth_by_group(dense: DataFrame, quality: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    return cell_depths(dense, quality, params).groupBy("quality_group").agg((F.sum("reads") / F.count("*")).alias("mean_reads"))


def edited_sites_histogram(dense: DataFrame, quality: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Selected cells by their number of amplicons with an edited share above 0."""
    per_cell = select_cells(dense, quality, params).groupBy("cell").agg(F.count_if(F.col("mod") > 0).alias("edited_sites"))
    return per_cell.groupBy("edited_sites").agg(F.count("*").alias("cells"))


def sorted_panel(dense: DataFrame) -> DataFrame:
    """(panel): the names of all amplicons, sorted, in one row."""
    return panel_array(dense.where("amplicon IS NOT NULL"), F.col("amplicon"))


def cell_bitmaps(dense: DataFrame, quality: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """(cell, bitmap, sites): the edited amplicons of each selected cell as bits, and their number.

    Bit p % 64 of word p / 64 stands for the amplicon in place p of the sorted panel. Words end with the last that has a
    bit, so equal sets have equal bitmaps; a cell without edits has none. 20,000 amplicons take 2.5 KB at most.
    """
    places = sorted_panel(dense).select(F.posexplode("panel").alias("place", "amplicon"))
    edited = F.coalesce(F.when(F.col("mod") != 0, F.expr("shiftleft(1L, place % 64)")), F.lit(0).cast("long"))
    words = select_cells(dense, quality, params).join(places, "amplicon", "left").groupBy("cell", F.shiftright("place", 6).alias("word")).agg(F.bit_or(edited).alias("bits"))
    some = F.col("bits") != 0
    cells = words.groupBy("cell").agg(F.map_from_entries(F.collect_list(F.when(some, F.struct("word", "bits")))).alias("at"), F.max(F.when(some, F.col("word"))).alias("last"), F.sum(F.bit_count("bits")).alias("sites"))
    filled = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.coalesce(F.try_element_at("at", i), F.lit(0).cast("long")))
    return cells.select("cell", F.when(F.col("last").isNull(), F.array().cast("array<bigint>")).otherwise(filled).alias("bitmap"), "sites")


def with_names(bitmaps: DataFrame, dense: DataFrame) -> DataFrame:
    """Adds pattern: the names of a bitmap's amplicons, sorted, commas between. The panel is one row of bounded size."""
    bit = lambda i: F.getbit(F.coalesce(F.get("bitmap", F.shiftright(i, 6)), F.lit(0).cast("long")), i.bitwiseAND(F.lit(63)))
    return bitmaps.join(F.broadcast(sorted_panel(dense))).withColumn("pattern", F.array_join(F.filter("panel", lambda name, i: bit(i) == 1), ",")).drop("panel")


def edit_combinations(dense: DataFrame, quality: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """(pattern, cells): grouped by bitmaps; only different ones get names."""
    counts = cell_bitmaps(dense, quality, params).groupBy("bitmap").agg(F.count("*").alias("cells"))
    return with_names(counts, dense).select("pattern", "cells")


def top_edit_combinations(dense: DataFrame, quality: DataFrame, n: int = 5, params: QualityParams = QualityParams()) -> DataFrame:
    """(cell, pattern) of the cells with one of the n most frequent patterns; amplicons that none of them edits appear in no pattern.

    Only patterns as frequent as the n-th get names, which settle ties.
    """
    bitmaps = cell_bitmaps(dense, quality, params)
    counts = bitmaps.groupBy("bitmap").agg(F.count("*").alias("cells"))
    least = counts.orderBy(F.desc("cells")).limit(n).agg(F.min("cells").alias("least"))  # one row
    best = with_names(counts.join(F.broadcast(least)).where("cells >= least"), dense).orderBy(F.desc("cells"), "pattern").limit(n)
    return bitmaps.join(best.select("bitmap", "pattern"), "bitmap").select("cell", "pattern")


def cells_per_amplicon_at_depth(scored: DataFrame) -> DataFrame:
    """Cells with at least so many raw reads, by amplicon and threshold: one pass over the rows."""
    counts = scored.groupBy("amplicon").agg(*[F.count_if(F.col("raw_tot") >= t).alias(f"t{t}") for t in THRESHOLDS])
    return counts.select("amplicon", F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{t}").alias("cells")) for t in THRESHOLDS])).alias("x")).select("amplicon", "x.*")


def amplicons_per_cell_at_depth(scored: DataFrame, inclusive: bool = False) -> DataFrame:
    """Cells whose number of amplicons at a threshold is above (or at) a rounded share of all amplicons, half to even."""
    per_cell = scored.groupBy("cell").agg(F.count("*").alias("n"), *[F.count_if(F.col("raw_tot") >= t).alias(f"t{t}") for t in THRESHOLDS])
    need = lambda s: F.bround(F.lit(s) * F.col("n"), 0)
    over = lambda t, s: F.col(f"t{t}") >= need(s) if inclusive else F.col(f"t{t}") > need(s)
    counted = per_cell.agg(*[F.count_if(over(t, s)).alias(f"c{t}_{i}") for t in THRESHOLDS for i, s in enumerate(SHARES)])
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(int(s * 100)).alias("share_pct"), F.col(f"c{t}_{i}").alias("cells")) for t in THRESHOLDS for i, s in enumerate(SHARES)])
    return counted.select(F.explode(rows).alias("x")).select("x.*")


def mean_mod_by_depth(scored: DataFrame, quality: DataFrame) -> DataFrame:
    """Mean raw edited share of the cells at each threshold, by class and amplicon; null where there is none."""
    at = lambda t: F.when(F.col("raw_tot") >= t, F.col("raw_mod"))
    means = attach_quality(scored, quality).groupBy("color", "amplicon").agg(*[F.when(F.count(at(t)) > 0, exact_mean(at(t))).alias(f"t{t}") for t in THRESHOLDS])
    return means.select("color", "amplicon", F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{t}").alias("mean_mod")) for t in THRESHOLDS])).alias("x")).select("color", "amplicon", "x.*")


def amplicon_order(scored: DataFrame) -> DataFrame:
    """(amplicon, place): amplicons by mean raw reads descending, then name."""
    means = scored.groupBy("amplicon").agg((F.sum("raw_tot") / F.count("*")).alias("mean_reads"))
    return means.withColumn("place", F.row_number().over(Window.orderBy(F.desc("mean_reads"), "amplicon")))  # one row for each amplicon of the panel


def group_complement(params: QualityParams = QualityParams()) -> list[str]:
    return [c for c in QUALITY_CLASSES if c not in params.selected]
