"""The cell by amplicon table: dense long form, wide form and cell quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import QUALITY_CLASSES, QualityParams
from .quantiles import quantiles

#: A panel of more amplicons is refused, as each executor holds its names.
PANEL_LIMIT = 1_000_000


def panel_array(entries: DataFrame, entry: Column) -> DataFrame:
    """(panel): one row with the sorted distinct entries of the panel of amplicons; more than PANEL_LIMIT are an error."""
    size = F.raise_error(F.format_string("The panel has %d amplicons, more than %d", F.size("a"), F.lit(PANEL_LIMIT)))
    found = entries.select(entry.alias("e")).distinct().agg(F.array_sort(F.collect_list("e")).alias("a"))
    return found.select(F.when(F.size("a") <= PANEL_LIMIT, F.col("a")).otherwise(size).alias("panel"))


def usable_amplicons(status: DataFrame, summarized: DataFrame | None = None) -> DataFrame:
    """Amplicons that are Completed and have a summary, be it an empty one.

    summarized: (amplicon) of those with a summary; without it every Completed amplicon has one.
    """
    done = status.where("status = 'Completed'").select("amplicon")
    return done if summarized is None else done.join(summarized.select("amplicon"), "amplicon", "left_semi")


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count("*").alias("amplicons"))


def filter_failures(status: DataFrame) -> DataFrame:
    return status.where("status <> 'Completed'")


def densify(summary: DataFrame, status: DataFrame, summarized: DataFrame | None = None) -> DataFrame:
    """(cell, amplicon, raw_tot, raw_mod, tot, mod) of every cell at every amplicon.

    Null counts: the amplicon is not usable. Count 0 and null share: the cell has no reads there, as all cells have at a
    usable amplicon with an empty summary. summary has (amplicon, cell, raw_reads, raw_mod_pct, final_reads, final_mut_pct). The frame of all cells by all amplicons is the
    result itself, one row for each entry of the matrix.
    """
    usable = usable_amplicons(status, summarized).withColumn("usable", F.lit(True))
    names = status.select("amplicon").join(usable, "amplicon", "left")
    listed = panel_array(names, F.struct("amplicon", F.coalesce("usable", F.lit(False)).alias("usable")))
    cells = summary.join(usable, "amplicon", "left_semi").select("cell").distinct()
    frame = cells.join(F.broadcast(listed)).select("cell", F.explode("panel").alias("a")).select("cell", "a.*")
    full = frame.join(summary, ["cell", "amplicon"], "left")
    count = lambda c: F.when(F.col("usable"), F.coalesce(F.col(c), F.lit(0))).cast("long")
    share = lambda c: F.when(F.col("usable"), F.col(c))
    return full.select("cell", "amplicon", count("raw_reads").alias("raw_tot"), share("raw_mod_pct").alias("raw_mod"), count("final_reads").alias("tot"), share("final_mut_pct").alias("mod"))


def wide(dense: DataFrame, amplicons: list[str], tot: str = "tot", mod: str = "mod") -> DataFrame:
    """One row per cell with totCount.X and modPct.X of the given amplicons, in their order."""
    pivoted = dense.groupBy("cell").pivot("amplicon", amplicons).agg(F.first(tot).alias("totCount"), F.first(mod).alias("modPct"))
    names = [F.col(f"`{a}_{k}`").alias(f"{k}.{a}") for a in amplicons for k in ("totCount", "modPct")]
    return pivoted.select("cell", *names)


def wide_header(amplicons: list[str]) -> str:
    return "\t".join(["cell", *(f"{k}.{a}" for a in amplicons for k in ("totCount", "modPct"))])


def wide_lines(dense: DataFrame, amplicons: list[str], tot: str = "tot", mod: str = "mod") -> DataFrame:
    """(value): the rows of `wide` as text, tabs between, NA for null, without a column for each amplicon.

    A cell's entries are gathered, sorted by the amplicon's place and joined; of several for one amplicon the least place
    in sorted order is taken, entries of other amplicons are left out, missing ones are NA. The header is not among them.
    """
    spark = dense.sparkSession
    places = spark.createDataFrame(list(enumerate(amplicons)), "place int, amplicon string")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NA"))
    entries = dense.join(places, "amplicon").groupBy("cell", "place").agg(F.min(F.concat(text(tot), F.lit("\t"), text(mod))).alias("entry"))
    cells = entries.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("place", "entry"))).alias("e"))
    n = len(amplicons)
    at = F.map_from_entries("e")
    filled = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.try_element_at(at, i), F.lit("NA\tNA")))
    values = F.when(F.size("e") == n, F.transform("e", lambda x: x["entry"])).otherwise(filled)  # dense tables have an entry for each amplicon
    return cells.select(F.concat_ws("\t", "cell", values).alias("value"))


def unpivot_wide(table: DataFrame) -> DataFrame:
    """Wide totCount.X, modPct.X columns back to (cell, amplicon, tot, mod)."""
    names = amplicon_names(table.columns)
    each = F.array(*[F.struct(F.lit(a).alias("amplicon"), F.col(f"`totCount.{a}`").cast("long").alias("tot"), F.col(f"`modPct.{a}`").cast("double").alias("mod")) for a in names])
    return table.select("cell", F.explode(each).alias("x")).select("cell", "x.*")


def unpivot_lines(lines: DataFrame, header: str) -> DataFrame:
    """(cell, amplicon, tot, mod) of the wide table's lines (value) under its header; NA, and what is no number, is null."""
    columns = header.split("\t")
    at = {c: i for i, c in enumerate(columns)}
    names = amplicon_names(columns)
    triples = "\t".join(f"{a}\n{at.get(f'totCount.{a}', -1)}\n{at.get(f'modPct.{a}', -1)}" for a in names)
    panel = F.transform(F.split(F.lit(triples), "\t"), lambda x: F.split(x, "\n"))  # one literal, however many amplicons
    rows = lines.where(F.col("value") != header).select(F.split("value", "\t").alias("f"))
    each = rows.select(F.get("f", F.lit(at["cell"])).alias("cell"), "f", F.explode(panel).alias("p"))
    field = lambda i: F.get("f", F.get("p", F.lit(i)).cast("int"))
    return each.select("cell", F.get("p", F.lit(0)).alias("amplicon"), field(1).try_cast("long").alias("tot"), field(2).try_cast("double").alias("mod"))


def amplicon_names(columns: list[str]) -> list[str]:
    return sorted({c.split(".", 1)[1] for c in columns if c.startswith(("totCount.", "modPct."))})


def metric_columns(columns: list[str], metric: str) -> list[str]:
    return [c for c in columns if metric in c]


def depth_mask(dense: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """(cell, keep): keep if every usable amplicon has enough raw reads."""
    return dense.where("raw_tot IS NOT NULL").groupBy("cell").agg((F.min("raw_tot") >= params.min_reads_per_amplicon).alias("keep"))


def depth_gate_count(dense: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    return depth_mask(dense, params).agg(F.count_if(~F.col("keep")).alias("failing_cells"))


def scored_rows(dense: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Entries of usable amplicons of the cells that pass the depth mask: one pass, by a minimum over each cell's entries."""
    least = F.min("raw_tot").over(Window.partitionBy("cell"))
    return dense.where("raw_tot IS NOT NULL").withColumn("_least", least).where(F.col("_least") >= params.min_reads_per_amplicon).drop("_least")


def amplicon_percentiles(dense: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """(amplicon, quantiles): exact interpolated quantiles of the raw counts, zeros included."""
    return quantiles(scored_rows(dense, params), ["amplicon"], "raw_tot", params.tiers).drop("n")


def amplicon_score(dense: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """(cell, amplicon_score, read_count): sum over tiers of weight times the share of amplicons at or above the tier's quantile."""
    rows = scored_rows(dense, params).join(amplicon_percentiles(dense, params), "amplicon")
    points = sum((F.when(F.col("raw_tot") >= F.get("quantiles", F.lit(i)), w).otherwise(0) for i, w in enumerate(params.weights)), F.lit(0))
    return rows.groupBy("cell").agg((F.sum(points) / F.count("*")).alias("amplicon_score"), F.sum("raw_tot").cast("long").alias("read_count"))


def cell_total_reads(dense: DataFrame) -> DataFrame:
    return dense.groupBy("cell").agg(F.coalesce(F.sum("raw_tot"), F.lit(0)).cast("long").alias("read_count"))


def barcode_rank(scores: DataFrame) -> DataFrame:
    """Adds barcode_rank: 1 to n by read count descending, then cell.

    Ranks within each read count are added to the number of cells with more reads, so that no task orders all cells.
    """
    sizes = scores.groupBy("read_count").agg(F.count("*").alias("_cells"))
    before = Window.orderBy(F.desc("read_count")).rowsBetween(Window.unboundedPreceding, -1)  # one row for each read count
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_cells").over(before), F.lit(0))).drop("_cells")
    inside = F.row_number().over(Window.partitionBy("read_count").orderBy("cell"))
    return scores.withColumn("_inside", inside).join(sizes, "read_count").withColumn("barcode_rank", (F.col("_before") + F.col("_inside")).cast("long")).drop("_before", "_inside")


def quality_class(ranked: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Adds color: the score against the median of cells within the depth cutoff, and the rank against the cutoff."""
    near = F.col("barcode_rank") <= params.depth_cutoff
    median = ranked.where(near).agg(F.percentile("amplicon_score", F.lit(0.5)).alias("_cutoff"))  # of depth_cutoff cells at most
    high = F.when(F.col("amplicon_score") >= F.col("_cutoff"), "HQ").otherwise("LQ")
    return ranked.crossJoin(F.broadcast(median)).withColumn("color", F.concat(high, F.lit("_"), F.when(near, "HI").otherwise("LO"))).drop("_cutoff")  # one row


def cell_quality(dense: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """(cell, amplicon_score, read_count, barcode_rank, color): mask, score, rank, class, and only then the total filter."""
    found = quality_class(barcode_rank(amplicon_score(dense, params)), params)
    return found.where(F.col("read_count") >= params.min_total_reads).select("cell", "amplicon_score", "read_count", "barcode_rank", "color")


def attach_quality(dense: DataFrame, quality: DataFrame) -> DataFrame:
    return dense.join(quality.select("cell", "color"), "cell")


def scored_only(dense: DataFrame, quality: DataFrame) -> DataFrame:
    return dense.join(quality, "cell", "left_semi")


def in_classes(selected: tuple[str, ...]) -> Column:
    return F.col("color").isin(list(selected)) if selected else F.lit(False)


def select_cells(rows: DataFrame, quality: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Rows of cells of the selected classes."""
    return rows.join(quality.where(in_classes(params.selected)), "cell", "left_semi")


def quality_class_counts(quality: DataFrame) -> DataFrame:
    return quality.groupBy("color").agg(F.count("*").alias("cells"))


def quality_group(params: QualityParams = QualityParams()) -> Column:
    """High for selected classes, Low for the other known ones, null for cells never classified."""
    others = [c for c in QUALITY_CLASSES if c not in params.selected]
    return F.when(in_classes(params.selected), "High").when(F.col("color").isin(others), "Low")
