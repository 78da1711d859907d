"""The annotated matrix as tables: obs (cells), var (amplicons), layers (one row per entry) and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import ZygosityParams
from .qc import exact_mean

#: Labels of the zygosity codes.
ZYGOSITY_LABELS = {0: "WT/WT", 1: "WT/Mut", 2: "Mut/Mut (Homozygous)", 3: "Mut/Mut2 (Compound Het)", -1: "NoData"}


def filtered_allele_counts(reads: DataFrame) -> DataFrame:
    """(cell, amplicon, allele_sequence, n)."""
    return reads.groupBy("cell", "amplicon", F.col("seq").alias("allele_sequence")).agg(F.count("*").alias("n"))


def restrict_known(alleles: DataFrame, dense: DataFrame) -> DataFrame:
    """Alleles of cells and amplicons that the summary has."""
    return alleles.join(dense.select("cell").distinct(), "cell", "left_semi").join(dense.select("amplicon").distinct(), "amplicon", "left_semi")


def allele_frequency(alleles: DataFrame) -> DataFrame:
    """Adds freq: percent of the reads of (cell, amplicon)."""
    return alleles.withColumn("freq", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("cell", "amplicon")))


def top2_alleles(alleles: DataFrame) -> DataFrame:
    """(cell, amplicon, allele_seq_1, allele_freq_1, allele_seq_2, allele_freq_2): the two most frequent, ties by sequence."""
    order = Window.partitionBy("cell", "amplicon").orderBy(F.desc("n"), "allele_sequence")
    ranked = allele_frequency(alleles).withColumn("r", F.row_number().over(order)).where("r <= 2")
    pick = lambda c, i: F.max(F.when(F.col("r") == i, F.col(c)))
    return ranked.groupBy("cell", "amplicon").agg(*[pick(c, i).alias(f"{name}_{i}") for i in (1, 2) for c, name in (("allele_sequence", "allele_seq"), ("freq", "allele_freq"))])


def main_layers(dense: DataFrame) -> DataFrame:
    """(cell, amplicon, mod_pct, tot_count): nulls become 0."""
    return dense.select("cell", "amplicon", F.coalesce("mod", F.lit(0.0)).cast("float").alias("mod_pct"), F.coalesce("tot", F.lit(0)).cast("int").alias("tot_count"))


def zygosity(dense: DataFrame, top2: DataFrame, params: ZygosityParams = ZygosityParams()) -> DataFrame:
    """(cell, amplicon, zygosity): 0 to 3; an entry without data is 0, or -1 if mark_no_data."""
    full = dense.join(top2.select("cell", "amplicon", "allele_freq_2"), ["cell", "amplicon"], "left")
    mod, second = F.coalesce("mod", F.lit(0.0)), F.coalesce("allele_freq_2", F.lit(0.0))
    code = F.when(mod <= params.low_pct, 0).when((mod >= params.high_pct) & (second < params.second_allele_pct), 2).when(mod >= params.high_pct, 3).otherwise(1)
    if params.mark_no_data:
        code = F.when(F.col("mod").isNull(), -1).otherwise(code)
    return full.select("cell", "amplicon", code.alias("zygosity"))


def layer_table(dense: DataFrame, top2: DataFrame, params: ZygosityParams = ZygosityParams()) -> DataFrame:
    """All layers of each (cell, amplicon)."""
    keys = ["cell", "amplicon"]
    return main_layers(dense).join(zygosity(dense, top2, params), keys).join(top2, keys, "left").select(
        *keys, "mod_pct", "tot_count", F.col("zygosity").cast("tinyint").alias("zygosity"),
        F.coalesce("allele_seq_1", F.lit("")).alias("allele_seq_1"), F.coalesce("allele_freq_1", F.lit(0.0)).cast("float").alias("allele_freq_1"),
        F.coalesce("allele_seq_2", F.lit("")).alias("allele_seq_2"), F.coalesce("allele_freq_2", F.lit(0.0)).cast("float").alias("allele_freq_2"))


def obs_table(dense: DataFrame, quality: DataFrame) -> DataFrame:
    """Every cell with its quality; cells without one have score 0, 0 reads, rank -1 and class Unknown."""
    cells = dense.select("cell").distinct().join(quality, "cell", "left")
    return cells.select("cell", F.coalesce("amplicon_score", F.lit(0.0)).alias("amplicon_score"), F.coalesce("read_count", F.lit(0)).cast("long").alias("read_count"),
                        F.coalesce("barcode_rank", F.lit(-1)).cast("long").alias("barcode_rank"), F.coalesce("color", F.lit("Unknown")).alias("color"))


def var_metadata(dense: DataFrame, amplicons: DataFrame) -> DataFrame:
    """Metadata of the amplicons that the summary has."""
    return dense.select("amplicon").distinct().join(amplicons, "amplicon", "left")


def var_statistics(dense: DataFrame) -> DataFrame:
    """Total and mean reads and mean edited share of each amplicon; nulls don't count, and end as 0."""
    found = dense.groupBy("amplicon").agg(F.coalesce(F.sum("tot"), F.lit(0)).cast("long").alias("total_coverage"),
                                          _mean("tot").alias("average_coverage"),
                                          F.when(F.count("mod") > 0, exact_mean(F.col("mod"))).alias("editing_efficiency"))
    return found.na.fill({"average_coverage": 0.0, "editing_efficiency": 0.0})


def _mean(column: str):
    return F.when(F.count(column) > 0, F.sum(column) / F.count(column))


def run_metadata(dense: DataFrame, **settings: str) -> DataFrame:
    """(name, value): counts of cells and amplicons, zygosity labels and the given settings."""
    counts = dense.agg(F.count_distinct("cell").cast("string").alias("cells"), F.count_distinct("amplicon").cast("string").alias("amplicons"))
    fixed = {f"zygosity {k}": v for k, v in ZYGOSITY_LABELS.items()} | settings
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in ("cells", "amplicons")], *[F.struct(F.lit(k).alias("name"), F.lit(v).alias("value")) for k, v in fixed.items()])
    return counts.select(F.explode(pairs).alias("x")).select("x.*")
