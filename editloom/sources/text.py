"""Readers of the pipeline's text tables. Files that matter by order get an ordinal column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.summary import unpivot_lines


def barcode_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, barcode), in file order. The file is read whole by one task: a whitelist is small and its order matters."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.rtrim(F.col("value"), F.lit("\n")), "\r?\n")).alias("ordinal", "barcode"))
    return lines.select("ordinal", F.trim("barcode").alias("barcode"))


def amplicons(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, amplicon, sequence, amp_seqs, guide, ref_allele_counts) from a headerless TSV of 2 to 4 columns.

    A missing count, or one with NA in it, is 2; one that is no number otherwise is null.
    """
    rows = barcode_whitelist(spark, path).where("barcode <> ''").select("ordinal", F.split("barcode", "\t").alias("f"))
    field = lambda i, d: F.coalesce(F.nullif(F.trim(F.get("f", F.lit(i))), F.lit("")), F.lit(d))
    return rows.select("ordinal", F.get("f", F.lit(0)).alias("amplicon"), F.get("f", F.lit(1)).alias("sequence"), F.split(F.get("f", F.lit(1)), ",").alias("amp_seqs"), field(2, "").alias("guide"),
                       F.transform(F.split(F.when(field(3, "2").contains("NA"), "2").otherwise(field(3, "2")), ","), lambda x: F.trim(x).try_cast("int")).alias("ref_allele_counts"))


def alternate_alleles(spark: SparkSession, path: str) -> DataFrame:
    """(amplicon, alt_seqs) from a TSV with header: first and third column."""
    rows = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    name, _, seqs = rows.columns[:3]
    return rows.select(F.col(f"`{name}`").alias("amplicon"), F.split(F.col(f"`{seqs}`"), ",").alias("alt_seqs"))


def alignments(spark: SparkSession, path: str, position: str = "int") -> DataFrame:
    """SAM text without header lines; pos is 0-based, of type position."""
    f = F.split("value", "\t")
    rows = spark.read.text(path).where("value <> '' AND NOT startswith(value, '@')").select(f.alias("f"))
    at = lambda i: F.get("f", F.lit(i))
    return rows.select(at(0).alias("qname"), at(1).cast("int").alias("flag"), at(2).alias("chr"), (at(3).cast(position) - 1).alias("pos"), at(4).cast("int").alias("mapq"), at(5).alias("cigar"), at(9).alias("seq"), at(10).alias("qual"))


def allele_frequency_table(spark: SparkSession, path: str) -> DataFrame:
    """The allele frequency table (unzipped TSV with header), with plain column names."""
    schema = "amplicon string, `Aligned_Sequence` string, `Read_Status` string, n_deleted int, n_inserted int, n_mutated int, `#Reads` long"
    rows = spark.read.csv(path, sep="\t", header=True, schema=schema)
    return rows.select("amplicon", F.col("Aligned_Sequence").alias("aligned_sequence"), F.col("Read_Status").alias("read_status"), "n_deleted", "n_inserted", "n_mutated", F.col("#Reads").alias("reads"))


def amplicon_info(spark: SparkSession, path: str, position: str = "int") -> DataFrame:
    """(amplicon, guide, aln_chr, aln_start, aln_end, aln_count); NA is null. Places are of type position."""
    return spark.read.csv(path, sep="\t", header=True, nullValue="NA", schema=f"amplicon string, guide string, aln_chr string, aln_start {position}, aln_end {position}, aln_count long")


def cell_summaries(spark: SparkSession, path: str) -> DataFrame:
    """(amplicon, cell, raw_reads, raw_mod_pct, final_reads, final_mut_pct) of a directory partitioned by amplicon."""
    schema = "cell string, all_cell_read_count long, all_cell_mut_pct double, all_cell_allele_string string, final_cell_read_count long, final_cell_mut_allele_pct double, amplicon string"
    rows = spark.read.csv(path, sep="\t", header=True, nullValue="NA", schema=schema)
    return rows.select("amplicon", "cell", F.col("all_cell_read_count").alias("raw_reads"), F.col("all_cell_mut_pct").alias("raw_mod_pct"), F.col("final_cell_read_count").alias("final_reads"), F.col("final_cell_mut_allele_pct").alias("final_mut_pct"))


def wide_summary(spark: SparkSession, path: str) -> DataFrame:
    """A wide summary as (cell, amplicon, tot, mod); NA is null. Lines that repeat the header, as each file's first does, are passed over."""
    lines = spark.read.text(path)
    header = lines.first()
    if header is None:
        raise ValueError(f"{path} has no header")
    return unpivot_lines(lines, header["value"])


def cell_quality(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="cell string, amplicon_score double, read_count long, barcode_rank long, color string")


def cell_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="cell string, reads long")


def run_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="amplicon string, reads long, result string, status string")
