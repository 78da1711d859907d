"""Writers of the pipeline's tables. Wide and text forms exist only here; inside the library tables are long and typed."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assign, demux
from ..operators.checks import Watched
from ..operators.summary import wide_header, wide_lines


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder that driver and executors share: below spark.checkpoint.dir, or a temporary folder with a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/editloom"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _tsv(df: DataFrame, path: str, header: bool = True, **options) -> None:
    df.write.mode("overwrite").options(**options).csv(path, sep="\t", header=header, nullValue="NA", emptyValue="", quote="")


#: Options of a writer of large text: bases and names hardly shrink further at higher levels, which take several times as long.
FAST_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The files that a writer left in a folder, by name."""
    return sorted(spark.read.text(path).inputFiles(), key=lambda p: p.rsplit("/", 1)[-1])


def fastq_line(name: str, seq: str, qual: str, plus: str = "'+'"):
    return F.expr(f"concat('@', {name}, '\\n', {seq}, '\\n', {plus}, '\\n', {qual})")


#: Pairs of a lane of FASTQ files, at most, and at least while there are fewer lanes than cores.
LANE_PAIRS, LEAST_LANE_PAIRS = 1_000_000, 50_000


def write_mates(pairs: DataFrame, first: Column, second: Column, path: str, compress: bool = True, lane_pairs: int = LANE_PAIRS) -> None:
    """path/mate=1 and path/mate=2: the records first and second (text) of pairs, one file per lane each, in the same order.

    A task writes both files of its lanes, and numbers its pairs for that. Lanes are the partitions of pairs, cut after
    lane_pairs; pairs are dealt to as many lanes as there are cores first if they are few, or have fewer partitions, for
    which they are counted. They should come from a table.
    """
    cores, n = pairs.sparkSession.sparkContext.defaultParallelism, pairs.count()
    lanes = min(cores, -(-n // LEAST_LANE_PAIRS))
    if lanes > 1 and (n <= cores * lane_pairs or pairs.rdd.getNumPartitions() < cores):  # partitions of few pairs may be empty
        pairs = pairs.repartition(lanes)
    mates = F.array(F.struct(F.lit(1).alias("mate"), first.alias("value")), F.struct(F.lit(2).alias("mate"), second.alias("value")))
    rows = pairs.withColumn("_row", F.monotonically_increasing_id()).select("_row", F.explode(mates).alias("m")).select("m.mate", "m.value", "_row")
    text = rows.sortWithinPartitions("mate", "_row").drop("_row")
    text.write.mode("overwrite").option("maxRecordsPerFile", lane_pairs).partitionBy("mate").options(**FAST_GZIP if compress else {}).text(path)


def mates_of(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files of both mates that write_mates left, lane by lane; none of an empty table."""
    found = [[f for f in files_of(spark, path) if f"/mate={i}/" in f] for i in (1, 2)]
    return found[0], found[1]


def write_fastq_pairs(pairs: DataFrame, path: str, lanes: int | None = None, compress: bool = True) -> None:
    """FASTQ files of both mates, as write_mates has them. pairs: name, seq1, qual1, seq2, qual2. With `lanes`, pairs are dealt to so many first."""
    dealt = pairs.repartition(lanes, "name") if lanes else pairs
    write_mates(dealt, fastq_line("name", "seq1", "qual1"), fastq_line("name", "seq2", "qual2"), path, compress)


def write_tagged_reads(flagged: DataFrame, path: str) -> dict[str, int]:
    """Writes the tagged reads of flagged pairs and returns the funnel's counters, counted by the same job in one pass over the pairs."""
    watched = Watched(flagged, demux.funnel_counters())
    demux.tag_reads(watched.df).write.mode("overwrite").parquet(path)
    return watched.counts


def write_cell_counts(reads_per_cell: DataFrame, path: str) -> None:
    _tsv(reads_per_cell.select("cell", "reads"), path, header=False)


#: Rows of a file that is partitioned by amplicon, about.
FILE_ROWS = 2_000_000


def by_size(rows: DataFrame, by: str, tie: str, file_rows: int = FILE_ROWS, few: bool = False) -> DataFrame:
    """rows dealt out so that each value of `by` has as many files as its rows fill, and small values one file each.

    A histogram of `by`, a row for each value, says how many; it is joined as a table of unknown size, or broadcast if
    there are `few` values, so that rows are shuffled once. The rows of a large value are told apart by a hash of `tie`,
    which should hardly repeat. Columns stay as they are.
    """
    files = rows.groupBy(F.col(by).alias("_value")).agg(F.ceil(F.count("*") / file_rows).cast("int").alias("_files"))
    files = F.broadcast(files) if few else files
    part = F.pmod(F.xxhash64(tie), "_files")
    dealt = rows.join(files, F.col(by).eqNullSafe(F.col("_value")), "left").withColumn("_part", part)
    return dealt.repartition(by, "_part").drop("_value", "_files", "_part")


def dealt_writer(dealt: DataFrame, by: str, file_rows: int = FILE_ROWS):
    """A writer of by_size's rows, a folder for each value of `by`. Parts that meet in a task do not share a file beyond a quarter more than file_rows."""
    return dealt.write.mode("overwrite").option("maxRecordsPerFile", file_rows + file_rows // 4).partitionBy(by)


#: Folders of pairs by amplicon, about: a panel of more amplicons shares this many.
FOLDERS = 1_000


def write_reads_by_amplicon(assigned: DataFrame, path: str, file_rows: int = FILE_ROWS, folders: int = FOLDERS) -> dict[str, int]:
    """Partitioned by amplicon; pairs that were not assigned are the partition `unidentified`. Returns the totals of assignment.

    Of more than about `folders` amplicons, so many `group` folders are written instead, each with all pairs of its
    amplicons in the order of the column amplicon, so the number of files follows the rows. Files hold about file_rows
    pairs. The totals are counted behind the last shuffle by the job that writes, so tasks that run again do not count
    twice. assigned is read three times, twice for its amplicons alone: it should come from a table.
    """
    amplicon = F.coalesce("amplicon", F.lit("unidentified"))
    single = assigned.agg(F.approx_count_distinct("amplicon")).first()[0] <= folders
    group = F.when(F.col("amplicon").isNotNull(), F.pmod(F.xxhash64("amplicon"), F.lit(folders)).cast("string")).otherwise("unidentified")
    dealt = by_size(assigned.withColumn("_folder", amplicon if single else group), "_folder", "qname", file_rows, few=True)
    watched = Watched(dealt, assign.split_counters())
    named = watched.df.withColumn("amplicon", amplicon)
    if single:
        dealt_writer(named.drop("_folder"), "amplicon", file_rows).parquet(path)
    else:
        dealt_writer(named.withColumnRenamed("_folder", "group").sortWithinPartitions("group", "amplicon"), "group", file_rows).parquet(path)
    return watched.counts


def write_split_reports(reports: dict[str, DataFrame], path: str) -> None:
    """One small table for each report name."""
    for name, df in reports.items():
        _tsv(df, f"{path}/{name}")


def write_cell_summaries(cell_amplicon: DataFrame, path: str) -> None:
    """TSV partitioned by amplicon."""
    rows = by_size(cell_amplicon, "amplicon", "cell").sortWithinPartitions("amplicon", "cell")
    dealt_writer(rows, "amplicon").csv(path, sep="\t", header=True, nullValue="NA", quote="")


def write_consensus_alleles(records: DataFrame, path: str) -> None:
    """FASTQ text, partitioned by amplicon. records: amplicon, header (with @), sequence, quality."""
    text = records.select("amplicon", F.concat_ws("\n", "header", "sequence", F.lit("+"), "quality").alias("value"))
    dealt_writer(by_size(text, "amplicon", "value"), "amplicon").text(path)


def write_annotated_reads(reads: DataFrame, path: str) -> None:
    """FASTQ whose third line holds the annotation; ids end with the cell."""
    text = reads.select("amplicon", fastq_line("concat(read_id, ':', cell, ' x')", "seq", "repeat('a', cast(length(seq) as int))", "concat('+ ALN=', aln_ref, ' ', ann, ' ALN_REF=')").alias("value"))
    text.write.mode("overwrite").partitionBy("amplicon").text(path)


def write_matrices(dense: DataFrame, scored: DataFrame, amplicons: list[str], path: str) -> None:
    """Four wide tables: final and raw counts, of all and of scored cells. Each file starts with the header, an empty table too."""
    header = wide_header(amplicons)
    for name, rows in (("all", dense), ("scored", scored)):
        for kind, tot, mod in (("final", "tot", "mod"), ("raw", "raw_tot", "raw_mod")):
            lines = wide_lines(rows, amplicons, tot, mod)
            first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0  # of its file
            lines.select(F.when(first, F.concat(F.lit(header + "\n"), "value")).otherwise(F.col("value"))).write.mode("overwrite").text(f"{path}/{kind}_{name}")
            rows.sparkSession.createDataFrame([(header,)], "value string").coalesce(1).write.mode("append").text(f"{path}/{kind}_{name}")


def write_cell_quality(quality: DataFrame, path: str) -> None:
    _tsv(quality.select("cell", "amplicon_score", "read_count", "barcode_rank", "color"), path)


def write_allele_parquet(alleles: DataFrame, path: str) -> None:
    dealt_writer(by_size(alleles, "amplicon", "cell"), "amplicon").parquet(path, compression="snappy")


def write_layers(tables: dict[str, DataFrame], path: str) -> None:
    """obs, var, layers and run_metadata as Parquet tables of a star schema."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
