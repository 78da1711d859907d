"""Queries through files: each writes a derived table with a sink and reads it back with its source."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alleles, assign, checks, demux, export, summary
from ..sources import fastq, sam, sinks, text
from . import cell_queries as cq
from . import read_queries as rq
from .cell_queries import NAMES
from .oracle import oracle
from .registry import ORACLES, query


def path_of(t, name: str) -> str:
    return sinks.scratch(t.spark, name)


def _scan_pairs(t, rows):
    path = path_of(t, "fastq")
    sinks.write_fastq_pairs(rows, path)
    return fastq.read_pairs(t.spark, *sinks.mates_of(t.spark, path))


@query("scan_fastq_pairs", oracle("SELECT name, seq1, qual1, seq2, qual2 FROM read_pairs", "read_pairs"))
def scan_fastq_pairs(t):
    return _scan_pairs(t, t.table("read_pairs")).select("name", "seq1", "qual1", "seq2", "qual2")


@query("scan_barcode_whitelist", oracle("SELECT ordinal, barcode FROM barcodes", "barcodes"))
def scan_barcode_whitelist(t):
    path = path_of(t, "whitelist")
    t.table("barcodes").coalesce(1).sortWithinPartitions("ordinal").select("barcode").write.text(path)
    return text.barcode_whitelist(t.spark, path)


@query("scan_amplicons", oracle("SELECT ordinal, amplicon, sequence, sequence AS amp_seqs, CASE WHEN ordinal % 2 = 0 THEN substr(sequence, 20, 20) ELSE '' END AS guide, CASE WHEN ordinal % 4 = 0 THEN '2,1' ELSE '2' END AS ref_allele_counts FROM amplicons", "amplicons"))
def scan_amplicons(t):
    path = path_of(t, "amplicons")
    guide = F.when(F.col("ordinal") % 4 == 0, F.concat(F.lit("\t"), F.substring("sequence", 20, 20), F.lit("\t2,1"))).when(
        F.col("ordinal") % 2 == 0, F.concat(F.lit("\t"), F.substring("sequence", 20, 20))).when(F.col("ordinal") % 4 == 1, "\t\tNA").otherwise("")
    t.amplicons().coalesce(1).sortWithinPartitions("ordinal").select(F.concat("amplicon", F.lit("\t"), "sequence", guide)).write.text(path)
    return text.amplicons(t.spark, path).select("ordinal", "amplicon", "sequence", F.array_join("amp_seqs", ",").alias("amp_seqs"), "guide", F.array_join(F.col("ref_allele_counts").cast("array<string>"), ",").alias("ref_allele_counts"))


@query("scan_alt_alleles", oracle("SELECT amplicon, alt_list FROM alternates", "alternates"))
def scan_alt_alleles(t):
    path = path_of(t, "alternates")
    t.table("alternates").select("amplicon", F.lit("x").alias("label"), "alt_list").write.csv(path, sep="\t", header=True)
    return text.alternate_alleles(t.spark, path).select("amplicon", F.array_join("alt_seqs", ",").alias("alt_list"))


def _sam(t, rows, name):
    path = path_of(t, name)
    rows.select(F.concat_ws("\t", "qname", F.col("flag").cast("string"), "chr", (F.col("pos") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual")).write.options(**sinks.FAST_GZIP).text(path)
    return text.alignments(t.spark, path, t.position())


@query("scan_sam_pairs", oracle("SELECT qname, flag, chr, pos, mapq, cigar, seq, qual FROM alignments", "alignments"))
def scan_sam_pairs(t):
    return _sam(t, t.table("alignments"), "sam")


@query("scan_amplicon_alignments", oracle("SELECT qname, flag, chr, pos, mapq, cigar, seq, qual FROM amplicon_alignments", "amplicon_alignments"))
def scan_amplicon_alignments(t):
    path = path_of(t, "amplicon-sam")
    t.spark.range(1).select(F.lit("@HD\tVN:1.0")).write.text(path)
    t.table("amplicon_alignments").select(F.concat_ws("\t", "qname", F.col("flag").cast("string"), "chr", (F.col("pos") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual")).write.mode("append").text(path)
    return text.alignments(t.spark, path, t.position())


@query("scan_annotated_reads", oracle("SELECT read_id || ':' || cell AS read_id, cell, aln_ref, ann, seq FROM annotated_reads", "annotated_reads"))
def scan_annotated_reads(t):
    path = path_of(t, "annotated")
    sinks.write_annotated_reads(t.table("annotated_reads"), path)
    return fastq.annotated_reads(fastq.read_records(t.spark, sinks.files_of(t.spark, path), cut_files=False))


@query("scan_allele_frequency_table", oracle("SELECT amplicon, aligned_sequence, read_status, n_deleted, n_inserted, n_mutated, reads FROM allele_frequencies", "allele_frequencies"))
def scan_allele_frequency_table(t):
    path = path_of(t, "frequencies")
    named = t.table("allele_frequencies").toDF("amplicon", "Aligned_Sequence", "Read_Status", "n_deleted", "n_inserted", "n_mutated", "#Reads")
    named.write.csv(path, sep="\t", header=True)
    return text.allele_frequency_table(t.spark, path)


@query("scan_amplicon_info", oracle("SELECT amplicon, CAST(NULL AS VARCHAR) AS guide, CASE WHEN ordinal % 2 = 0 THEN chr END AS aln_chr, CASE WHEN ordinal % 2 = 0 THEN start_pos END AS aln_start, CASE WHEN ordinal % 2 = 0 THEN end_pos END AS aln_end, CAST(1 AS BIGINT) AS aln_count FROM amplicons", "amplicons"))
def scan_amplicon_info(t):
    path = path_of(t, "info")
    even = lambda c: F.when(F.col("ordinal") % 2 == 0, F.col(c))
    rows = t.table("amplicons").select("amplicon", F.lit(None).cast("string").alias("guide"), even("chr").alias("aln_chr"), even("start_pos").alias("aln_start"), even("end_pos").alias("aln_end"), F.lit(1).alias("aln_count"))
    sinks.write_split_reports({"info": rows}, path)
    return text.amplicon_info(t.spark, f"{path}/info", t.position())


@query("scan_cell_summaries", oracle("SELECT amplicon, cell, raw_reads, raw_mod_pct, final_reads, final_mut_pct FROM sums", "sums"))
def scan_cell_summaries(t):
    path = path_of(t, "summaries")
    sinks.write_cell_summaries(alleles.cell_amplicon_summary(cq.usable(t), ploidies=cq.ploidies(t)), path)
    return text.cell_summaries(t.spark, path)


@query("scan_wide_summary", oracle("SELECT cell, amplicon, tot, mod FROM dense", "dense"))
def scan_wide_summary(t):
    path = path_of(t, "wide")
    dense = cq.dense(t)
    sinks.write_matrices(dense, dense.where("false"), NAMES, path)
    return text.wide_summary(t.spark, f"{path}/final_all")


@query("scan_cell_quality", oracle("SELECT cell, amplicon_score, read_count, barcode_rank, color FROM quality", "quality"))
def scan_cell_quality(t):
    path = path_of(t, "quality")
    sinks.write_cell_quality(cq.quality(t), path)
    return text.cell_quality(t.spark, path)


@query("scan_cell_counts", oracle("SELECT cell, count(*) AS reads FROM flagged WHERE clean GROUP BY cell", "flagged"))
def scan_cell_counts(t):
    path = path_of(t, "counts")
    sinks.write_cell_counts(demux.reads_per_cell(demux.tag_reads(rq.flagged(t))), path)
    return text.cell_counts(t.spark, path)


@query("scan_run_manifest", oracle("SELECT amplicon, reads, result, status FROM status", "status"))
def scan_run_manifest(t):
    path = path_of(t, "manifest")
    sinks.write_split_reports({"manifest": t.table("status")}, path)
    return text.run_manifest(t.spark, f"{path}/manifest")


@query("scan_filtered_alleles", oracle("SELECT amplicon, read_id AS cell, seq FROM annotated_reads WHERE aln_ref = 'Reference'", "annotated_reads"))
def scan_filtered_alleles(t):
    """Files of folders `..._on_<amplicon>`; the second-to-last field of an id is taken, here the read's own id."""
    path = path_of(t, "filtered")
    rows = t.table("annotated_reads").where("aln_ref = 'Reference'").withColumn("amplicon", F.concat(F.lit("run_on_"), "amplicon"))
    sinks.write_annotated_reads(rows, path)
    files = fastq.read_records(t.spark, sinks.files_of(t.spark, path))
    return fastq.filtered_alleles(files)


@query("scan_allele_parquet", oracle("SELECT cell, amplicon, allele_sequence, n FROM alleles", "alleles"))
def scan_allele_parquet(t):
    path = path_of(t, "alleles")
    sinks.write_allele_parquet(cq.filtered(t), path)
    return t.spark.read.parquet(path).select("cell", "amplicon", "allele_sequence", "n")


# Sinks


@query("write_tagged_reads", ORACLES["tag_reads"])
def write_tagged_reads(t):
    path = path_of(t, "tagged")
    sinks.write_tagged_reads(rq.flagged(t), path)
    return t.spark.read.parquet(path)


@query("parse_funnel_observed", ORACLES["parse_funnel"])
def parse_funnel_observed(t):
    """The funnel's counters as the job that writes the tagged reads observes them."""
    counts = sinks.write_tagged_reads(rq.flagged(t), path_of(t, "tagged"))
    return t.spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


@query("split_totals_observed", ORACLES["split_totals"])
def split_totals_observed(t):
    """The totals of assignment as the job that writes pairs by amplicon observes them."""
    counts = sinks.write_reads_by_amplicon(t.stage("strict", lambda: rq.strict(t)), path_of(t, "by-amplicon"))
    return t.spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


_SPOILED = """SELECT name, CASE WHEN substr(name, 4, 1) = '0' THEN concat('X', name) ELSE name END AS name2, seq1, CASE WHEN substr(name, 2, 1) = '0' THEN substr(qual1, 2) ELSE qual1 END AS qual1,
    seq2, CASE WHEN substr(name, 3, 2) = '11' THEN concat(qual2, 'I') ELSE qual2 END AS qual2, substr(name, 5, 2) <> '00' AS marked FROM {read_pairs}"""
_INPUT_CHECKS = " UNION ALL ".join(f"SELECT '{name}' AS \"check\", count(*) AS total, count(*) FILTER (NOT ({c})) AS failed, min(name) FILTER (NOT ({c})) AS example FROM spoiled" for name, c in (
    ("records have their marks", "marked"), ("qualities of R1", "length(seq1) = length(qual1)"), ("qualities of R2", "length(seq2) = length(qual2)"), ("names of mates", "name = name2")))


@query("assert_inputs", oracle("SELECT * FROM (WITH spoiled AS (" + _SPOILED.format(read_pairs="read_pairs") + ") " + _INPUT_CHECKS + ") q", "read_pairs"))
def assert_inputs(t):
    """Checks of FASTQ files of which some records are spoiled: marks, numbers of qualities, names of mates. Lanes are gzip, as plain files are several times as large."""
    path = path_of(t, "spoiled")
    rows = t.spark.sql(_SPOILED, read_pairs=t.table("read_pairs"))
    sinks.write_mates(rows, sinks.fastq_line("name", "seq1", "qual1"), sinks.fastq_line("name2", "seq2", "qual2", "if(marked, '+', 'x')"), path)
    read = fastq.read_checked_pairs(t.spark, *sinks.mates_of(t.spark, path), strict=False)
    return checks.failures(read, checks.pair_constraints(), F.col("name"))


def _sorted_sam(t):
    """Alignments as name-sorted text: some names without their second mate, some with a further record."""
    path = path_of(t, "sorted-sam")
    again = F.when(F.expr("flag & 128 = 0 AND substr(qname, 3, 1) = '0'"), F.array("flag", F.col("flag").bitwiseOR(256))).otherwise(F.array("flag"))
    rows = t.alignments_by_name().where("NOT (flag & 128 <> 0 AND substr(qname, 2, 1) = '0')").withColumn("flag", F.explode(again))
    fields = F.concat_ws("\t", "qname", F.col("flag").cast("string"), "chr", (F.col("pos") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual")
    rows.select(fields.alias("value")).write.options(**sinks.FAST_GZIP).text(path)  # each file is sorted by name
    return sam.name_sorted_pairs(t.spark, sinks.files_of(t.spark, path), split_bytes=1 << 20, position=t.position())


_RECORDS = "records AS (SELECT *, (flag & 128) <> 0 AS second FROM alignments WHERE NOT ((flag & 128) <> 0 AND substr(qname, 2, 1) = '0') UNION ALL SELECT * REPLACE (CAST(flag | 256 AS INT) AS flag), false FROM alignments WHERE (flag & 128) = 0 AND substr(qname, 3, 1) = '0')"
_ONE = {c: [f"any_value({c}) FILTER ({'NOT ' * (i == 1)}second) AS {c}{i}" for i in (1, 2)] for c in ("flag", "chr", "pos", "mapq", "cigar", "seq", "qual")}


@query("scan_sam_sorted_pairs", oracle(f"SELECT * FROM (WITH {_RECORDS} SELECT qname, {', '.join(x for pair in _ONE.values() for x in pair)} FROM records GROUP BY qname HAVING count(*) = 2 AND count(*) FILTER (second) = 1) q", "alignments"))
def scan_sam_sorted_pairs(t):
    return _sorted_sam(t)[0]


@query("sam_unpaired_names", oracle(f"SELECT * FROM (WITH {_RECORDS} SELECT qname, CAST(count(*) AS INT) AS records, CAST(count(*) FILTER (NOT second) AS INT) AS firsts FROM records GROUP BY qname HAVING NOT (count(*) = 2 AND count(*) FILTER (second) = 1)) q", "alignments"))
def sam_unpaired_names(t):
    """Names without a mate or with more than two records: the job that pairs them can refuse them, or count them."""
    return _sorted_sam(t)[1]


@query("write_cell_counts", oracle("SELECT cell, count(*) AS reads FROM aligned_pairs GROUP BY cell", "aligned_pairs"))
def write_cell_counts(t):
    path = path_of(t, "cell-counts")
    sinks.write_cell_counts(rq.depth(t), path)
    return text.cell_counts(t.spark, path)


@query("write_reads_by_amplicon", oracle("SELECT qname, cell, coalesce(amplicon, 'unidentified') AS amplicon, amp1, amp2, amp1_aln, amp2_aln, rescued FROM strict", "strict"))
def write_reads_by_amplicon(t):
    path = path_of(t, "by-amplicon")
    sinks.write_reads_by_amplicon(t.stage("strict", lambda: rq.strict(t)), path)
    return t.spark.read.parquet(path).select("qname", "cell", "amplicon", *assign.CALLS, "rescued")


_REPORTS = """SELECT 'classification' AS report, concat_ws('|', CAST(amplicon IS NOT NULL AS VARCHAR), coalesce(amp1, 'NA'), coalesce(amp2, 'NA'), coalesce(amp1_aln, 'NA'), coalesce(amp2_aln, 'NA')) AS key,
    'pair_count' AS measure, count(*) AS n FROM strict GROUP BY ALL
  UNION ALL SELECT 'cells', cell, 'aligned', count(*) FILTER (chr1 <> '*' AND chr2 <> '*') FROM strict GROUP BY cell
  UNION ALL SELECT 'cells', cell, 'unaligned', count(*) FILTER (chr1 = '*' OR chr2 = '*') FROM strict GROUP BY cell
  UNION ALL SELECT 'totals', 'all', 'total', count(*) FROM strict
  UNION ALL SELECT 'totals', 'all', 'aligned', count(*) FROM strict WHERE chr1 <> '*' AND chr2 <> '*'
  UNION ALL SELECT 'totals', 'all', 'identified', count(amplicon) FROM strict
  UNION ALL SELECT 'totals', 'all', 'rescued', count(*) FROM strict WHERE rescued
  UNION ALL SELECT 'totals', 'all', replace(r, ' ', '_'), (SELECT count(*) FROM strict WHERE amplicon IS NULL AND reason = r) FROM (VALUES ('chimeric'), ('other location'), ('unidentified')) v(r)"""


@query("write_split_reports", oracle(_REPORTS, "strict"))
def write_split_reports(t):
    """All three reports, read back as (report, key, measure, n)."""
    path = path_of(t, "reports")
    assigned = t.stage("calls-of-cells", lambda: rq.strict(t).select("cell", "chr1", "chr2", *assign.CALLS, "amplicon", "rescued"))  # what the reports count: no names, primers or places
    sinks.write_split_reports({"classification": assign.call_combinations(assigned), "totals": assign.split_totals(assigned), "cells": assign.pairs_per_cell_status(assigned)}, path)
    table = lambda name, schema: t.spark.read.csv(f"{path}/{name}", sep="\t", header=True, nullValue="NA", schema=schema)
    calls = [F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in ("valid", *assign.CALLS)]
    classes = table("classification", "valid boolean, amp1 string, amp2 string, amp1_aln string, amp2_aln string, pair_count long").select(F.concat_ws("|", *calls).alias("key"), "pair_count")
    totals = table("totals", "total long, aligned long, identified long, rescued long, chimeric long, other_location long, unidentified long").withColumn("key", F.lit("all"))
    found = {"classification": classes, "totals": totals, "cells": table("cells", "key string, aligned long, unaligned long")}
    out = [df.unpivot("key", [c for c in df.columns if c != "key"], "measure", "n").select(F.lit(name).alias("report"), "key", "measure", "n") for name, df in found.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("write_cell_summaries", ORACLES["cell_amplicon_summary"])
def write_cell_summaries(t):
    path = path_of(t, "cell-summaries")
    rows = t.stage("cell-rows", lambda: alleles.cell_amplicon_summary(cq.usable(t), ploidies=cq.ploidies(t)))  # read twice
    sinks.write_cell_summaries(rows, path)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "amplicon")
    return t.spark.read.csv(path, sep="\t", header=True, nullValue="NA", schema=f"{schema}, amplicon string")


@query("write_consensus_alleles", oracle("SELECT amplicon || ':' || CASE WHEN adjusted THEN 'Adjusted:' ELSE '' END || replace(allele_key, ' ', '_') || ':' || cell || ':' || CAST(slot AS VARCHAR) AS name, sequence AS seq, repeat('a', length(sequence)) AS qual, cell, amplicon FROM consensus", "consensus"))
def write_consensus_alleles(t):
    path = path_of(t, "consensus")
    sinks.write_consensus_alleles(t.stage("consensus-records", lambda: alleles.allele_records(cq.consensus(t))), path)  # read twice
    read = fastq.read_records(t.spark, sinks.files_of(t.spark, path), cut_files=False)
    return read.select("name", "seq", "qual", fastq.second_last_field(F.col("name")).alias("cell"), F.regexp_extract("path", "amplicon=([^/]+)/", 1).alias("amplicon"))


_MATRICES = " UNION ALL ".join(f"SELECT '{kind}_{rows}' AS matrix, cell, amplicon, {tot} AS tot, {mod} AS mod FROM dense" + (" WHERE cell IN (SELECT cell FROM quality)" if rows == "scored" else "")
                               for kind, tot, mod in (("final", "tot", "mod"), ("raw", "raw_tot", "raw_mod")) for rows in ("all", "scored"))


@query("write_matrices", oracle(_MATRICES, "quality"))
def write_matrices(t):
    path = path_of(t, "matrices")
    dense = cq.dense(t)
    sinks.write_matrices(dense, summary.scored_only(dense, cq.quality(t)), NAMES, path)
    out = [text.wide_summary(t.spark, f"{path}/{name}").withColumn("matrix", F.lit(name)) for name in ("final_all", "raw_all", "final_scored", "raw_scored")]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("write_cell_quality", ORACLES["quality_class"])
def write_cell_quality(t):
    path = path_of(t, "cell-quality")
    sinks.write_cell_quality(cq.quality(t), path)
    return text.cell_quality(t.spark, path)


@query("write_filter_failures", oracle("SELECT amplicon, reads, result, status FROM status WHERE status <> 'Completed'", "status"))
def write_filter_failures(t):
    path = path_of(t, "failures")
    sinks.write_split_reports({"failures": summary.filter_failures(t.table("status"))}, path)
    return text.run_manifest(t.spark, f"{path}/failures")


@query("write_allele_parquet", ORACLES["filtered_allele_counts"])
def write_allele_parquet(t):
    path = path_of(t, "allele-parquet")
    sinks.write_allele_parquet(cq.filtered(t), path)
    return t.spark.read.parquet(path).select("cell", "amplicon", "allele_sequence", "n")


_SETTINGS = """SELECT 'cells' AS name, CAST(count(DISTINCT cell) AS VARCHAR) AS value FROM dense UNION ALL SELECT 'amplicons', CAST(count(DISTINCT amplicon) AS VARCHAR) FROM dense
  UNION ALL SELECT * FROM (VALUES """ + ", ".join(f"('zygosity {k}', '{v}')" for k, v in export.ZYGOSITY_LABELS.items()) + ", ('assembly', 'none')) m"
_LAYERS = f"""SELECT l.*, amplicon_score, read_count, barcode_rank, color, total_coverage, average_coverage, editing_efficiency,
    (SELECT string_agg(name || '=' || value, ';' ORDER BY name) FROM ({_SETTINGS}) s) AS settings
  FROM layers l JOIN quality q ON l.cell = q.cell JOIN var_stats v ON l.amplicon = v.amplicon"""


@query("write_layers", oracle(_LAYERS, "layers", "quality", "var_stats"))
def write_layers(t):
    """All four tables, joined; the few settings are one row."""
    path = path_of(t, "layers")
    dense, quality = cq.dense(t), cq.quality(t)
    sinks.write_layers({"obs": export.obs_table(dense, quality), "var": export.var_statistics(dense), "layers": export.layer_table(dense, export.top2_alleles(cq.filtered(t))),
                        "run_metadata": export.run_metadata(dense, assembly="none")}, path)
    layers, obs, var, settings = (t.spark.read.parquet(f"{path}/{name}") for name in ("layers", "obs", "var", "run_metadata"))
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "value"))), lambda s: F.concat_ws("=", s["name"], s["value"])), ";")
    return layers.join(obs, "cell").join(var, "amplicon").crossJoin(settings.agg(line.alias("settings")))
