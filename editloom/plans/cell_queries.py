"""Queries on annotated reads: alleles, the cell by amplicon table, quality, QC data sets and export."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import sequence as sq
from ..operators import alleles, export, qc, summary
from ..params import CallParams
from .fixtures import PANEL, Fixtures
from .oracle import PLACE, QUALITY, oracle, pct
from .registry import query

KEYS = "amplicon, cell"


def usable(t: Fixtures):
    return alleles.usable_reads(t.table("annotated_reads"))


def counts(t: Fixtures):
    return alleles.allele_counts(usable(t))


def ploidies(t: Fixtures):
    return alleles.reference_ploidies(t.amplicons())


def called(t: Fixtures):
    return alleles.allele_call(counts(t), ploidies=ploidies(t))


def sums(t: Fixtures):
    def make():
        found = alleles.cell_amplicon_summary(usable(t), ploidies=ploidies(t))
        return found.select("amplicon", "cell", F.col("all_cell_read_count").alias("raw_reads"), F.col("all_cell_mut_pct").alias("raw_mod_pct"),
                            F.col("final_cell_read_count").alias("final_reads"), F.col("final_cell_mut_allele_pct").alias("final_mut_pct"))

    return t.stage("summary", make)


def dense(t: Fixtures):
    return t.stage("cell-amplicon", lambda: summary.densify(sums(t), t.table("panel")))


def quality(t: Fixtures):
    return t.stage("quality", lambda: summary.cell_quality(dense(t), QUALITY))


def filtered(t: Fixtures):
    return export.filtered_allele_counts(t.table("annotated_reads").where("aln_ref = 'Reference'"))


# Filters and annotations

_LINE = "concat('+ ALN=', aln_ref, ' ALN_SCORES=90 ', ann, ' ALN_REF=ACGT')"


@query("annotation_fields", oracle("SELECT read_id, aln_ref, ann FROM annotated_reads", "annotated_reads"))
def annotation_fields(t):
    lines = t.table("annotated_reads").select("read_id", F.expr(_LINE).alias("line"))
    return lines.select("read_id", sq.annotation_reference(F.col("line")).alias("aln_ref"), sq.annotation_edits(F.col("line")).alias("ann"))


@query("filter_unaligned_annotation", oracle("SELECT read_id, aln_ref FROM annotated_reads WHERE aln_ref <> 'NA'", "annotated_reads"))
def filter_unaligned_annotation(t):
    return alleles.filter_unaligned(t.table("annotated_reads")).select("read_id", "aln_ref")


@query("filter_ambiguous_reference", oracle("SELECT read_id, aln_ref FROM annotated_reads WHERE NOT contains(aln_ref, '&')", "annotated_reads"))
def filter_ambiguous_reference(t):
    return alleles.filter_ambiguous(t.table("annotated_reads")).select("read_id", "aln_ref")


@query("filter_blank_cell", oracle("SELECT read_id, CASE WHEN ann LIKE 'DEL= %' THEN cell ELSE ' ' END AS cell FROM annotated_reads WHERE ann LIKE 'DEL= %'", "annotated_reads"))
def filter_blank_cell(t):
    """On reads of which those with a deletion have lost their cell."""
    rows = t.table("annotated_reads").withColumn("cell", F.when(F.col("ann").startswith("DEL= "), F.col("cell")).otherwise(" "))
    return alleles.filter_blank_cell(rows).select("read_id", "cell")


_WT = "translate(md5(concat(amplicon, 'DEL= INS= SUB=')),'0123456789abcdef','ACGTACGTACGTACGT')"


@query("amplicon_arm_flags", oracle(f"SELECT read_id, substr(seq,1,30) = substr(w,1,30) AS starts_known, substr(seq,3,30) = substr(w,3,30) AS ends_known FROM (SELECT *, {_WT} AS w FROM annotated_reads) q", "annotated_reads"))
def amplicon_arm_flags(t):
    known = t.amplicons().select("amplicon", F.array(F.expr(_WT)).alias("amp_seqs"))
    return alleles.arm_flags(t.table("annotated_reads"), known).select("read_id", "starts_known", "ends_known")


@query("annotation_totals", oracle("SELECT amplicon, count(*) AS total_reads, count(*) FILTER (aln_ref <> 'NA') AS aligned_reads FROM annotated_reads GROUP BY amplicon", "annotated_reads"))
def annotation_totals(t):
    return alleles.annotation_totals(t.table("annotated_reads"))


@query("references_seen", oracle("SELECT amplicon, count(DISTINCT aln_ref) AS \"references\", count(DISTINCT aln_ref) > 1 AS more_than_expected FROM annotated_reads WHERE aln_ref <> 'NA' AND NOT contains(aln_ref, '&') GROUP BY amplicon", "annotated_reads"))
def references_seen(t):
    return alleles.references_seen(t.table("annotated_reads"))


# Counts and calls


@query("mod_unmod_counts", oracle("SELECT amplicon, cell, mod, unmod FROM mods", "mods"))
def mod_unmod_counts(t):
    return alleles.mod_unmod_counts(usable(t))


@query("raw_mod_pct", oracle("SELECT amplicon, cell, raw_reads, raw_mod_pct FROM raw", "raw"))
def raw_mod_pct(t):
    return alleles.raw_summary(usable(t))


@query("allele_counts", oracle("SELECT amplicon, cell, allele_key, n FROM counts", "counts"))
def allele_counts(t):
    return counts(t).select("amplicon", "cell", "allele_key", "n")


@query("allele_counts_without_substitutions", oracle("SELECT amplicon, cell, aln_ref || ':' || regexp_extract(ann, '^(DEL=.* INS=.*) SUB=', 1) AS allele_key, count(*) AS n FROM usable GROUP BY ALL", "usable"))
def allele_counts_without_substitutions(t):
    return alleles.allele_counts(usable(t), CallParams(ignore_substitutions=True)).select("amplicon", "cell", "allele_key", "n")


@query("allele_sequence_counts", oracle("SELECT amplicon, cell, allele_key, seq, n FROM seqs", "seqs"))
def allele_sequence_counts(t):
    return alleles.allele_sequence_counts(usable(t))


@query("cell_read_counts", oracle("SELECT amplicon, cell, count(*) AS reads FROM usable GROUP BY ALL", "usable"))
def cell_read_counts(t):
    return alleles.cell_read_counts(usable(t))


@query("allele_string", oracle("SELECT amplicon, cell, allele_string FROM allele_strings", "allele_strings"))
def allele_string(t):
    return alleles.allele_string(counts(t))


@query("reference_ploidies", oracle("SELECT amplicon, ref, ploidy FROM ploidies", "ploidies"))
def reference_ploidies(t):
    return ploidies(t)


@query("rank_alleles_per_reference", oracle("SELECT amplicon, cell, ref, allele_key, n, rnk FROM ranked", "ranked"))
def rank_alleles_per_reference(t):
    return alleles.rank_alleles(counts(t)).withColumn("rnk", F.col("rnk").cast("long"))


@query("allele_call", oracle("SELECT amplicon, cell, ref, slot, allele_key, n FROM called", "called"))
def allele_call(t):
    return called(t)


@query("mutation_type", oracle("SELECT amplicon, cell, slot, flag, types FROM typed", "typed"))
def mutation_type(t):
    return alleles.with_types(called(t)).select("amplicon", "cell", "slot", "flag", "types")


@query("final_cell_strings", oracle("SELECT * FROM strings", "strings"))
def final_cell_strings(t):
    return alleles.final_cell_strings(called(t))


@query("final_cell_totals", oracle("SELECT * FROM final", "final"))
def final_cell_totals(t):
    return alleles.final_cell_totals(called(t))


@query("per_reference_totals", oracle(f"SELECT amplicon, cell, ref, CAST(sum(n) AS BIGINT) AS ref_reads, {pct('''count(*) FILTER (flag = 'M')''', 'count(*)')} AS ref_mut_pct FROM typed GROUP BY amplicon, cell, ref", "typed"))
def per_reference_totals(t):
    return alleles.per_reference_totals(called(t))


_PER_REF = f"SELECT amplicon, cell, {PLACE} AS place, ref, CAST(sum(n) AS BIGINT) AS ref_reads, {pct("count(*) FILTER (flag = 'M')", 'count(*)')} AS ref_mut_pct FROM typed GROUP BY amplicon, cell, ref"
_SUMMARY = f"""SELECT cell, amplicon, raw_reads AS all_cell_read_count, raw_mod_pct AS all_cell_mut_pct, allele_string AS all_cell_allele_string, final_reads AS final_cell_read_count, final_mut_pct AS final_cell_mut_allele_pct,
    final_alleles AS final_cell_allele_string, refs AS final_num_refs_covered, final_flags AS final_cell_allele_mod_string, final_types AS final_cell_allele_mod_types_string, final_counts AS final_cell_allele_readcount_string,
    ref_reads AS final_ref_read_count_string, ref_pcts AS final_ref_mut_allele_fracs_string FROM sums JOIN allele_strings USING (amplicon, cell) JOIN strings USING (amplicon, cell)
    JOIN (SELECT amplicon, cell, count(*) AS refs, string_agg(CAST(ref_reads AS VARCHAR), ',' ORDER BY place, ref) AS ref_reads, string_agg(printf('%.2f', ref_mut_pct), ',' ORDER BY place, ref) AS ref_pcts
      FROM ({_PER_REF}) r GROUP BY amplicon, cell) o USING (amplicon, cell)"""


@query("cell_amplicon_summary", oracle(_SUMMARY, "sums", "allele_strings", "strings"))
def cell_amplicon_summary(t):
    return alleles.cell_amplicon_summary(usable(t), ploidies=ploidies(t))


@query("filter_report_depth", oracle(f"SELECT cell, amplicon, all_cell_read_count FROM ({_SUMMARY}) q WHERE all_cell_read_count >= 5", "sums", "allele_strings", "strings"))
def filter_report_depth(t):
    return alleles.filter_report_depth(alleles.cell_amplicon_summary(usable(t), ploidies=ploidies(t))).select("cell", "amplicon", "all_cell_read_count")


@query("filter_unmodified_alleles", oracle("SELECT amplicon, aligned_sequence, reads FROM allele_frequencies WHERE read_status = 'UNMODIFIED' AND n_deleted = 0 AND n_inserted = 0 AND n_mutated = 0", "allele_frequencies"))
def filter_unmodified_alleles(t):
    return alleles.unmodified_alleles(t.table("allele_frequencies")).select("amplicon", "aligned_sequence", "reads")


@query("wildtype_allele", oracle("SELECT amplicon, wildtype FROM wild", "wild"))
def wildtype_allele(t):
    return alleles.wildtype_allele(t.table("allele_frequencies"))


@query("attach_wildtype", oracle("SELECT c.amplicon, cell, slot, wildtype FROM called c LEFT JOIN wild w ON c.amplicon = w.amplicon AND w.amplicon <> 'AMP_03'", "called", "wild"))
def attach_wildtype(t):
    """One amplicon has no known wildtype."""
    wild = alleles.wildtype_allele(t.table("allele_frequencies")).where("amplicon <> 'AMP_03'")
    return alleles.attach_wildtype(called(t), wild).select("amplicon", "cell", "slot", "wildtype")


def consensus(t: Fixtures, reads=None):
    """Consensus alleles of all usable reads, or of some cells' reads; the wildtypes are those of all reads."""
    t.written("annotated_reads")  # the alleles, the wildtypes and the cells' classes are all made of it
    return alleles.consensus_alleles(usable(t) if reads is None else reads, alleles.wildtype_allele(t.table("allele_frequencies")), ploidies=ploidies(t))


@query("consensus_sequence", oracle("SELECT amplicon, cell, ref, slot, allele_key, sequence, adjusted FROM consensus", "consensus"))
def consensus_sequence(t):
    return consensus(t)


@query("allele_record", oracle("SELECT amplicon, cell, slot, '@' || amplicon || ':' || CASE WHEN adjusted THEN 'Adjusted:' ELSE '' END || replace(allele_key, ' ', '_') || ':' || cell || ':' || CAST(slot AS VARCHAR) AS header, sequence, repeat('a', length(sequence)) AS quality FROM consensus", "consensus"))
def allele_record(t):
    return alleles.allele_records(consensus(t))


# The cell by amplicon table


@query("amplicon_status_counts", oracle("SELECT status, count(*) AS amplicons FROM status GROUP BY status", "status"))
def amplicon_status_counts(t):
    return summary.status_counts(t.table("status"))


@query("usable_amplicons", oracle("SELECT amplicon FROM usable_amps", "usable_amps"))
def usable_amplicons(t):
    return summary.usable_amplicons(t.table("panel"))


@query("densify_cell_amplicon", oracle("SELECT cell, amplicon, raw_tot, raw_mod, tot, mod FROM dense", "dense"))
def densify_cell_amplicon(t):
    return dense(t)


NAMES = [f"AMP_{i:02d}" for i in range(PANEL + 1)]


def _wide_sql(tot: str, mod: str, where: str = "") -> str:
    picks = ", ".join(f"max({c}) FILTER (amplicon = '{a}') AS \"{k}.{a}\"" for a in NAMES for c, k in ((tot, "totCount"), (mod, "modPct")))
    return f"SELECT cell, {picks} FROM dense {where} GROUP BY cell"


_SCORED = "WHERE cell IN (SELECT cell FROM quality)"


@query("pivot_final", oracle(_wide_sql("tot", "mod"), "dense"))
def pivot_final(t):
    return summary.wide(dense(t), NAMES)


@query("pivot_raw", oracle(_wide_sql("raw_tot", "raw_mod"), "dense"))
def pivot_raw(t):
    return summary.wide(dense(t), NAMES, "raw_tot", "raw_mod")


@query("pivot_final_scored", oracle(_wide_sql("tot", "mod", _SCORED), "quality"))
def pivot_final_scored(t):
    return summary.wide(summary.scored_only(dense(t), quality(t)), NAMES)


@query("pivot_raw_scored", oracle(_wide_sql("raw_tot", "raw_mod", _SCORED), "quality"))
def pivot_raw_scored(t):
    return summary.wide(summary.scored_only(dense(t), quality(t)), NAMES, "raw_tot", "raw_mod")


@query("unpivot_metrics", oracle("SELECT cell, amplicon, tot, mod FROM dense", "dense"))
def unpivot_metrics(t):
    return summary.unpivot_wide(summary.wide(dense(t), NAMES))


@query("select_metric_columns", oracle("SELECT cell, " + ", ".join(f"max(tot) FILTER (amplicon = '{a}') AS \"totCount.{a}\"" for a in NAMES) + " FROM dense GROUP BY cell", "dense"))
def select_metric_columns(t):
    wide = summary.wide(dense(t), NAMES)
    return wide.select("cell", *[f"`{c}`" for c in summary.metric_columns(wide.columns, "totCount")])


@query("amplicon_names_from_columns", oracle("SELECT DISTINCT amplicon FROM dense", "dense"))
def amplicon_names_from_columns(t):
    wide = summary.wide(dense(t), NAMES)
    names = F.array(*map(F.lit, summary.amplicon_names(wide.columns)))
    return wide.select(F.explode(names).alias("amplicon")).distinct()


@query("union_amplicon_summaries", oracle("SELECT DISTINCT cell FROM sums", "sums"))
def union_amplicon_summaries(t):
    return sums(t).select("cell").distinct()


@query("explode_lists", oracle("SELECT amplicon, CAST(i - 1 AS INT) AS place, string_split(alt_list, ',')[i] AS allele FROM alternates, range(1, 3) r(i)", "alternates"))
def explode_lists(t):
    return t.table("alternates").select("amplicon", F.posexplode(F.split("alt_list", ",")).alias("place", "allele"))


@query("safe_pct", oracle("SELECT cell, amplicon, coalesce(" + pct("coalesce(tot, 0)", "coalesce(raw_tot, 0)") + ", 0) AS share FROM dense", "dense"))
def safe_pct(t):
    return dense(t).select("cell", "amplicon", sq.safe_pct(F.coalesce("tot", F.lit(0)), F.coalesce("raw_tot", F.lit(0))).alias("share"))


@query("parse_na_number", oracle("SELECT cell, amplicon, mod FROM dense", "dense"))
def parse_na_number(t):
    as_text = dense(t).select("cell", "amplicon", F.coalesce(F.col("mod").cast("string"), F.lit("NA")).alias("token"))
    return as_text.select("cell", "amplicon", sq.parse_na_number(F.col("token")).alias("mod"))


# Quality


#: The panel's last amplicon has an empty summary and so no reads in any cell: no cell would pass a gate with it.
_WITH_READS = f"amplicon <> '{NAMES[-1]}'"


@query("filter_min_reads_all_amplicons", oracle(f"SELECT cell FROM dense WHERE raw_tot IS NOT NULL AND {_WITH_READS} GROUP BY cell HAVING min(raw_tot) >= 1", "dense"))
def filter_min_reads_all_amplicons(t):
    """About half of the cells have a read at every amplicon that has any."""
    return summary.depth_mask(dense(t).where(_WITH_READS), _deep()).where("keep").select("cell")


def _deep():
    return replace(QUALITY, min_reads_per_amplicon=1)


@query("depth_gate_count", oracle("SELECT count(*) FILTER (m < 3) AS failing_cells FROM (SELECT min(raw_tot) AS m FROM dense WHERE raw_tot IS NOT NULL GROUP BY cell) q", "dense"))
def depth_gate_count(t):
    return summary.depth_gate_count(dense(t), replace(QUALITY, min_reads_per_amplicon=3))


@query("amplicon_percentiles", oracle("SELECT amplicon, q0, q1, q2, q3 FROM quant", "quant"))
def amplicon_percentiles(t):
    found = summary.amplicon_percentiles(dense(t), QUALITY)
    return found.select("amplicon", *[F.get("quantiles", F.lit(i)).alias(f"q{i}") for i in range(4)])


@query("amplicon_score", oracle("SELECT cell, amplicon_score, read_count FROM score", "score"))
def amplicon_score(t):
    return summary.amplicon_score(dense(t), QUALITY)


@query("cell_total_reads", oracle("SELECT cell, CAST(coalesce(sum(raw_tot),0) AS BIGINT) AS read_count FROM dense GROUP BY cell", "dense"))
def cell_total_reads(t):
    return summary.cell_total_reads(dense(t))


@query("barcode_rank", oracle("SELECT cell, read_count, barcode_rank FROM cell_ranks", "cell_ranks"))
def barcode_rank(t):
    return summary.barcode_rank(summary.amplicon_score(dense(t), QUALITY)).select("cell", "read_count", "barcode_rank")


@query("quality_class", oracle("SELECT cell, amplicon_score, read_count, barcode_rank, color FROM quality", "quality"))
def quality_class(t):
    return quality(t)


@query("filter_min_total_reads", oracle("SELECT cell, read_count, barcode_rank, color FROM quality WHERE read_count >= 35", "quality"))
def filter_min_total_reads(t):
    from dataclasses import replace

    return summary.cell_quality(dense(t), replace(QUALITY, min_total_reads=35)).select("cell", "read_count", "barcode_rank", "color")


@query("quality_class_counts", oracle("SELECT color, count(*) AS cells FROM quality GROUP BY color", "quality"))
def quality_class_counts(t):
    return summary.quality_class_counts(quality(t))


@query("attach_quality", oracle("SELECT cell, amplicon, tot, color FROM dense JOIN quality USING (cell)", "quality"))
def attach_quality(t):
    return summary.attach_quality(dense(t), quality(t)).select("cell", "amplicon", "tot", "color")


@query("scored_cells_summary", oracle(f"SELECT cell, amplicon, tot FROM dense {_SCORED}", "quality"))
def scored_cells_summary(t):
    return summary.scored_only(dense(t), quality(t)).select("cell", "amplicon", "tot")


@query("filter_quality_class", oracle("SELECT cell, amplicon, tot, mod FROM picked", "picked"))
def filter_quality_class(t):
    return summary.select_cells(dense(t), quality(t), QUALITY).select("cell", "amplicon", "tot", "mod")


@query("reads_of_good_cells", oracle("SELECT read_id, cell, amplicon FROM annotated_reads WHERE cell IN (SELECT cell FROM quality WHERE color IN ('HQ_HI','HQ_LO'))", "quality"))
def reads_of_good_cells(t):
    return summary.select_cells(t.table("annotated_reads"), quality(t), QUALITY).select("read_id", "cell", "amplicon")


@query("alleles_of_good_cells", oracle("SELECT amplicon, cell, slot, sequence FROM consensus WHERE cell IN (SELECT cell FROM quality WHERE color IN ('HQ_HI','HQ_LO'))", "quality", "consensus"))
def alleles_of_good_cells(t):
    """Alleles are called within a cell, so the cells are selected before. They are written, as their number then is known."""
    t.written("annotated_reads")
    good = t.stage("good-cells", lambda: quality(t).where(summary.in_classes(QUALITY.selected)))
    return consensus(t, summary.select_cells(usable(t), good, QUALITY)).select("amplicon", "cell", "slot", "sequence")


@query("quality_group_complement", oracle("SELECT cell, CASE WHEN color IN ('HQ_HI','HQ_LO') THEN 'High' ELSE 'Low' END AS quality_group FROM quality", "quality"))
def quality_group_complement(t):
    return quality(t).select("cell", summary.quality_group(QUALITY).alias("quality_group"))


# QC data sets


@query("amplicon_mean_coverage", oracle("SELECT amplicon, mean_coverage FROM coverage", "coverage"))
def amplicon_mean_coverage(t):
    return qc.amplicon_mean_coverage(dense(t), quality(t), QUALITY)


@query("extreme_amplicons", oracle("(SELECT amplicon, mean_coverage, 'highest' AS \"end\" FROM coverage ORDER BY mean_coverage DESC, amplicon LIMIT 3) UNION ALL (SELECT amplicon, mean_coverage, 'lowest' FROM coverage ORDER BY mean_coverage, amplicon LIMIT 3)", "coverage"))
def extreme_amplicons(t):
    return qc.extreme_amplicons(qc.amplicon_mean_coverage(dense(t), quality(t), QUALITY))


@query("depth_by_quality_group", oracle("SELECT quality_group, count(*) AS cells, CAST(min(reads) AS DOUBLE) AS least, quantile_cont(CAST(reads AS DOUBLE), 0.25) AS lower, quantile_cont(CAST(reads AS DOUBLE), 0.5) AS median, quantile_cont(CAST(reads AS DOUBLE), 0.75) AS upper, CAST(max(reads) AS DOUBLE) AS most FROM depths GROUP BY quality_group", "depths"))
def depth_by_quality_group(t):
    return qc.depth_by_group(dense(t), quality(t), QUALITY)


@query("mean_depth_by_quality_group", oracle("SELECT quality_group, sum(reads) / count(*) AS mean_reads FROM depths GROUP BY quality_group", "depths"))
def mean_depth_by_quality_group(t):
    return qc.mean_depth_by_group(dense(t), quality(t), QUALITY)


@query("edited_sites_histogram", oracle("SELECT edited_sites, count(*) AS cells FROM (SELECT cell, count(*) FILTER (mod > 0) AS edited_sites FROM picked GROUP BY cell) q GROUP BY edited_sites", "picked"))
def edited_sites_histogram(t):
    return qc.edited_sites_histogram(dense(t), quality(t), QUALITY)


@query("edit_combinations", oracle("SELECT pattern, count(*) AS cells FROM patterns GROUP BY pattern", "patterns"))
def edit_combinations(t):
    return qc.edit_combinations(dense(t), quality(t), QUALITY)


@query("top_edit_combinations", oracle("SELECT cell, pattern FROM patterns WHERE pattern IN (SELECT pattern FROM patterns GROUP BY pattern ORDER BY count(*) DESC, pattern LIMIT 5)", "patterns"))
def top_edit_combinations(t):
    return qc.top_edit_combinations(dense(t), quality(t), 5, QUALITY)


_T = "(VALUES (1),(5),(10),(25),(50),(100)) v(threshold)"


@query("cells_per_amplicon_at_depth", oracle(f"SELECT amplicon, threshold, count(*) FILTER (raw_tot >= threshold) AS cells FROM scored, {_T} GROUP BY ALL", "scored"))
def cells_per_amplicon_at_depth(t):
    return qc.cells_per_amplicon_at_depth(summary.scored_rows(dense(t), QUALITY))


@query("amplicons_per_cell_at_depth", oracle(f"SELECT threshold, CAST(100*s AS INT) AS share_pct, count(*) FILTER (m > round_even(s*n, 0)) AS cells FROM (SELECT cell, threshold, count(*) AS n, count(*) FILTER (raw_tot >= threshold) AS m FROM scored, {_T} GROUP BY ALL) q, (VALUES (1.0),(0.9),(0.8),(0.5)) w(s) GROUP BY ALL", "scored"))
def amplicons_per_cell_at_depth(t):
    return qc.amplicons_per_cell_at_depth(summary.scored_rows(dense(t), QUALITY))


@query("mean_mod_by_depth", oracle(f"SELECT color, amplicon, threshold, CASE WHEN count(raw_mod) FILTER (raw_tot >= threshold) > 0 THEN sum(CAST(round(raw_mod*100) AS BIGINT)) FILTER (raw_tot >= threshold) / count(raw_mod) FILTER (raw_tot >= threshold) / 100 END AS mean_mod FROM scored JOIN quality USING (cell), {_T} GROUP BY ALL", "quality"))
def mean_mod_by_depth(t):
    return qc.mean_mod_by_depth(summary.scored_rows(dense(t), QUALITY), quality(t))


@query("amplicon_order", oracle("SELECT amplicon, m AS mean_reads, row_number() OVER (ORDER BY m DESC, amplicon) AS place FROM (SELECT amplicon, sum(raw_tot)/count(*) AS m FROM scored GROUP BY amplicon) q", "scored"))
def amplicon_order(t):
    return qc.amplicon_order(summary.scored_rows(dense(t), QUALITY)).withColumn("place", F.col("place").cast("long"))


@query("read_depth_rank", oracle("SELECT cell, read_count, row_number() OVER (ORDER BY read_count DESC, cell) AS barcode_rank, color FROM (SELECT cell, CAST(sum(raw_tot) AS BIGINT) AS read_count FROM dense GROUP BY cell) q JOIN (SELECT cell, color FROM quality) c USING (cell)", "quality"))
def read_depth_rank(t):
    return summary.barcode_rank(summary.cell_total_reads(dense(t))).join(quality(t).select("cell", "color"), "cell").select("cell", "read_count", "barcode_rank", "color")


# Export


@query("filtered_allele_counts", oracle("SELECT cell, amplicon, allele_sequence, n FROM alleles", "alleles"))
def filtered_allele_counts(t):
    return filtered(t)


@query("restrict_known_pairs", oracle("SELECT cell, amplicon, allele_sequence, n FROM alleles WHERE cell IN (SELECT cell FROM dense) AND amplicon IN (SELECT amplicon FROM dense WHERE amplicon <> 'AMP_05')", "alleles", "dense"))
def restrict_known_pairs(t):
    """On a summary without one amplicon."""
    return export.restrict_known(filtered(t), dense(t).where("amplicon <> 'AMP_05'")).select("cell", "amplicon", "allele_sequence", "n")


@query("allele_frequency", oracle("SELECT cell, amplicon, allele_sequence, CAST(n AS BIGINT) AS n, freq FROM freqs", "freqs"))
def allele_frequency(t):
    return export.allele_frequency(filtered(t))


@query("top2_alleles", oracle("SELECT * FROM top2", "top2"))
def top2_alleles(t):
    return export.top2_alleles(filtered(t))


@query("zygosity", oracle("SELECT cell, amplicon, zygosity FROM zyg", "zyg"))
def zygosity(t):
    return export.zygosity(dense(t), export.top2_alleles(filtered(t)))


@query("layer_table", oracle("SELECT * FROM layers", "layers"))
def layer_table(t):
    return export.layer_table(dense(t), export.top2_alleles(filtered(t)))


@query("obs_table", oracle("SELECT cell, coalesce(amplicon_score, 0) AS amplicon_score, coalesce(read_count, 0) AS read_count, coalesce(barcode_rank, -1) AS barcode_rank, coalesce(color, 'Unknown') AS color FROM (SELECT DISTINCT cell FROM dense) d LEFT JOIN (SELECT * FROM quality WHERE read_count >= 150) q USING (cell)", "quality"))
def obs_table(t):
    from dataclasses import replace

    return export.obs_table(dense(t), summary.cell_quality(dense(t), replace(QUALITY, min_total_reads=150)))


@query("obs_table_low_gate", oracle("SELECT cell, coalesce(amplicon_score, 0) AS amplicon_score, coalesce(read_count, 0) AS read_count, coalesce(barcode_rank, -1) AS barcode_rank, coalesce(color, 'Unknown') AS color FROM (SELECT DISTINCT cell FROM dense) d LEFT JOIN (SELECT * FROM quality WHERE read_count >= 35) q USING (cell)", "quality"))
def obs_table_low_gate(t):
    from dataclasses import replace

    return export.obs_table(dense(t), summary.cell_quality(dense(t), replace(QUALITY, min_total_reads=35)))


@query("var_metadata", oracle("SELECT amplicon, chr, start_pos, end_pos FROM (SELECT DISTINCT amplicon FROM dense) d LEFT JOIN amplicons USING (amplicon)", "dense"))
def var_metadata(t):
    return export.var_metadata(dense(t), t.table("amplicons")).select("amplicon", "chr", "start_pos", "end_pos")


@query("var_statistics", oracle("SELECT * FROM var_stats", "var_stats"))
def var_statistics(t):
    return export.var_statistics(dense(t))


@query("ordered_outputs", oracle("SELECT cell, amplicon, tot, mod FROM dense ORDER BY cell, amplicon", "dense"))
def ordered_outputs(t):
    return dense(t).select("cell", "amplicon", "tot", "mod").orderBy("cell", "amplicon")


@query("cell_editing_summary", oracle("SELECT d.cell, amplicon, raw_tot, tot, mod, amplicon_score, barcode_rank, color FROM dense d JOIN quality q ON d.cell = q.cell", "quality"))
def cell_editing_summary(t):
    """The flagship result: the summary of every scored cell at every amplicon with score, rank and class."""
    return dense(t).join(quality(t), "cell").select("cell", "amplicon", "raw_tot", "tot", "mod", "amplicon_score", "barcode_rank", "color")
