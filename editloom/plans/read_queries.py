"""Queries on read pairs, lookups and assignment (derived tables read_pairs, aligned_pairs, alignments)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as sq
from ..operators import assign, demux, lookups
from ..params import DemuxParams
from .fixtures import Fixtures
from .oracle import oracle, rc
from .registry import query

D = DemuxParams()
CALL_COLUMNS = "qname, cell, amp1, amp2, amp1_aln, amp2_aln"


def located(t: Fixtures):
    return demux.locate(t.table("read_pairs"))


def flagged(t: Fixtures):
    pairs, barcodes = t.table("read_pairs"), t.table("barcodes")
    return demux.flag_pairs(pairs, barcodes, lookup=t.stage("barcode_lookup", lambda: demux.lookup_of_pairs(pairs, barcodes)))


def depth(t: Fixtures):
    return t.table("aligned_pairs").groupBy("cell").agg(F.count("*").alias("reads"))


def calls(t: Fixtures):
    return assign.calls(t.table("aligned_pairs"), t.amplicons())


def strict(t: Fixtures):
    return assign.assign_strict(calls(t))


@query("locate_constants", oracle("SELECT name, c1, c2 FROM located WHERE c1 >= 0 AND c2 >= 0", "located"))
def locate_constants(t):
    return located(t).where("c1 >= 0 AND c2 >= 0").select("name", "c1", "c2")


@query("extract_barcode_halves", oracle("SELECT name, part1, part2 FROM located WHERE c1 >= 0", "located"))
def extract_barcode_halves(t):
    return located(t).where("c1 >= 0").select("name", "part1", "part2")


@query("filter_min_length", oracle("SELECT name, CAST(length(rest1) AS INT) AS rest_length FROM flagged WHERE long_enough", "flagged"))
def filter_min_length(t):
    return flagged(t).where("long_enough").select("name", "rest_length")


@query("filter_adapter", oracle("SELECT name FROM flagged WHERE clean", "flagged"))
def filter_adapter(t):
    return flagged(t).where("clean").select("name")


@query("tag_reads", oracle("SELECT split_part(name, ' ', 1) AS read_id, cell, rest1 AS seq1, rest_qual1 AS qual1, seq2, qual2 FROM flagged WHERE clean", "flagged"))
def tag_reads(t):
    return demux.tag_reads(flagged(t))


@query("correct_barcodes", oracle("SELECT name, cell, corrected FROM flagged WHERE valid", "flagged"))
def correct_barcodes(t):
    return flagged(t).where("valid").select("name", "cell", "corrected")


@query("parse_funnel", oracle("""SELECT count(*) AS total, count(*) FILTER (has_c1) AS constant1, count(*) FILTER (has_c2) AS constant2, count(*) FILTER (valid) AS valid_barcode,
    count(*) FILTER (valid AND corrected) AS error_corrected, count(*) FILTER (long_enough) AS long_enough, count(*) FILTER (clean) AS no_adapter FROM flagged""", "flagged"))
def parse_funnel(t):
    return demux.parse_funnel(flagged(t))


@query("parse_funnel_pct", oracle("""SELECT CASE WHEN t > 0 THEN CAST((20000*l+t)//(2*t) AS DOUBLE)/100 ELSE 0 END AS long_pct, CASE WHEN l > 0 THEN CAST((20000*n+l)//(2*l) AS DOUBLE)/100 ELSE 0 END AS no_adapter_pct, cells
    FROM (SELECT count(*) AS t, count(*) FILTER (long_enough) AS l, count(*) FILTER (clean) AS n, count(DISTINCT cell) FILTER (clean) AS cells FROM flagged) q""", "flagged"))
def parse_funnel_pct(t):
    return demux.parse_funnel_pct(flagged(t))


_METRICS = " UNION ALL ".join(f"SELECT '{name}' AS metric, CAST(NULL AS VARCHAR) AS cell, count(*) FILTER ({c}) AS n FROM flagged" for name, c in (
    ("total", "true"), ("constant1", "has_c1"), ("constant2", "has_c2"), ("valid_barcode", "valid"), ("error_corrected", "valid AND corrected"), ("long_enough", "long_enough"), ("no_adapter", "clean")))


@query("merge_metrics", oracle(f"{_METRICS} UNION ALL SELECT 'reads_per_cell', cell, count(*) FROM flagged WHERE clean GROUP BY cell", "flagged"))
def merge_metrics(t):
    """Two lanes, by the parity of the name's last digit: their counters and their reads of each cell are counted apart and added up."""
    lane = F.instr(F.lit("13579bdf"), F.substring("name", -1, 1)) > 0
    return demux.merge_metrics(demux.lane_metrics(flagged(t).withColumn("lane", lane), "lane"))


@query("reads_per_cell", oracle("SELECT cell, count(*) AS reads FROM flagged WHERE clean GROUP BY cell", "flagged"))
def reads_per_cell(t):
    return demux.reads_per_cell(demux.tag_reads(flagged(t)))


@query("union_lanes", oracle("SELECT name, length(seq1) AS n1, length(seq2) AS n2 FROM read_pairs", "read_pairs"))
def union_lanes(t):
    rows = t.table("read_pairs")
    odd = F.instr(F.lit("13579bdf"), F.substring("name", -1, 1)) > 0
    return rows.where(odd).unionByName(rows.where(~odd)).select("name", F.length("seq1").cast("long").alias("n1"), F.length("seq2").cast("long").alias("n2"))


@query("mate_mismatch", oracle("SELECT count(*) AS pairs, count(*) FILTER (length(seq1) <> length(qual1) OR length(seq2) <> length(qual2)) AS bad FROM read_pairs", "read_pairs"))
def assert_inputs(t):
    """Data checks of the inputs: every sequence has as many qualities."""
    bad = (F.length("seq1") != F.length("qual1")) | (F.length("seq2") != F.length("qual2"))
    return t.table("read_pairs").agg(F.count("*").alias("pairs"), F.count_if(bad).alias("bad"))


# Lookups


@query("substitution_neighbours", oracle("SELECT ord, key, value FROM b_entries WHERE kind = 'V'", "b_entries"))
def substitution_neighbours(t):
    return lookups.barcode_entries(t.table("barcodes")).where("kind = 'V'").select("ord", "key", "value")


@query("shift_neighbours", oracle("SELECT CAST(ord AS BIGINT) AS ord, key, value FROM p_entries WHERE kind = 'V' AND ord % 10000 >= 9000", "p_entries"))
def shift_neighbours(t):
    return lookups.primer_entries(t.amplicons(), substitutions=False).where("kind = 'V'").select("ord", "key", "value")


@query("primer_ends", oracle("SELECT amplicon, CAST(end_no AS INT) AS end_no, primer FROM ends", "ends"))
def primer_ends(t):
    return lookups.primer_ends(t.amplicons(), 18).select("amplicon", "end_no", "primer")


@query("barcode_lookup", oracle("SELECT key, value FROM b_lookup", "b_lookup"))
def barcode_lookup(t):
    return lookups.barcode_lookup(t.table("barcodes"))


@query("primer_lookup", oracle("SELECT key, value FROM p_lookup", "p_lookup"))
def primer_lookup(t):
    return lookups.primer_lookup(t.amplicons())


def _counts_sql(name: str) -> str:
    return oracle(f"""SELECT count(*) FILTER (kind = 'E') AS exact_entries, count(*) FILTER (kind = 'V' AND nth = 1) AS variants_added,
      CAST(sum(CASE WHEN kind = 'V' AND ord = conflict THEN 2 WHEN kind = 'V' AND ord > conflict THEN 1 ELSE 0 END) AS BIGINT) AS clashes, (SELECT count(*) FROM {name}_lookup) AS keys FROM {name}_entries_c""", f"{name}_lookup")


@query("lookup_counts", _counts_sql("b"))
def lookup_counts(t):
    return lookups.lookup_counts(lookups.barcode_entries(t.table("barcodes")))


@query("primer_lookup_counts", _counts_sql("p"))
def primer_lookup_counts(t):
    return lookups.lookup_counts(lookups.primer_entries(t.amplicons()))


@query("position_windows", oracle("SELECT CAST(side AS INT) AS side, chr, CAST(pos AS INT) AS pos, amplicon FROM windows", "windows"))
def position_windows(t):
    return lookups.position_windows(t.amplicons())


@query("duplicate_locations", oracle("""SELECT DISTINCT b.amplicon, a.amplicon AS earlier FROM (SELECT *, CAST(100*(ordinal // 3) AS INT) AS s FROM amplicons) a JOIN (SELECT *, CAST(100*(ordinal // 3) AS INT) AS s FROM amplicons) b
    ON a.ordinal < b.ordinal AND (b.s BETWEEN a.s-3 AND a.s+3 OR b.s+63 BETWEEN a.s+64-3 AND a.s+64+3)""", "amplicons"))
def duplicate_locations(t):
    """On amplicons of which three each lie at the same place."""
    moved = t.amplicons().withColumn("start", (F.floor(F.col("ordinal") / 3) * 100).cast("int")).withColumn("end", F.col("start") + 64)
    return lookups.duplicate_locations(moved)


@query("amplicon_locations", oracle("""SELECT amplicon, chr AS aln_chr, start_pos AS aln_start, end_pos AS aln_end, CAST(42 AS INT) AS aln_mapq, CASE WHEN o THEN 'chr2' END AS secondary_chr, CASE WHEN o THEN start_pos + 7 END AS secondary_start,
    CASE WHEN o THEN start_pos + 7 + 64 END AS secondary_end, CASE WHEN o THEN CAST(3 AS INT) END AS secondary_mapq, CAST(CASE WHEN o THEN 2 ELSE 1 END AS BIGINT) AS aln_count FROM (SELECT *, ordinal % 3 = 0 AS o FROM amplicons) q""", "amplicons"))
def amplicon_locations(t):
    return lookups.amplicon_locations(t.table("amplicon_alignments"))


def alternates(t: Fixtures):
    return t.table("alternates").select("amplicon", F.split("alt_list", ",").alias("alt_seqs"))


@query("override_alt_alleles", oracle("SELECT amplicon, coalesce(alt_list, sequence) AS amp_seqs FROM amplicons LEFT JOIN alternates USING (amplicon)", "amplicons", "alternates"))
def override_alt_alleles(t):
    amplicons = t.amplicons().select("amplicon", F.array("sequence").alias("amp_seqs"))
    return lookups.override_alt_alleles(amplicons, alternates(t)).select("amplicon", F.array_join("amp_seqs", ",").alias("amp_seqs"))


@query("repeated_alternates", oracle("SELECT sequence, count(*) AS amplicons FROM (SELECT DISTINCT amplicon, unnest(string_split(alt_list, ',')) AS sequence FROM alternates) q GROUP BY sequence HAVING count(*) > 1", "alternates"))
def repeated_alternates(t):
    return lookups.repeated_alternates(alternates(t))


@query("assert_no_adapter_in_amplicon", oracle(f"SELECT amplicon FROM (SELECT amplicon, CASE WHEN ordinal % 4 = 0 THEN sequence || '{D.adapter}' WHEN ordinal % 4 = 1 THEN {rc(f"'{D.adapter}'")} || sequence ELSE sequence END AS s FROM amplicons) q WHERE contains(s, '{D.adapter}') OR contains(s, {rc(f"'{D.adapter}'")})", "amplicons"))
def assert_no_adapter_in_amplicon(t):
    """On amplicons of which every fourth is spoiled by the adapter and every next one by its reverse complement."""
    o = F.col("ordinal") % 4
    spoiled = F.when(o == 0, F.concat("sequence", F.lit(D.adapter))).when(o == 1, F.concat(sq.reverse_complement(F.lit(D.adapter)), "sequence")).otherwise(F.col("sequence"))
    return lookups.adapter_in_amplicons(t.amplicons().withColumn("sequence", spoiled), D.adapter).select("amplicon")


# Alignments and assignment


@query("decode_flags", oracle("SELECT qname, flag, (flag & 4) <> 0 AS unmapped, (flag & 16) <> 0 AS reverse, (flag & 256) <> 0 AS secondary FROM alignments", "alignments"))
def decode_flags(t):
    return assign.decode_flags(t.table("alignments")).select("qname", "flag", "unmapped", "reverse", "secondary")


_PAIRED = "SELECT qname, max(flag) FILTER ((flag & 128) = 0) AS flag1, max(flag) FILTER ((flag & 128) <> 0) AS flag2, max(pos) FILTER ((flag & 128) = 0) AS pos1, max(pos) FILTER ((flag & 128) <> 0) AS pos2 FROM alignments GROUP BY qname"


@query("pair_mates", oracle(_PAIRED, "alignments"))
def pair_mates(t):
    return assign.pair_mates(t.table("alignments"), ["flag", "pos"])


@query("filter_secondary", oracle(f"SELECT qname FROM ({_PAIRED}) q WHERE (flag1 & 256) = 0 AND (flag2 & 256) = 0", "alignments"))
def filter_secondary(t):
    pairs = assign.pair_mates(t.table("alignments"), ["flag"])
    return pairs.where((F.col("flag1").bitwiseAND(0x100) == 0) & (F.col("flag2").bitwiseAND(0x100) == 0)).select("qname")


_END = "CAST(pos - 1 + coalesce(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1), lambda x: CAST(x AS INT))), 0) AS INT)"


@query("orient_pairs", oracle(f"""SELECT qname, flag, CASE WHEN (flag & 16) <> 0 THEN substr(seq, length(seq)-17) ELSE substr(seq, 1, 18) END AS primer, CASE WHEN (flag & 16) <> 0 THEN {_END} ELSE pos END AS key_pos,
    CASE WHEN (flag & 16) <> 0 THEN {rc('seq')} ELSE seq END AS seq_out, CASE WHEN (flag & 16) <> 0 THEN reverse(qual) ELSE qual END AS qual_out FROM alignments""", "alignments"))
def orient_pairs(t):
    return assign.orient(t.table("alignments")).select("qname", "flag", "primer", "key_pos", "seq_out", "qual_out")


@query("alignment_end", oracle(f"SELECT qname, flag, {_END} AS aln_end FROM alignments", "alignments"))
def alignment_end(t):
    return t.table("alignments").select("qname", "flag", sq.alignment_end(F.col("pos"), F.col("cigar")).alias("aln_end"))


@query("reverse_complement", oracle(f"SELECT name, {rc('seq1')} AS rc, regexp_matches(upper(seq1), '[^ACGTN_-]') AS foreign_letters FROM read_pairs", "read_pairs"))
def reverse_complement(t):
    return t.table("read_pairs").select("name", sq.reverse_complement(F.col("seq1")).alias("rc"), sq.has_foreign_letters(F.col("seq1")).alias("foreign_letters"))


@query("sanitize_name", oracle("SELECT raw, trim(regexp_replace(regexp_replace(raw, '[^A-Za-z0-9._-]', '_', 'g'), '_+', '_', 'g'), '_') AS clean FROM (SELECT DISTINCT ' ' || p_type || ':/' || p_brand || '!!' AS raw FROM part) q"))
def sanitize_name(t):
    names = t.spark.read.parquet(f"{t.dir}/part.parquet").select(F.concat(F.lit(" "), "p_type", F.lit(":/"), "p_brand", F.lit("!!")).alias("raw")).distinct()
    return names.select("raw", sq.sanitize_name(F.col("raw")).alias("clean"))


@query("name_fields", oracle("SELECT n AS name, split_part(n, ' ', 1) AS first_token, string_split(n, ':')[-1] AS last_field, string_split(n, ':')[-2] AS second_last_field FROM (SELECT name || ' x:' || substr(name, 2, 3) || ':' || substr(name, 5, 2) AS n FROM read_pairs) q", "read_pairs"))
def name_fields(t):
    n = F.concat("name", F.lit(" x:"), F.substring("name", 2, 3), F.lit(":"), F.substring("name", 5, 2))
    return t.table("read_pairs").select(n.alias("name")).select("name", sq.first_token(F.col("name")).alias("first_token"), sq.last_field(F.col("name")).alias("last_field"), sq.second_last_field(F.col("name")).alias("second_last_field"))


@query("filter_low_depth_cells", oracle("SELECT qname, cell FROM aligned_pairs WHERE cell IN (SELECT cell FROM depth WHERE reads >= 10)", "depth"))
def filter_low_depth_cells(t):
    return assign.filter_low_depth(t.table("aligned_pairs"), depth(t)).select("qname", "cell")


@query("attach_cell_depth", oracle("SELECT qname, cell, reads FROM aligned_pairs JOIN depth USING (cell)", "depth"))
def attach_cell_depth(t):
    return assign.attach_depth(t.table("aligned_pairs"), depth(t)).select("qname", "cell", "reads")


@query("cell_depth_census", oracle("SELECT count(*) FILTER (reads < 10) AS failing_cells, count(*) FILTER (reads >= 10) AS passing_cells FROM depth", "depth"))
def cell_depth_census(t):
    return assign.depth_census(depth(t))


@query("mapped_pairs_flag", oracle("SELECT qname, chr1 <> '*' AND chr2 <> '*' AS mapped FROM aligned_pairs", "aligned_pairs"))
def mapped_pairs_flag(t):
    return t.table("aligned_pairs").select("qname", assign.mapped_pair().alias("mapped"))


@query("primer_calls", oracle("SELECT qname, amp1, amp2 FROM calls", "calls"))
def primer_calls(t):
    pairs = t.table("aligned_pairs")
    return assign.primer_calls(pairs, lookups.primer_lookup_of(assign.primers_seen(pairs), t.amplicons())).select("qname", "amp1", "amp2")


@query("position_calls", oracle("SELECT qname, amp1_aln, amp2_aln FROM calls", "calls"))
def position_calls(t):
    pairs = t.table("aligned_pairs")
    return assign.position_calls(pairs, lookups.position_windows(t.amplicons(), places=assign.places_seen(pairs))).select("qname", "amp1_aln", "amp2_aln")


@query("assign_strict", oracle("SELECT qname, cell, amplicon, rescued FROM strict", "strict"))
def assign_strict(t):
    return strict(t).select("qname", "cell", "amplicon", "rescued")


_ALL = "SELECT DISTINCT qname, cell, amplicon FROM (SELECT qname, cell, unnest([amp1, amp2, amp1_aln, amp2_aln]) AS amplicon FROM calls) q WHERE amplicon IS NOT NULL"


@query("assign_permissive", oracle(_ALL, "calls"))
def assign_permissive(t):
    return assign.assign_permissive(calls(t)).select("qname", "cell", "amplicon")


@query("candidate_set", oracle("SELECT qname, coalesce(string_agg(DISTINCT amplicon, ',' ORDER BY amplicon), '') AS candidates FROM (SELECT qname, unnest([amp1, amp2, amp1_aln, amp2_aln]) AS amplicon FROM calls) q GROUP BY qname", "calls"))
def candidate_set(t):
    return calls(t).select("qname", F.array_join(F.array_sort(assign.candidate_set()), ",").alias("candidates"))


@query("reject_reason_strict", oracle("SELECT qname, reason FROM strict WHERE amplicon IS NULL", "strict"))
def reject_reason_strict(t):
    return strict(t).where("amplicon IS NULL").select("qname", assign.reject_reason_strict().alias("reason"))


@query("reject_reason_permissive", oracle("SELECT qname, CASE WHEN amp1 IS NULL OR amp2 IS NULL THEN 'unidentified' WHEN amp1 = amp2 THEN NULL WHEN amp1_aln <> amp1 OR amp2_aln <> amp2 THEN 'other location' ELSE 'chimeric' END AS reason FROM calls", "calls"))
def reject_reason_permissive(t):
    return calls(t).select("qname", assign.reject_reason_permissive().alias("reason"))


@query("reads_per_amplicon", oracle("SELECT a.amplicon, count(s.qname) AS reads FROM amplicons a LEFT JOIN strict s ON a.amplicon = s.amplicon GROUP BY a.amplicon", "strict"))
def reads_per_amplicon(t):
    return assign.reads_per_amplicon(strict(t).where("amplicon IS NOT NULL"), t.amplicons())


@query("pairs_per_cell_status", oracle("SELECT cell, count(*) FILTER (chr1 <> '*' AND chr2 <> '*') AS aligned, count(*) FILTER (chr1 = '*' OR chr2 = '*') AS unaligned FROM aligned_pairs GROUP BY cell", "aligned_pairs"))
def pairs_per_cell_status(t):
    return assign.pairs_per_cell_status(t.table("aligned_pairs"))


@query("call_combination_counts", oracle("SELECT amplicon IS NOT NULL AS valid, amp1, amp2, amp1_aln, amp2_aln, count(*) AS pair_count FROM strict GROUP BY ALL", "strict"))
def call_combination_counts(t):
    return assign.call_combinations(strict(t))


@query("split_totals", oracle("""SELECT count(*) AS total, count(*) FILTER (chr1 <> '*' AND chr2 <> '*') AS aligned, count(amplicon) AS identified, count(*) FILTER (rescued) AS rescued, count(*) FILTER (amplicon IS NULL AND reason = 'chimeric') AS chimeric,
    count(*) FILTER (amplicon IS NULL AND reason = 'other location') AS other_location, count(*) FILTER (amplicon IS NULL AND reason = 'unidentified') AS unidentified FROM strict""", "strict"))
def split_totals(t):
    return assign.split_totals(strict(t))
