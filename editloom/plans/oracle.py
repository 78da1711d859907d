"""DuckDB SQL for the derived steps, as common table expressions that oracle queries are put together from."""

from __future__ import annotations

from ..params import AssignParams, CallParams, DemuxParams, QualityParams
from .fixtures import TABLES, duckdb_ctes

D, A, C = DemuxParams(), AssignParams(), CallParams()
#: The queries' parameters: a depth cutoff that the number of cells exceeds.
QUALITY = QualityParams(depth_cutoff=100, min_reads_per_amplicon=0, selected=("HQ_HI", "HQ_LO"))
_BASES = "(VALUES (0,'A'),(1,'C'),(2,'T'),(3,'G'),(4,'N')) n(j,b)"
_RC = "translate(reverse(upper({0})),'ACGT','TGCA')"


def rc(x: str) -> str:
    return _RC.format(x)


def _entries(table: str, base: str, key: str, value: str, length: int, shifts: bool) -> str:
    out = f"""SELECT {base} AS ord, {key} AS key, {value} AS value, 'E' AS kind FROM {table}
      UNION ALL SELECT {base} + 1 + (p-1)*5 + j, substr({key},1,p-1) || b || substr({key},p+1), {value}, 'V' FROM {table}, range(1,{length + 1}) r(p), {_BASES} WHERE substr({key},p,1) <> b"""
    if shifts:
        out += f"""
      UNION ALL SELECT {base} + 9000 + j, b || substr({key},1,{length - 1}), {value}, 'V' FROM {table}, {_BASES}
      UNION ALL SELECT {base} + 9005 + j, substr({key},2) || b, {value}, 'V' FROM {table}, {_BASES}"""
    return out


def _resolved(entries: str) -> tuple[str, str]:
    return (f"""SELECT *, min(CASE WHEN kind = 'V' AND nth > 1 THEN ord END) OVER (PARTITION BY key) AS conflict
      FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord) AS nth FROM {entries}) q""",
            f"SELECT key, arg_max(value, ord) AS value FROM {entries}_c WHERE conflict IS NULL OR (kind = 'E' AND ord > conflict) GROUP BY key")


_PCT = "floor((20000*({0})+({1}))/(2.0*({1})))/100"


def pct(part: str, whole: str) -> str:
    return f"CASE WHEN ({whole}) > 0 THEN CAST(floor(CAST(20000*CAST({part} AS BIGINT)+({whole}) AS BIGINT) // (2*({whole}))) AS DOUBLE)/100 END"


#: Order of an amplicon's references.
PLACE = "CASE ref WHEN 'Reference' THEN 0 ELSE 1 END"
_be, _bl = _resolved("b_entries")
_pe, _pl = _resolved("p_entries")
_UN = "'DEL= INS= SUB='"
_TYPES = "concat(CASE WHEN edits LIKE 'DEL= %' THEN '' ELSE 'D' END, CASE WHEN edits LIKE '%INS= %' THEN '' ELSE 'I' END, CASE WHEN edits LIKE '%SUB=' THEN '' ELSE 'S' END)"
_LN_REAL, _LN_NOISE = f"ln({(1 - C.noise) / 2!r})", f"ln({C.noise!r})"


def _score(a: str, b: str, r: str) -> str:
    return f"(({a})+({b}))*{_LN_REAL} + ({r})*{_LN_NOISE} - lgamma(({a})+1.0) - lgamma(({b})+1.0) - lgamma(({r})+1.0)"


STEPS: dict[str, tuple[list[str], str]] = {
    "b_entries": (["barcodes"], _entries("barcodes", "ordinal*10000", "barcode", "barcode", 9, False)),
    "b_entries_c": (["b_entries"], _be), "b_lookup": (["b_entries_c"], _bl),
    "ends": (["amplicons"], f"""SELECT ordinal, amplicon, end_no, CASE end_no WHEN 0 THEN f WHEN 1 THEN {rc('f')} WHEN 2 THEN l ELSE {rc('l')} END AS primer
      FROM (SELECT *, substr(sequence,1,18) AS f, substr(sequence,length(sequence)-17) AS l FROM amplicons) q, range(4) r(end_no)"""),
    "p_entries": (["ends"], _entries("ends", "(ordinal*4+end_no)*10000", "primer", "amplicon", 18, True)),
    "p_entries_c": (["p_entries"], _pe), "p_lookup": (["p_entries_c"], _pl),
    "located": (["read_pairs"], f"""SELECT *, CAST(instr(seq1,'{D.constant1}')-1 AS INT) AS c1, CAST(instr(seq1,'{D.constant2}')-1 AS INT) AS c2, substr(seq1,1,9) AS part1,
      substr(seq1,instr(seq1,'{D.constant1}')-1+{len(D.constant1)}+1,9) AS part2 FROM read_pairs"""),
    "flagged": (["located", "b_lookup"], f"""SELECT *, valid AND length(rest1) >= 20 AND length(cell) >= 18 AS long_enough,
        valid AND length(rest1) >= 20 AND length(cell) >= 18 AND NOT (contains(seq1,'{D.adapter}') OR contains(seq2,'{D.adapter}') OR contains(seq1,{rc(f"'{D.adapter}'")}) OR contains(seq2,{rc(f"'{D.adapter}'")})) AS clean
      FROM (SELECT l.*, a.value || b.value AS cell, a.value || b.value <> part1 || part2 AS corrected, substr(seq1,c2+{len(D.constant2)}+1) AS rest1, substr(qual1,c2+{len(D.constant2)}+1) AS rest_qual1,
        c1 >= 0 AS has_c1, c1 >= 0 AND c2 >= 0 AS has_c2, c1 >= 0 AND c2 >= 0 AND a.value IS NOT NULL AND b.value IS NOT NULL AS valid
        FROM located l LEFT JOIN b_lookup a ON part1 = a.key LEFT JOIN b_lookup b ON part2 = b.key) q"""),
    "windows": (["amplicons"], """SELECT side, chr, pos, arg_max(amplicon, ordinal) AS amplicon FROM (SELECT ordinal, amplicon, chr, side, CASE side WHEN 1 THEN start_pos ELSE end_pos END + d AS pos
      FROM amplicons, range(1,3) s(side), range(-3,4) r(d)) q GROUP BY side, chr, pos"""),
    "depth": (["aligned_pairs"], "SELECT cell, count(*) AS reads FROM aligned_pairs GROUP BY cell"),
    "calls": (["aligned_pairs", "p_lookup", "windows"], """SELECT p.*, a.value AS amp1, b.value AS amp2, s.amplicon AS amp1_aln, e.amplicon AS amp2_aln FROM aligned_pairs p
      LEFT JOIN p_lookup a ON primer1 = a.key LEFT JOIN p_lookup b ON primer2 = b.key
      LEFT JOIN windows s ON s.side = 1 AND s.chr = chr1 AND s.pos = pos1 LEFT JOIN windows e ON e.side = 2 AND e.chr = chr2 AND e.pos = pos2"""),
    "strict": (["calls"], """SELECT *, CASE WHEN amplicon IS NOT NULL AND (amp1_aln IS NULL OR amp2_aln IS NULL) THEN true ELSE false END AS rescued,
        CASE WHEN amp1 IS NULL OR amp2 IS NULL THEN 'unidentified' WHEN amp1 <> amp2 THEN 'chimeric' WHEN amp1_aln <> amp1 OR amp2_aln <> amp2 THEN 'other location' ELSE 'unidentified' END AS reason
      FROM (SELECT *, CASE WHEN amp1 = amp2 AND coalesce(amp1_aln,amp2_aln) = amp1 AND coalesce(amp2_aln,amp1_aln) = amp1 THEN amp1 END AS amplicon FROM calls) q"""),
    "usable": (["annotated_reads"], "SELECT * FROM annotated_reads WHERE aln_ref <> 'NA' AND NOT contains(aln_ref,'&') AND trim(cell) <> ''"),
    "mods": (["usable"], f"SELECT amplicon, cell, count(*) FILTER (ann <> '' AND ann <> {_UN}) AS mod, count(*) FILTER (ann = {_UN}) AS unmod FROM usable GROUP BY amplicon, cell"),
    "raw": (["mods"], f"SELECT amplicon, cell, mod + unmod AS raw_reads, {pct('mod', 'mod + unmod')} AS raw_mod_pct FROM mods"),
    "counts": (["usable"], "SELECT amplicon, cell, aln_ref AS ref, aln_ref || ':' || ann AS allele_key, count(*) AS n FROM usable GROUP BY amplicon, cell, aln_ref, ann"),
    "ranked": (["counts"], "SELECT *, row_number() OVER (PARTITION BY amplicon, cell, ref ORDER BY n DESC, allele_key) AS rnk FROM counts"),
    "top": (["ranked"], """SELECT amplicon, cell, ref, max(n) FILTER (rnk = 1) AS a, coalesce(max(n) FILTER (rnk = 2), 0) AS b, sum(n) AS t,
      max(allele_key) FILTER (rnk = 1) AS ka, max(allele_key) FILTER (rnk = 2) AS kb FROM ranked GROUP BY amplicon, cell, ref"""),
    "called": (["top", "ploidies"], f"""SELECT amplicon, cell, ref, CAST(slot AS INT) AS slot, CASE WHEN het AND slot = 2 THEN kb ELSE ka END AS allele_key,
        CAST(CASE WHEN k = 1 THEN a WHEN het THEN CASE slot WHEN 1 THEN a ELSE b END ELSE CASE slot WHEN 1 THEN a - a//2 ELSE a//2 END END AS BIGINT) AS n
      FROM (SELECT *, k = 2 AND b > 0 AND {_score('a', 'b', 't-a-b')} > {_score('a-a//2', 'a//2', 't-a')} + 1e-9 AS het
        FROM (SELECT top.*, coalesce(ploidy, 1) AS k FROM top LEFT JOIN ploidies USING (amplicon, ref)) o) q, range(1,3) r(slot) WHERE slot <= k"""),
    "typed": (["called"], f"""SELECT *, CASE WHEN edits = {_UN} THEN 'U' ELSE 'M' END AS flag, CASE WHEN {_TYPES} = '' THEN 'U' ELSE {_TYPES} END AS types
      FROM (SELECT *, split_part(allele_key, ':', 2) AS edits FROM called) q"""),
    "final": (["typed"], f"SELECT amplicon, cell, CAST(sum(n) AS BIGINT) AS final_reads, {pct("count(*) FILTER (flag = 'M')", 'count(*)')} AS final_mut_pct FROM typed GROUP BY amplicon, cell"),
    "strings": (["typed"], f"""SELECT amplicon, cell, string_agg(allele_key, ',' ORDER BY {PLACE}, ref, slot) AS final_alleles, string_agg(flag, ',' ORDER BY {PLACE}, ref, slot) AS final_flags,
      string_agg(types, ',' ORDER BY {PLACE}, ref, slot) AS final_types, string_agg(CAST(n AS VARCHAR), ',' ORDER BY {PLACE}, ref, slot) AS final_counts FROM typed GROUP BY amplicon, cell"""),
    "allele_strings": (["counts"], "SELECT amplicon, cell, string_agg(allele_key || ':' || CAST(n AS VARCHAR), ',' ORDER BY n DESC, allele_key) AS allele_string FROM counts GROUP BY amplicon, cell"),
    "seqs": (["usable"], "SELECT amplicon, cell, aln_ref || ':' || ann AS allele_key, seq, count(*) AS n FROM usable GROUP BY amplicon, cell, aln_ref, ann, seq"),
    "wild": (["allele_frequencies"], """SELECT amplicon, aligned_sequence AS wildtype FROM (SELECT *, row_number() OVER (PARTITION BY amplicon ORDER BY reads DESC, aligned_sequence) AS r
      FROM allele_frequencies WHERE read_status = 'UNMODIFIED' AND n_deleted = 0 AND n_inserted = 0 AND n_mutated = 0) q WHERE r = 1"""),
    "modal": (["seqs"], """SELECT amplicon, cell, allele_key, arg_min(seq, (-n, seq)) AS modal, max(n) AS top, count(*) FILTER (n = m) AS ties
      FROM (SELECT *, max(n) OVER (PARTITION BY amplicon, cell, allele_key) AS m FROM seqs) q GROUP BY amplicon, cell, allele_key"""),
    "consensus": (["called", "modal", "wild"], """SELECT c.amplicon, c.cell, ref, slot, c.allele_key, CASE WHEN ties > 1 AND top = 1 AND wildtype IS NOT NULL THEN wildtype ELSE modal END AS sequence,
      ties > 1 AND top = 1 AND wildtype IS NOT NULL AS adjusted FROM called c JOIN modal m ON c.amplicon = m.amplicon AND c.cell = m.cell AND c.allele_key = m.allele_key LEFT JOIN wild w ON c.amplicon = w.amplicon"""),
    "sums": (["raw", "final"], "SELECT amplicon, cell, raw_reads, raw_mod_pct, final_reads, final_mut_pct FROM raw JOIN final USING (amplicon, cell)"),
    "usable_amps": (["panel"], "SELECT amplicon FROM panel WHERE status = 'Completed'"),
    "dense": (["sums", "usable_amps"], """SELECT c.cell, s.amplicon, CAST(CASE WHEN u.amplicon IS NOT NULL THEN coalesce(raw_reads,0) END AS BIGINT) AS raw_tot, CASE WHEN u.amplicon IS NOT NULL THEN raw_mod_pct END AS raw_mod,
        CAST(CASE WHEN u.amplicon IS NOT NULL THEN coalesce(final_reads,0) END AS BIGINT) AS tot, CASE WHEN u.amplicon IS NOT NULL THEN final_mut_pct END AS mod
      FROM (SELECT DISTINCT cell FROM sums WHERE amplicon IN (SELECT amplicon FROM usable_amps)) c CROSS JOIN panel s LEFT JOIN usable_amps u ON s.amplicon = u.amplicon LEFT JOIN sums x ON x.cell = c.cell AND x.amplicon = s.amplicon"""),
    "mask": (["dense"], f"SELECT cell, min(raw_tot) >= {QUALITY.min_reads_per_amplicon} AS keep FROM dense WHERE raw_tot IS NOT NULL GROUP BY cell"),
    "scored": (["mask"], "SELECT * FROM dense WHERE raw_tot IS NOT NULL AND cell IN (SELECT cell FROM mask WHERE keep)"),
    "quant": (["scored"], "SELECT amplicon, " + ", ".join(f"quantile_cont(CAST(raw_tot AS DOUBLE), {q}) AS q{i}" for i, q in enumerate(QUALITY.tiers)) + " FROM scored GROUP BY amplicon"),
    "score": (["quant"], "SELECT cell, CAST(sum(" + " + ".join(f"CASE WHEN raw_tot >= q{i} THEN {w} ELSE 0 END" for i, w in enumerate(QUALITY.weights)) + ") AS DOUBLE) / count(*) AS amplicon_score, CAST(sum(raw_tot) AS BIGINT) AS read_count FROM scored JOIN quant USING (amplicon) GROUP BY cell"),
    "cell_ranks": (["score"], "SELECT *, row_number() OVER (ORDER BY read_count DESC, cell) AS barcode_rank FROM score"),
    "quality": (["cell_ranks"], f"""SELECT cell, amplicon_score, read_count, barcode_rank, CASE WHEN amplicon_score >= (SELECT quantile_cont(amplicon_score, 0.5) FROM cell_ranks WHERE barcode_rank <= {QUALITY.depth_cutoff}) THEN 'HQ' ELSE 'LQ' END
      || '_' || CASE WHEN barcode_rank <= {QUALITY.depth_cutoff} THEN 'HI' ELSE 'LO' END AS color FROM cell_ranks"""),
    "var_stats": (["dense"], """SELECT amplicon, CAST(coalesce(sum(tot),0) AS BIGINT) AS total_coverage, coalesce(sum(tot)/count(tot), 0) AS average_coverage,
      CASE WHEN count(mod) > 0 THEN sum(CAST(round(mod*100) AS BIGINT))/count(mod)/100 ELSE 0 END AS editing_efficiency FROM dense GROUP BY amplicon"""),
    "picked": (["quality"], "SELECT * FROM dense WHERE cell IN (SELECT cell FROM quality WHERE color IN ('HQ_HI','HQ_LO'))"),
    "depths": (["quality"], "SELECT cell, CASE WHEN color IN ('HQ_HI','HQ_LO') THEN 'High' ELSE 'Low' END AS quality_group, CAST(coalesce(sum(tot),0) AS BIGINT) AS reads FROM dense JOIN quality USING (cell) GROUP BY cell, color"),
    "patterns": (["picked"], "SELECT cell, coalesce(string_agg(amplicon, ',' ORDER BY amplicon) FILTER (mod <> 0), '') AS pattern FROM picked GROUP BY cell"),
    "coverage": (["picked"], "SELECT amplicon, coalesce(sum(tot),0) / count(*) AS mean_coverage FROM picked GROUP BY amplicon"),
    "alleles": (["annotated_reads"], "SELECT cell, amplicon, seq AS allele_sequence, count(*) AS n FROM annotated_reads WHERE aln_ref = 'Reference' GROUP BY cell, amplicon, seq"),
    "freqs": (["alleles"], "SELECT *, n * 100.0 / sum(n) OVER (PARTITION BY cell, amplicon) AS freq FROM (SELECT cell, amplicon, allele_sequence, CAST(n AS DOUBLE) AS n FROM alleles) q"),
    "top2": (["freqs"], """SELECT cell, amplicon, max(allele_sequence) FILTER (r = 1) AS allele_seq_1, max(freq) FILTER (r = 1) AS allele_freq_1, max(allele_sequence) FILTER (r = 2) AS allele_seq_2, max(freq) FILTER (r = 2) AS allele_freq_2
      FROM (SELECT *, row_number() OVER (PARTITION BY cell, amplicon ORDER BY n DESC, allele_sequence) AS r FROM freqs) q GROUP BY cell, amplicon"""),
    "zyg": (["dense", "top2"], """SELECT d.cell, d.amplicon, CAST(CASE WHEN coalesce(mod,0) <= 20 THEN 0 WHEN mod >= 80 AND coalesce(allele_freq_2,0) < 20 THEN 2 WHEN mod >= 80 THEN 3 ELSE 1 END AS INT) AS zygosity
      FROM dense d LEFT JOIN top2 t ON d.cell = t.cell AND d.amplicon = t.amplicon"""),
    "layers": (["zyg"], """SELECT d.cell, d.amplicon, CAST(coalesce(mod,0) AS FLOAT) AS mod_pct, CAST(coalesce(tot,0) AS INT) AS tot_count, CAST(zygosity AS TINYINT) AS zygosity,
        coalesce(allele_seq_1,'') AS allele_seq_1, CAST(coalesce(allele_freq_1,0) AS FLOAT) AS allele_freq_1, coalesce(allele_seq_2,'') AS allele_seq_2, CAST(coalesce(allele_freq_2,0) AS FLOAT) AS allele_freq_2
      FROM dense d JOIN zyg z ON d.cell = z.cell AND d.amplicon = z.amplicon LEFT JOIN top2 t ON d.cell = t.cell AND d.amplicon = t.amplicon"""),
}


def oracle(body: str, *names: str) -> str:
    """The body with the named steps and derived tables, and all that they need, before it."""
    found: list[str] = []

    def need(name: str) -> None:
        for n in STEPS[name][0] if name in STEPS else []:
            need(n)
        if name not in found:
            found.append(name)

    for n in names:
        need(n)
    raw = [n for n in found if n in TABLES]
    parts = ([duckdb_ctes(*raw)] if raw else []) + [f"{n} AS ({STEPS[n][1]})" for n in found if n in STEPS]
    return ("WITH " + ", ".join(parts) + " " if parts else "") + body
