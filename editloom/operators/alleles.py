"""Alleles of each cell at each amplicon, from reads annotated with their edits."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequence import mutation_type, pct_half_up
from ..params import CallParams

#: Likelihoods nearer than this count as equal.
NEAR = 1e-9
UNMODIFIED = "DEL= INS= SUB="
UNMODIFIED_WITHOUT_SUBSTITUTIONS = "DEL= INS="


def filter_unaligned(reads: DataFrame) -> DataFrame:
    return reads.where(F.col("aln_ref") != "NA")


def filter_ambiguous(reads: DataFrame) -> DataFrame:
    return reads.where(~F.col("aln_ref").contains("&"))


def filter_blank_cell(reads: DataFrame) -> DataFrame:
    return reads.where(F.trim("cell") != "")


def usable_reads(reads: DataFrame) -> DataFrame:
    return filter_blank_cell(filter_ambiguous(filter_unaligned(reads)))


def arm_flags(reads: DataFrame, amplicons: DataFrame, arm: int = 30) -> DataFrame:
    """Adds starts_known and ends_known: the read starts or ends as a known allele of its amplicon (amplicon, amp_seqs) does."""
    seq, known = F.col("seq"), F.col("amp_seqs")
    tail = lambda s: F.substring(s, F.greatest(F.lit(1), F.length(s) - arm + 1), F.lit(arm))
    joined = reads.join(amplicons.select("amplicon", "amp_seqs"), "amplicon")
    starts = F.array_contains(F.transform(known, lambda s: F.substring(s, F.lit(1), F.lit(arm))), F.substring(seq, F.lit(1), F.lit(arm)))
    return joined.withColumn("starts_known", starts).withColumn("ends_known", F.array_contains(F.transform(known, tail), tail(seq))).drop("amp_seqs")


def annotation_totals(reads: DataFrame) -> DataFrame:
    return reads.groupBy("amplicon").agg(F.count("*").alias("total_reads"), F.count_if(F.col("aln_ref") != "NA").alias("aligned_reads"))


def _status(params: CallParams) -> tuple[Column, str]:
    """The edits that count, and how those of an unmodified read look."""
    if params.ignore_substitutions:
        return F.regexp_extract("ann", "^(DEL=.* INS=.*) SUB=", 1), UNMODIFIED_WITHOUT_SUBSTITUTIONS
    return F.col("ann"), UNMODIFIED


def mod_unmod_counts(usable: DataFrame, params: CallParams = CallParams()) -> DataFrame:
    """Modified and unmodified reads of each (amplicon, cell); reads without annotation are neither."""
    edits, plain = _status(params)
    return usable.groupBy("amplicon", "cell").agg(F.count_if((edits != "") & (edits != plain)).alias("mod"), F.count_if(edits == plain).alias("unmod"))


def raw_summary(usable: DataFrame, params: CallParams = CallParams()) -> DataFrame:
    """(amplicon, cell, raw_reads, raw_mod_pct)."""
    counts = mod_unmod_counts(usable, params)
    whole = F.col("mod") + F.col("unmod")
    return counts.select("amplicon", "cell", whole.alias("raw_reads"), pct_half_up(F.col("mod"), whole).alias("raw_mod_pct"))


def allele_counts(usable: DataFrame, params: CallParams = CallParams()) -> DataFrame:
    """(amplicon, cell, ref, allele_key, n): allele_key is reference:edits."""
    edits, _ = _status(params)
    key = F.concat("aln_ref", F.lit(":"), F.when(edits == "", "NA").otherwise(edits))
    return usable.groupBy("amplicon", "cell", F.col("aln_ref").alias("ref"), key.alias("allele_key")).agg(F.count("*").alias("n"))


def allele_sequence_counts(usable: DataFrame) -> DataFrame:
    key = F.concat("aln_ref", F.lit(":"), F.when(F.col("ann") == "", "NA").otherwise(F.col("ann")))
    return usable.groupBy("amplicon", "cell", key.alias("allele_key"), "seq").agg(F.count("*").alias("n"))


def cell_read_counts(usable: DataFrame) -> DataFrame:
    return usable.groupBy("amplicon", "cell").agg(F.count("*").alias("reads"))


def references_seen(reads: DataFrame, expected: int = 1) -> DataFrame:
    """References of each amplicon's aligned, unambiguous reads. Amplicons without such reads have no row."""
    seen = filter_ambiguous(filter_unaligned(reads)).groupBy("amplicon").agg(F.count_distinct("aln_ref").alias("references"))
    return seen.withColumn("more_than_expected", F.col("references") > expected)


def rank_alleles(counts: DataFrame) -> DataFrame:
    """Adds rnk within (amplicon, cell, ref): count descending, then allele."""
    by = Window.partitionBy("amplicon", "cell", "ref").orderBy(F.desc("n"), "allele_key")
    return counts.withColumn("rnk", F.row_number().over(by))


def allele_string(counts: DataFrame) -> DataFrame:
    """All alleles of each (amplicon, cell) as `allele:count`, count descending, then allele."""
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "allele_key", "n")))
    return counts.groupBy("amplicon", "cell").agg(listed.alias("l")).select(
        "amplicon", "cell", F.array_join(F.transform("l", lambda x: F.concat(x["allele_key"], F.lit(":"), x["n"].cast("string"))), ",").alias("allele_string"))


#: ln(n!) of n below 256.
_LOG_FACTORIALS = tuple(itertools.accumulate((math.log(max(n, 1)) for n in range(256)), initial=0.0))[1:]


def log_factorial(n: Column) -> Column:
    """ln(n!): from a table, from 256 on Stirling's series, which is exact to double precision there. Numbers below 0 count as 0."""
    x = n.cast("double")
    series = x * F.log(x) - x + F.log(x * (2 * math.pi)) / 2 + 1 / (x * 12) - 1 / (F.pow(x, F.lit(3)) * 360)
    return F.when(n < 256, F.get(F.lit(list(_LOG_FACTORIALS)), F.greatest(n, F.lit(0)).cast("int"))).otherwise(series)


def reference_place(ref: Column) -> Column:
    """Order of an amplicon's references: `Reference`, then `Amplicon1` and so on."""
    return F.when(ref == "Reference", 0).otherwise(F.coalesce(F.regexp_extract(ref, r"^Amplicon(\d{1,9})$", 1).try_cast("int"), F.lit(10**9)))


def reference_ploidies(amplicons: DataFrame) -> DataFrame:
    """(amplicon, ref, ploidy) from amplicons (amplicon, ref_allele_counts): allele counts of `Reference`, `Amplicon1` and so on.

    An amplicon without counts, or with one that is no number, has two alleles of its reference.
    """
    counts = F.when(F.exists("ref_allele_counts", lambda n: n.isNull()) | F.col("ref_allele_counts").isNull(), F.array(F.lit(2))).otherwise(F.col("ref_allele_counts"))
    each = amplicons.select("amplicon", F.posexplode(counts).alias("place", "ploidy"))
    return each.select("amplicon", F.when(F.col("place") == 0, "Reference").otherwise(F.concat(F.lit("Amplicon"), "place")).alias("ref"), F.col("ploidy").cast("int").alias("ploidy"))


def _with_calls(cells: DataFrame, params: CallParams, ploidies: DataFrame | None) -> DataFrame:
    """Adds `called` to rows (amplicon, ref, alleles): the alleles that explain the reads best.

    alleles: structs of n, allele_key and whatever goes with them, most frequent first. For i = 1 to the ploidy the i most
    frequent alleles are real and the rest is noise; the least real one is halved until there are as many as the ploidy.
    The i with the highest multinomial likelihood holds, the smaller one if they are near equal. The ploidy is that of
    (amplicon, ref) in `ploidies`, 1 for references beyond them, or without `ploidies` that of params for all.
    """
    if ploidies is None:
        most, cells = params.ploidy, cells.withColumn("_k", F.lit(params.ploidy))
    else:
        most = ploidies.agg(F.max("ploidy")).first()[0] or 1  # one number of the panel
        cells = cells.join(ploidies.select("amplicon", "ref", F.col("ploidy").alias("_k")), ["amplicon", "ref"], "left").withColumn("_k", F.coalesce("_k", F.lit(1)))
    names = [f.name for f in cells.schema["alleles"].dataType.elementType if f.name != "n"]
    k = F.col("_k")
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda s, e: s + e["n"])
    pair = lambda n, e: F.struct(n.cast("long").alias("n"), *[e[c].alias(c) for c in names])

    def split(real: Column) -> Column:
        """Halves the last allele and puts both halves, the larger one first, at their places by count."""
        last = F.element_at(real, -1)
        low = F.floor(last["n"] / 2)
        more = F.concat(F.slice(real, F.lit(1), F.size(real) - 1), F.array(pair(last["n"] - low, last), pair(low, last)))
        keyed = F.array_sort(F.transform(more, lambda e, i: F.struct((-e["n"]).alias("o"), i.alias("i"), e.alias("e"))))
        return F.transform(keyed, lambda e: e["e"])

    cells = cells.withColumn("alleles", F.transform("alleles", lambda e: pair(e["n"], e)))
    best, score = None, None
    for i in range(1, most + 1):
        cells = cells.withColumn(f"_r{i}", F.slice("alleles", 1, i))
        for _ in range(most - i):  # cells with fewer than i alleles are not compared at i: it would be their last call again
            cells = cells.withColumn(f"_r{i}", F.when(F.size(f"_r{i}") < k, split(F.col(f"_r{i}"))).otherwise(F.col(f"_r{i}")))
        noise = total(F.col("alleles")) - total(F.slice("alleles", 1, i))
        each = F.log(F.lit(1 - params.noise) / k)
        real = F.aggregate(F.transform(f"_r{i}", lambda e: e["n"] * each - log_factorial(e["n"])), F.lit(0.0), lambda s, x: s + x)
        cells = cells.withColumn(f"_s{i}", real + noise * math.log(params.noise) - log_factorial(noise))
        if best is None:
            best, score = F.col("_r1"), F.col("_s1")
        else:
            better = (k >= i) & (F.size("alleles") >= i) & (F.col(f"_s{i}") > score + NEAR)
            best, score = F.when(better, F.col(f"_r{i}")).otherwise(best), F.when(better, F.col(f"_s{i}")).otherwise(score)
    return cells.withColumn("called", best).drop("_k", *[f"_{c}{i}" for c in "rs" for i in range(1, most + 1)])


def _most_frequent_first(*columns) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col("allele_key"), F.struct("n", "allele_key", *columns).alias("e")))), lambda x: x["e"])


def allele_call(counts: DataFrame, params: CallParams = CallParams(), ploidies: DataFrame | None = None) -> DataFrame:
    """(amplicon, cell, ref, slot, allele_key, n): the alleles that explain a cell's reads of a reference best.

    ploidies: (amplicon, ref, ploidy), see reference_ploidies; without it params.ploidy holds for all. A reference
    without reads in a cell has no alleles.
    """
    cells = counts.groupBy("amplicon", "cell", "ref").agg(_most_frequent_first().alias("alleles"))
    called = _with_calls(cells, params, ploidies).select("amplicon", "cell", "ref", F.posexplode("called").alias("slot", "x"))
    return called.select("amplicon", "cell", "ref", (F.col("slot") + 1).alias("slot"), "x.allele_key", "x.n")


def _edits(allele_key: Column) -> Column:
    return F.substring_index(allele_key, ":", -1)


def _flag(allele_key: Column) -> Column:
    return F.when(_edits(allele_key).isin(UNMODIFIED, UNMODIFIED_WITHOUT_SUBSTITUTIONS), "U").otherwise("M")


def with_types(called: DataFrame) -> DataFrame:
    """Adds flag (U or M) and types (U, or letters of D, I, S)."""
    return called.withColumn("types", mutation_type(_edits(F.col("allele_key")))).withColumn("flag", _flag(F.col("allele_key")))


def _joined(column: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(reference_place(F.col("ref")).alias("place"), "ref", "slot", F.col(column).cast("string").alias("x"))))
    return F.array_join(F.transform(rows, lambda s: s["x"]), ",")


def final_cell_strings(called: DataFrame) -> DataFrame:
    """Comma strings of each (amplicon, cell): alleles, flags, types and read counts, by reference and slot."""
    return with_types(called).groupBy("amplicon", "cell").agg(
        _joined("allele_key").alias("final_alleles"), _joined("flag").alias("final_flags"), _joined("types").alias("final_types"), _joined("n").alias("final_counts"))


def final_cell_totals(called: DataFrame) -> DataFrame:
    """Reads of the final alleles and the share of them that is mutated, by alleles."""
    return with_types(called).groupBy("amplicon", "cell").agg(F.sum("n").cast("long").alias("final_reads"), pct_half_up(F.count_if(F.col("flag") == "M"), F.count("*")).alias("final_mut_pct"))


def per_reference_totals(called: DataFrame) -> DataFrame:
    return with_types(called).groupBy("amplicon", "cell", "ref").agg(F.sum("n").cast("long").alias("ref_reads"), pct_half_up(F.count_if(F.col("flag") == "M"), F.count("*")).alias("ref_mut_pct"))


def cell_amplicon_summary(usable: DataFrame, params: CallParams = CallParams(), ploidies: DataFrame | None = None) -> DataFrame:
    """The 13-column summary of each cell at an amplicon (with the amplicon: 14 columns).

    Reads are counted by allele and then brought together by (amplicon, cell), which serves the calls of each reference and
    the row of each cell: two shuffles, of allele counts, and no join but that with the ploidies of the panel.
    """
    edits, plain = _status(params)
    kind = F.when(edits == "", 0).when(edits == plain, 1).otherwise(2)  # neither, unmodified, modified
    key = F.concat("aln_ref", F.lit(":"), F.when(edits == "", "NA").otherwise(edits))
    counts = usable.groupBy("amplicon", "cell", F.col("aln_ref").alias("ref"), key.alias("allele_key"), kind.alias("kind")).agg(F.count("*").alias("n"))
    refs = counts.repartition("amplicon", "cell").groupBy("amplicon", "cell", "ref").agg(_most_frequent_first("kind").alias("alleles"))
    refs = _with_calls(refs, params, ploidies)
    by_place = F.array_sort(F.collect_list(F.struct(reference_place(F.col("ref")).alias("place"), "ref", "alleles", "called")))
    cells = refs.groupBy("amplicon", "cell").agg(by_place.alias("refs"))
    cells = cells.withColumn("every", F.flatten(F.transform("refs", lambda r: r["alleles"]))).withColumn("final", F.flatten(F.transform("refs", lambda r: r["called"])))
    reads = lambda rows: F.aggregate(rows, F.lit(0).cast("long"), lambda s, e: s + e["n"])
    listed = lambda rows, f: F.array_join(F.transform(rows, f), ",")
    mutated = lambda rows: pct_half_up(F.size(F.filter(rows, lambda e: _flag(e["allele_key"]) == "M")), F.size(rows))
    known = reads(F.filter("every", lambda e: e["kind"] > 0))
    ordered = F.array_sort(F.transform("every", lambda e: F.struct((-e["n"]).alias("o"), e["allele_key"].alias("a"), e["n"].alias("n"))))
    final, of_refs = F.col("final"), F.transform("refs", lambda r: r["called"])
    return cells.select(
        "cell", "amplicon", known.alias("all_cell_read_count"), pct_half_up(reads(F.filter("every", lambda e: e["kind"] == 2)), known).alias("all_cell_mut_pct"),
        listed(ordered, lambda e: F.concat(e["a"], F.lit(":"), e["n"].cast("string"))).alias("all_cell_allele_string"),
        reads(final).alias("final_cell_read_count"), mutated(final).alias("final_cell_mut_allele_pct"), listed(final, lambda e: e["allele_key"]).alias("final_cell_allele_string"),
        F.size("refs").cast("long").alias("final_num_refs_covered"), listed(final, lambda e: _flag(e["allele_key"])).alias("final_cell_allele_mod_string"),
        listed(final, lambda e: mutation_type(_edits(e["allele_key"]))).alias("final_cell_allele_mod_types_string"), listed(final, lambda e: e["n"].cast("string")).alias("final_cell_allele_readcount_string"),
        listed(of_refs, lambda r: reads(r).cast("string")).alias("final_ref_read_count_string"),
        listed(of_refs, lambda r: F.coalesce(F.format_number(mutated(r), 2), F.lit("NA"))).alias("final_ref_mut_allele_fracs_string"))


def filter_report_depth(summary: DataFrame, params: CallParams = CallParams()) -> DataFrame:
    return summary.where(F.col("all_cell_read_count") >= params.report_depth)


def unmodified_alleles(table: DataFrame) -> DataFrame:
    """Rows of an allele frequency table that are UNMODIFIED and have no edited base."""
    return table.where((F.col("read_status") == "UNMODIFIED") & (F.col("n_deleted") == 0) & (F.col("n_inserted") == 0) & (F.col("n_mutated") == 0))


def wildtype_allele(table: DataFrame) -> DataFrame:
    """(amplicon, wildtype): the most frequent unmodified sequence, ties by sequence; amplicons without one have no row."""
    ranked = unmodified_alleles(table).withColumn("r", F.row_number().over(Window.partitionBy("amplicon").orderBy(F.desc("reads"), "aligned_sequence")))
    return ranked.where("r = 1").select("amplicon", F.col("aligned_sequence").alias("wildtype"))


def attach_wildtype(rows: DataFrame, wildtypes: DataFrame) -> DataFrame:
    return rows.join(wildtypes, "amplicon", "left")


def consensus_sequences(called: DataFrame, sequences: DataFrame, wildtypes: DataFrame) -> DataFrame:
    """Adds sequence and adjusted to each final allele: its most frequent sequence.

    If several are most frequent with one read each, the wildtype if it is known (adjusted); with more reads the least.
    """
    return _adjusted(called.join(_modal(sequences, "amplicon", "cell", "allele_key").drop("n"), ["amplicon", "cell", "allele_key"]), wildtypes)


def consensus_alleles(usable: DataFrame, wildtypes: DataFrame, params: CallParams = CallParams(), ploidies: DataFrame | None = None) -> DataFrame:
    """consensus_sequences of the reads' calls in one pass: the alleles' counts are sums of those of their sequences.

    Two shuffles, of counts by sequence, and joins with tables of the panel only.
    """
    edits, _ = _status(params)
    key = F.concat("aln_ref", F.lit(":"), F.when(edits == "", "NA").otherwise(edits))
    counts = usable.groupBy("amplicon", "cell", F.col("aln_ref").alias("ref"), key.alias("allele_key"), "seq").agg(F.count("*").alias("n"))
    alleles = _modal(counts.repartition("amplicon", "cell"), "amplicon", "cell", "ref", "allele_key")
    cells = alleles.groupBy("amplicon", "cell", "ref").agg(_most_frequent_first("modal", "top", "ties").alias("alleles"))
    called = _with_calls(cells, params, ploidies).select("amplicon", "cell", "ref", F.posexplode("called").alias("slot", "x"))
    return _adjusted(called.select("amplicon", "cell", "ref", (F.col("slot") + 1).alias("slot"), "x.*"), wildtypes)


def _adjusted(alleles: DataFrame, wildtypes: DataFrame) -> DataFrame:
    joined = attach_wildtype(alleles, wildtypes)
    adjusted = (F.col("ties") > 1) & (F.col("top") == 1) & F.col("wildtype").isNotNull()
    return joined.select("amplicon", "cell", "ref", "slot", "allele_key", F.when(adjusted, F.col("wildtype")).otherwise(F.col("modal")).alias("sequence"), adjusted.alias("adjusted"))


def _modal(sequences: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, modal, top, ties): all reads, the most frequent sequence, its reads and how many have as many."""
    each = sequences.groupBy(*keys, "n").agg(F.min("seq").alias("modal"), F.count("*").alias("ties"))
    best = F.max(F.struct(F.col("n").alias("top"), "modal", "ties"))
    return each.groupBy(*keys).agg(F.sum(F.col("n") * F.col("ties")).alias("n"), best.alias("b")).select(*keys, "n", "b.*")


def allele_records(consensus: DataFrame) -> DataFrame:
    """(header, sequence, quality) of each consensus allele."""
    header = F.concat(F.lit("@"), F.col("amplicon"), F.lit(":"), F.when(F.col("adjusted"), "Adjusted:").otherwise(""), F.regexp_replace("allele_key", " ", "_"), F.lit(":"), F.col("cell"), F.lit(":"), F.col("slot").cast("string"))
    return consensus.select("amplicon", "cell", "slot", header.alias("header"), "sequence", F.repeat(F.lit("a"), F.length("sequence")).alias("quality"))
