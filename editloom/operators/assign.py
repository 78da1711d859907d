"""Assigning aligned read pairs to amplicons by primer and position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import alignment_end, reverse_complement
from ..params import AssignParams
from .lookups import primer_homes_of, windows_by_place

CALLS = ("amp1", "amp2", "amp1_aln", "amp2_aln")


def decode_flags(alignments: DataFrame) -> DataFrame:
    flag = F.col("flag")
    return alignments.withColumn("unmapped", flag.bitwiseAND(0x4) != 0).withColumn("reverse", flag.bitwiseAND(0x10) != 0).withColumn("secondary", flag.bitwiseAND(0x100) != 0)


def orient(alignments: DataFrame, params: AssignParams = AssignParams()) -> DataFrame:
    """Adds primer, key_pos and the read as sequenced (seq_out, qual_out): of a reverse mate, the end counts as its start."""
    df = decode_flags(alignments)
    k = params.primer_length
    rev, seq = F.col("reverse"), F.col("seq")
    last = F.substring(seq, F.greatest(F.lit(1), F.length(seq) - k + 1), F.lit(k))
    return (df.withColumn("primer", F.when(rev, last).otherwise(F.substring(seq, F.lit(1), F.lit(k))))
            .withColumn("key_pos", F.when(rev, alignment_end(F.col("pos"), F.col("cigar"))).otherwise(F.col("pos")))
            .withColumn("seq_out", F.when(rev, reverse_complement(seq)).otherwise(seq)).withColumn("qual_out", F.when(rev, F.reverse("qual")).otherwise(F.col("qual"))))


def pair_mates(alignments: DataFrame, columns: list[str]) -> DataFrame:
    """One row per read name that has both mates: the columns of each, with 1 or 2 after their names."""
    mate = F.col("flag").bitwiseAND(0x80) != 0
    picked = [F.max(F.when(~mate if i == 1 else mate, F.col(c))).alias(f"{c}{i}") for i in (1, 2) for c in columns]
    both = alignments.groupBy("qname").agg(F.count_if(mate).alias("_second"), F.count_if(~mate).alias("_first"), *picked)
    return both.where("_first = 1 and _second = 1").drop("_first", "_second")


def filter_low_depth(pairs: DataFrame, depth: DataFrame, params: AssignParams = AssignParams()) -> DataFrame:
    """Pairs of cells with enough reads, by (cell, reads)."""
    return pairs.join(depth.where(F.col("reads") >= params.min_reads_per_cell), "cell", "left_semi")


def attach_depth(pairs: DataFrame, depth: DataFrame) -> DataFrame:
    return pairs.join(depth, "cell", "left")


def depth_census(depth: DataFrame, params: AssignParams = AssignParams()) -> DataFrame:
    enough = F.col("reads") >= params.min_reads_per_cell
    return depth.agg(F.count_if(~enough).alias("failing_cells"), F.count_if(enough).alias("passing_cells"))


def primers_seen(pairs: DataFrame) -> DataFrame:
    """(key): the different primers of pairs, null left out."""
    return pairs.select(F.explode(F.array("primer1", "primer2")).alias("key")).where("key IS NOT NULL").distinct()


def places_seen(pairs: DataFrame) -> DataFrame:
    """(side, chr, pos): the different places of pairs that a window could hold, null left out."""
    sides = F.array(*[F.struct(F.lit(i).alias("side"), F.col(f"chr{i}").alias("chr"), F.col(f"pos{i}").alias("pos")) for i in (1, 2)])
    return pairs.select(F.explode(sides).alias("s")).select("s.*").where("chr IS NOT NULL AND pos IS NOT NULL").distinct()


def calls(pairs: DataFrame, amplicons: DataFrame, params: AssignParams = AssignParams()) -> DataFrame:
    """Pairs with all four calls. Lookups hold what the pairs show, so their size follows the reads, not the variants of the panel;

    they are shuffled unless Spark, which then knows how large they are, finds them small enough to broadcast. Pairs are
    read once for their primers and once for the calls: they should come from a table.
    All pairs are joined by primer 1 only. What its amplicon knows (its other primer, its place, the room around it) settles
    most of them; the others are joined by primer 2, and those whose places are still open by their places. All branches read
    the same columns of the same shuffles, so these are made once.
    """
    homes = primer_homes_of(primers_seen(pairs), amplicons, params)
    stars = F.broadcast(amplicons.agg(F.coalesce(F.bool_or(F.col("chr") == "*"), F.lit(False)).alias("_stars")))
    first = pairs.join(homes.select(F.col("key").alias("primer1"), F.col("home").alias("_home")), "primer1", "left").crossJoin(stars)
    first = first.withColumn("amp1", F.when(F.col("_home").isNotNull(), F.col("_home.amplicon")))
    for i in (1, 2):
        unmapped = F.col(f"chr{i}").isNull() | F.col(f"pos{i}").isNull() | ((F.col(f"chr{i}") == "*") & ~F.col("_stars"))
        first = first.withColumn(f"_known{i}", unmapped | _settles(i, params)).withColumn(f"amp{i}_aln", F.when(~unmapped, _call_at_home(i, params)))
    named = F.col("primer2").isNull() | F.coalesce(F.array_contains("_home.ends", F.col("primer2")), F.lit(False))
    first = first.withColumn("amp2", F.when(F.array_contains("_home.ends", F.col("primer2")), F.col("amp1")))
    settled = named & F.col("_known1") & F.col("_known2")

    rest = first.where(~settled).drop("_home", "_stars", "amp2")
    second = rest.join(homes.select(F.col("key").alias("primer2"), F.col("home").alias("_home")), "primer2", "left").withColumn("amp2", F.when(F.col("_home").isNotNull(), F.col("_home.amplicon")))
    for i in (1, 2):
        second = second.withColumn(f"amp{i}_aln", F.when(F.col(f"_known{i}"), F.col(f"amp{i}_aln")).otherwise(_call_at_home(i, params))).withColumn(f"_known{i}", F.col(f"_known{i}") | _settles(i, params))
    placed = F.col("_known1") & F.col("_known2")

    # Spark's estimate does not see that windows were exploded, so without the hint it would broadcast large ones too.
    last = second.where(~placed)
    for i in (1, 2):
        windows = windows_by_place(amplicons, params, i).select(F.col("pos").alias(f"pos{i}"), F.col("chr").alias(f"chr{i}"), F.col("amplicon").alias("_found"))
        last = last.join(windows.hint("merge"), [f"pos{i}", f"chr{i}"], "left").withColumn(f"amp{i}_aln", F.coalesce(f"amp{i}_aln", "_found")).drop("_found")
    columns = [*pairs.columns, *CALLS]
    return first.where(settled).select(columns).unionByName(second.where(placed).select(columns)).unionByName(last.select(columns))


def _from_home(side: int) -> Column:
    return F.abs(F.col(f"pos{side}").cast("long") - F.col("_home.start" if side == 1 else "_home.end"))


def _settles(side: int, params: AssignParams) -> Column:
    """Whether place 1 is so near to the start of _home, or place 2 to its end, that it lies in that window or in none."""
    return F.coalesce((F.col(f"chr{side}") == F.col("_home.chr")) & (_from_home(side) < F.col(f"_home.room{side}") - params.window), F.lit(False))


def _call_at_home(side: int, params: AssignParams) -> Column:
    """The amplicon of _home if it settles the place and has it in its window, else null."""
    return F.when(_settles(side, params) & (_from_home(side) <= params.window), F.col("_home.amplicon"))


def primer_calls(pairs: DataFrame, primers: DataFrame) -> DataFrame:
    """Adds amp1 and amp2: what the lookup (key, value) has for primer1 and primer2, or null. Rebalanced, its rows are made once for both joins."""
    primers = primers.hint("rebalance")
    a, b = primers.select(F.col("key").alias("primer1"), F.col("value").alias("amp1")), primers.select(F.col("key").alias("primer2"), F.col("value").alias("amp2"))
    return pairs.join(a, "primer1", "left").join(b, "primer2", "left")


def position_calls(pairs: DataFrame, windows: DataFrame) -> DataFrame:
    """Adds amp1_aln (place 1 in a start window) and amp2_aln (place 2 in an end window), or null: equi-joins on exploded windows.

    Positions come first in the keys, as sorting compares the first column's prefix, and chromosomes hardly tell rows apart.
    """
    a = windows.where("side = 1").select(F.col("chr").alias("chr1"), F.col("pos").alias("pos1"), F.col("amplicon").alias("amp1_aln"))
    b = windows.where("side = 2").select(F.col("chr").alias("chr2"), F.col("pos").alias("pos2"), F.col("amplicon").alias("amp2_aln"))
    return pairs.join(a, ["pos1", "chr1"], "left").join(b, ["pos2", "chr2"], "left")


def candidate_set() -> Column:
    return F.array_distinct(F.array_compact(F.array(*CALLS)))


def strict_amplicon() -> Column:
    """amp1 if it equals amp2 and at least one position call, and all of them, say the same; else null."""
    agree = (F.col("amp1") == F.col("amp2")) & (F.coalesce("amp1_aln", "amp2_aln") == F.col("amp1")) & (F.coalesce("amp2_aln", "amp1_aln") == F.col("amp1"))
    return F.when(agree, F.col("amp1"))


def partial_rescue() -> Column:
    return strict_amplicon().isNotNull() & (F.col("amp1_aln").isNull() | F.col("amp2_aln").isNull())


def assign_strict(calls: DataFrame) -> DataFrame:
    """Adds amplicon (null: not assigned) and rescued (assigned with one position call only)."""
    return calls.withColumn("amplicon", strict_amplicon()).withColumn("rescued", F.coalesce(partial_rescue(), F.lit(False)))


def assign_permissive(calls: DataFrame) -> DataFrame:
    """A row for each distinct amplicon that any call names."""
    return calls.withColumn("amplicon", F.explode(candidate_set()))


def _other_location() -> Column:
    return F.coalesce(F.col("amp1_aln") != F.col("amp1"), F.lit(False)) | F.coalesce(F.col("amp2_aln") != F.col("amp2"), F.lit(False))


def reject_reason_strict() -> Column:
    known = F.col("amp1").isNotNull() & F.col("amp2").isNotNull()
    return F.when(known & (F.col("amp1") != F.col("amp2")), "chimeric").when(known & _other_location(), "other location").otherwise("unidentified")


def reject_reason_permissive() -> Column:
    """Null for a pair whose primers name the same amplicon; another place is tested before chimeras."""
    known = F.col("amp1").isNotNull() & F.col("amp2").isNotNull()
    return F.when(~known, "unidentified").when(F.col("amp1") == F.col("amp2"), F.lit(None)).when(_other_location(), "other location").otherwise("chimeric")


def mapped_pair() -> Column:
    return (F.col("chr1") != "*") & (F.col("chr2") != "*")


def reads_per_amplicon(assigned: DataFrame, amplicons: DataFrame) -> DataFrame:
    """Assigned pairs of every amplicon, 0 included."""
    counts = assigned.groupBy("amplicon").agg(F.count("*").alias("n"))
    return amplicons.select("amplicon").join(counts, "amplicon", "left").select("amplicon", F.coalesce("n", F.lit(0)).alias("reads"))


def pairs_per_cell_status(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cell").agg(F.count_if(mapped_pair()).alias("aligned"), F.count_if(~mapped_pair()).alias("unaligned"))


def call_combinations(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy(F.col("amplicon").isNotNull().alias("valid"), *CALLS).agg(F.count("*").alias("pair_count"))


def split_counters() -> dict[str, Column]:
    """The counters of strictly assigned pairs."""
    reason = F.when(F.col("amplicon").isNull(), reject_reason_strict())
    return {"total": F.count(F.lit(1)), "aligned": F.count_if(mapped_pair()), "identified": F.count_if(F.col("amplicon").isNotNull()), "rescued": F.count_if("rescued"),
            **{r.replace(" ", "_"): F.count_if(reason == r) for r in ("chimeric", "other location", "unidentified")}}


def split_totals(assigned: DataFrame) -> DataFrame:
    """One row of totals of strict assignment."""
    return assigned.agg(*[c.alias(name) for name, c in split_counters().items()])
