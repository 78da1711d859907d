"""Allele counts of each reference, usable amplicons with an empty summary, and one-pass results against the steps apart."""

from __future__ import annotations

import random

from editloom.operators import alleles, summary

from .test_alleles import call


def reads(spark, seed=1):
    r = random.Random(seed)
    rows = []
    for cell in range(25):
        for amplicon in ("a", "b", "c"):
            for ref in ("Reference", "Amplicon1", "Amplicon2"):
                for _ in range(r.randint(0, 12)):
                    edit = r.choice(["DEL= INS= SUB=", "DEL=3 INS= SUB=", "DEL= INS=2 SUB=", "DEL= INS= SUB=1", ""])
                    rows.append((amplicon, f"c{cell}", ref, edit, r.choice("ACGT") * 4))
    return spark.createDataFrame(rows, "amplicon string, cell string, aln_ref string, ann string, seq string")


def panel(spark):
    return spark.createDataFrame([("a", [2, 1]), ("b", [1]), ("c", None)], "amplicon string, ref_allele_counts array<int>")


K = {("a", "Reference"): 2, ("a", "Amplicon1"): 1, ("b", "Reference"): 1, ("c", "Reference"): 2}


def test_ploidies(spark):
    assert {(r["amplicon"], r["ref"]): r["ploidy"] for r in alleles.reference_ploidies(panel(spark)).collect()} == K


def test_each_reference_is_called_by_its_own_count(spark):
    counts = alleles.allele_counts(reads(spark)).cache()
    cells: dict = {}
    for r in counts.collect():
        cells.setdefault((r["amplicon"], r["cell"], r["ref"]), []).append((r["allele_key"], r["n"]))
    got: dict = {}
    for r in sorted(alleles.allele_call(counts, ploidies=alleles.reference_ploidies(panel(spark))).collect(), key=lambda r: r["slot"]):
        got.setdefault((r["amplicon"], r["cell"], r["ref"]), []).append((r["allele_key"], r["n"]))
    assert got == {key: call(found, K.get((key[0], key[2]), 1)) for key, found in cells.items()}


def test_one_pass_gives_what_the_steps_give(spark):
    usable, ploidies = reads(spark).cache(), alleles.reference_ploidies(panel(spark)).cache()
    counts = alleles.allele_counts(usable)
    called = alleles.allele_call(counts, ploidies=ploidies).cache()
    keys = ["amplicon", "cell"]
    steps = (alleles.raw_summary(usable).join(alleles.allele_string(counts), keys).join(alleles.final_cell_totals(called), keys).join(alleles.final_cell_strings(called), keys)
             .select("cell", "amplicon", "raw_reads", "raw_mod_pct", "allele_string", "final_reads", "final_mut_pct", "final_alleles", "final_flags", "final_types", "final_counts"))
    whole = alleles.cell_amplicon_summary(usable, ploidies=ploidies)
    some = [c for c in whole.columns if c not in ("final_num_refs_covered", "final_ref_read_count_string", "final_ref_mut_allele_fracs_string")]
    assert sorted(map(tuple, whole.select(*some).collect()), key=repr) == sorted(map(tuple, steps.collect()), key=repr)
    wild = spark.createDataFrame([("a", "WILD"), ("c", "TYPE")], "amplicon string, wildtype string")
    apart = alleles.consensus_sequences(called, alleles.allele_sequence_counts(usable), wild)
    assert sorted(map(tuple, alleles.consensus_alleles(usable, wild, ploidies=ploidies).select(*apart.columns).collect())) == sorted(map(tuple, apart.collect()))


def test_references_in_the_order_of_the_panel(spark):
    usable = spark.createDataFrame([("a", "c", ref, "DEL= INS= SUB=", "A") for ref in ("Amplicon10", "Amplicon2", "Reference")], "amplicon string, cell string, aln_ref string, ann string, seq string")
    row = alleles.cell_amplicon_summary(usable, ploidies=panel(spark).where("false").selectExpr("amplicon", "amplicon AS ref", "1 AS ploidy")).first()
    assert [x.split(":")[0] for x in row["final_cell_allele_string"].split(",")] == ["Reference", "Amplicon2", "Amplicon10"]
    assert (row["final_num_refs_covered"], row["final_ref_read_count_string"]) == (3, "1,1,1")


def test_references_are_those_of_aligned_unambiguous_reads(spark):
    rows = [("a", "Reference"), ("a", "NA"), ("a", "Reference&Amplicon1"), ("b", "NA"), ("c", "Reference"), ("c", "Amplicon1")]
    got = {r["amplicon"]: (r["references"], r["more_than_expected"]) for r in alleles.references_seen(spark.createDataFrame(rows, "amplicon string, aln_ref string")).collect()}
    assert got == {"a": (1, False), "c": (2, True)}


def test_three_states_of_a_completed_amplicon(spark):
    """With reads, with an empty summary (count 0, no share), and without a summary (null, as if it had failed)."""
    status = spark.createDataFrame([(a, s) for a, s in (("full", "Completed"), ("empty", "Completed"), ("none", "Completed"), ("failed", "Failed"))], "amplicon string, status string")
    made = spark.createDataFrame([("full", "c", 12, 25.0, 10, 20.0)], "amplicon string, cell string, raw_reads long, raw_mod_pct double, final_reads long, final_mut_pct double")
    summarized = spark.createDataFrame([("full",), ("empty",), ("failed",)], "amplicon string")
    got = {r["amplicon"]: tuple(r)[2:] for r in summary.densify(made, status, summarized).collect()}
    assert got == {"full": (12, 25.0, 10, 20.0), "empty": (0, None, 0, None), "none": (None,) * 4, "failed": (None,) * 4}
