from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from editloom.functions import sequence as sq
from editloom.operators import demux, export, qc, summary
from editloom.params import DemuxParams, QualityParams, ZygosityParams


@pytest.fixture(scope="module")
def dense(spark):
    made = spark.createDataFrame([("amp_ok", "cellA", 12, 25.0, 10, 20.0), ("amp_two", "cellA", 3, 0.0, 2, 0.0), ("amp_ok", "cellB", 4, 100.0, 4, 100.0)],
                                 "amplicon string, cell string, raw_reads long, raw_mod_pct double, final_reads long, final_mut_pct double")
    status = spark.createDataFrame([("amp_ok", "Completed"), ("amp_two", "Completed"), ("amp_failed", "Failed"), ("amp_empty", "Completed")], "amplicon string, status string")
    return summary.densify(made, status, made).cache()  # amp_empty has no summary


def test_three_states(dense):
    got = {(r["cell"], r["amplicon"]): (r["raw_tot"], r["raw_mod"], r["tot"], r["mod"]) for r in dense.collect()}
    assert got[("cellA", "amp_ok")] == (12, 25.0, 10, 20.0) and got[("cellA", "amp_failed")] == (None, None, None, None)
    assert got[("cellB", "amp_two")] == (0, None, 0, None) and got[("cellB", "amp_empty")] == (None, None, None, None) and len(got) == 8


def test_read_count_is_raw(dense):
    assert {r["cell"]: r["read_count"] for r in summary.cell_quality(dense).collect()} == {"cellA": 15, "cellB": 4}


def test_wide_and_back(dense):
    wide = summary.wide(dense, ["amp_ok", "amp_failed"])
    assert wide.columns == ["cell", "totCount.amp_ok", "modPct.amp_ok", "totCount.amp_failed", "modPct.amp_failed"]
    assert {tuple(r) for r in summary.unpivot_wide(wide).collect()} == {tuple(r) for r in dense.where("amplicon IN ('amp_ok', 'amp_failed')").select("cell", "amplicon", "tot", "mod").collect()}


def test_quality_classes(spark):
    ranked = spark.createDataFrame([("BC1", 1, 2.0), ("BC2", 500, 0.2), ("BC3", 15000, 1.5), ("BC4", 20000, 0.0)], "cell string, barcode_rank long, amplicon_score double")
    assert {r["cell"]: r["color"] for r in summary.quality_class(ranked).collect()} == {"BC1": "HQ_HI", "BC2": "LQ_HI", "BC3": "HQ_LO", "BC4": "LQ_LO"}


@pytest.mark.parametrize("selected, cells", [(("HQ_HI",), "A"), (("HQ_HI", "HQ_LO"), "AC"), ((), "")])
def test_class_selection(spark, selected, cells):
    colors = spark.createDataFrame([("A", "HQ_HI"), ("B", "LQ_HI"), ("C", "HQ_LO"), ("D", "LQ_LO")], "cell string, color string")
    got = summary.select_cells(colors.select("cell"), colors, replace(QualityParams(), selected=selected)).collect()
    assert sorted(r["cell"] for r in got) == list(cells)


def test_ranks_break_ties_by_cell(spark):
    scores = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 0)], "cell string, read_count long")
    assert {r["cell"]: r["barcode_rank"] for r in summary.barcode_rank(scores).collect()} == {"c": 1, "a": 2, "b": 3, "d": 4}


def test_mask_comes_before_ranks_and_total_after(dense):
    masked = summary.cell_quality(dense, QualityParams(min_reads_per_amplicon=1)).collect()
    assert [r["cell"] for r in masked] == ["cellA"]
    late = summary.cell_quality(dense, QualityParams(min_total_reads=5)).collect()
    assert [(r["cell"], r["barcode_rank"]) for r in late] == [("cellA", 1)]


def test_funnel_percentages(spark):
    rows = [(i, i < 50, i < 25, "AA" if i % 2 else "BB") for i in range(200)]
    flagged = spark.createDataFrame(rows, "i int, long_enough boolean, clean boolean, cell string")
    assert tuple(demux.parse_funnel_pct(flagged).first()) == (25.0, 50.0, 2)
    assert tuple(demux.parse_funnel_pct(flagged.where("false")).first()) == (0.0, 0.0, 0)


def test_demultiplexing_by_hand(spark):
    p = DemuxParams()
    barcodes = spark.createDataFrame([(0, "AAAAAAAAA"), (1, "CCCCCCCCC")], "ordinal int, barcode string")
    rest = "ACGTACGTACGTACGTACGTAC"
    seqs = ["AAAAAAAAA" + "AC" + p.constant1 + "CCCCCCCCC" + p.constant2 + rest, "NAAAAAAAA" + p.constant1 + "CCCCCCCCC" + p.constant2 + rest, "AAAAAAAAA" + p.constant1 + "CCCCCCCCC" + p.constant2 + rest[:19],
            "AAAAAAAAA" + p.constant1 + "CCCCCCCCC" + p.constant2 + rest + p.adapter, "AAAAAAAAA" + p.constant1 + "GGGGGGGGG" + p.constant2 + rest, "AAAA", None]
    pairs = spark.createDataFrame([(f"r{i} x", s, "I" * len(s or ""), "ACGT", "IIII") for i, s in enumerate(seqs)], "name string, seq1 string, qual1 string, seq2 string, qual2 string")
    flagged = demux.flag_pairs(pairs, barcodes)
    assert tuple(demux.parse_funnel(flagged).first()) == (7, 5, 5, 4, 1, 3, 2)
    assert sorted((r["read_id"], r["cell"], r["seq1"]) for r in demux.tag_reads(flagged).collect()) == [("r0", "AAAAAAAAACCCCCCCCC", rest), ("r1", "AAAAAAAAACCCCCCCCC", rest)]


@pytest.mark.parametrize("mod, second, code", [(None, None, 0), (20.0, 0.0, 0), (20.5, 0.0, 1), (80.0, 19.9, 2), (80.0, 20.0, 3), (100.0, None, 2)])
def test_zygosity(spark, mod, second, code):
    d = spark.createDataFrame([("c", "a", mod)], "cell string, amplicon string, mod double")
    top = spark.createDataFrame([("c", "a", second)], "cell string, amplicon string, allele_freq_2 double")
    assert export.zygosity(d, top).first()["zygosity"] == code
    assert export.zygosity(d, top, ZygosityParams(mark_no_data=True)).first()["zygosity"] == (-1 if mod is None else code)


def test_strict_share_of_amplicons(spark):
    scored = spark.createDataFrame([("c", f"a{i}", 1) for i in range(5)], "cell string, amplicon string, raw_tot long")
    at1 = lambda inclusive: {r["share_pct"]: r["cells"] for r in qc.amplicons_per_cell_at_depth(scored, inclusive).where("threshold = 1").collect()}
    assert at1(False) == {100: 0, 90: 1, 80: 1, 50: 1} and at1(True)[100] == 1


def test_sequence_functions(spark):
    df = spark.createDataFrame([("acgtN-_", 10, "5M2I3D4S1=", "AMP:1 (x)__")], "s string, p int, c string, n string")
    got = df.select(sq.reverse_complement(F.col("s")), sq.alignment_end(F.col("p"), F.col("c")), sq.sanitize_name(F.col("n")), sq.has_foreign_letters(F.lit("ACX"))).first()
    assert tuple(got) == ("_-NACGT", 18, "AMP_1_x", True)
    assert df.select(sq.alignment_end(F.lit(7), F.lit("*"))).first()[0] == 6
    types = spark.createDataFrame([("DEL= INS= SUB=",), ("DEL=3 INS= SUB=1",), ("DEL= INS=2",)], "e string").select(sq.mutation_type(F.col("e"))).collect()
    assert [r[0] for r in types] == ["U", "DS", "I"]
