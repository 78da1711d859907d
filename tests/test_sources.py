from __future__ import annotations

import gzip

import pytest

from editloom.sources import fastq, text


def write(path, content: str):
    path.write_text(content)
    return f"file://{path}"


def test_pairs_stop_at_the_shorter_file(spark, tmp_path):
    with gzip.open(tmp_path / "a.fastq.gz", "wt") as f:
        f.write("@r1 x\nACGT\n+\nIIII\n@r2\nAC\n+\nII\n")
    r2 = write(tmp_path / "b.fastq", "@r1 y\nGG\n+\nFF\n")
    got = fastq.read_pairs(spark, [f"file://{tmp_path}/a.fastq.gz"], [r2]).collect()
    assert [tuple(r) for r in got] == [(0, 0, "r1 x", "ACGT", "IIII", "GG", "FF")]


def test_lanes_must_pair_up(tmp_path):
    a, b, c = (write(tmp_path / name, "") for name in "abc")
    for r1, r2 in (([a, b], [c]), ([a, b], [b, c]), (f"file://{tmp_path}/[ab]", [c])):
        with pytest.raises(ValueError):
            fastq._checked_lanes(r1, r2)


def test_annotated_and_truncated_records(spark, tmp_path):
    whole = "@id:9:CELL rest\nACGT\n+ ALN=Reference ALN_SCORES=1 DEL=2 INS= SUB= ALN_REF=AC\nIIII\n"
    path = write(tmp_path / "x.fq", whole + "@id:8:OTHER\nAC\n+\nII\n@broken\nAC\n")
    files = fastq.read_records(spark, [path])
    assert sorted(tuple(r) for r in fastq.annotated_reads(files).collect()) == [("id:8:OTHER", "OTHER", "", "", "AC"), ("id:9:CELL", "CELL", "Reference", "DEL=2 INS= SUB=", "ACGT")]
    folder = tmp_path / "run_on_AMP1"
    folder.mkdir()
    (folder / "out.fastq").write_text(whole)
    with gzip.open(folder / "cut.fastq.gz", "wt") as f:
        f.write(whole * 50)
    raw = (folder / "cut.fastq.gz").read_bytes()
    (folder / "cut.fastq.gz").write_bytes(raw[:-12])
    got = fastq.filtered_alleles(fastq.read_records(spark, [f"file://{folder}/out.fastq", f"file://{folder}/cut.fastq.gz"])).collect()
    assert ("AMP1", "9", "ACGT") in {tuple(r) for r in got}


def test_text_tables(spark, tmp_path):
    assert [tuple(r) for r in text.barcode_whitelist(spark, write(tmp_path / "w.txt", "CC \nAA\n")).orderBy("ordinal").collect()] == [(0, "CC"), (1, "AA")]
    amps = text.amplicons(spark, write(tmp_path / "a.txt", "one\tACGT,ACGG\tGG\t2,1\ntwo\tTTTT\nthree\tTT\t\tNA\nfour\tTT\t\t1,x\n")).orderBy("ordinal").collect()
    assert [(r["amplicon"], r["amp_seqs"], r["guide"], r["ref_allele_counts"]) for r in amps] == [("one", ["ACGT", "ACGG"], "GG", [2, 1]), ("two", ["TTTT"], "", [2]), ("three", ["TT"], "", [2]), ("four", ["TT"], "", [1, None])]
    alts = text.alternate_alleles(spark, write(tmp_path / "alt.txt", "amplicon\tlabel\tseqs\none\tx\tAA,CC\n")).collect()
    assert [tuple(r) for r in alts] == [("one", ["AA", "CC"])]
    sam = text.alignments(spark, write(tmp_path / "x.sam", "@HD\tVN:1\nr1\t64\tchr1\t11\t40\t4M\t*\t0\t0\tACGT\tIIII\n\n")).collect()
    assert [tuple(r) for r in sam] == [("r1", 64, "chr1", 10, 40, "4M", "ACGT", "IIII")]
    wide = text.wide_summary(spark, write(tmp_path / "wide.txt", "cell\ttotCount.A\tmodPct.A\nc1\t0\tNA\nc2\tNA\tNA\nc3\t4\t25.0\n")).collect()
    assert [tuple(r) for r in wide] == [("c1", "A", 0, None), ("c2", "A", None, None), ("c3", "A", 4, 25.0)]
