from __future__ import annotations

import math
import random

import pytest

from editloom.operators import alleles
from editloom.params import CallParams


def call(counts: list[tuple[str, int]], k: int, noise: float = 0.01):
    """Plain multinomial choice in log space."""
    ordered = sorted(counts, key=lambda x: (-x[1], x[0]))
    best = None
    for i in range(1, k + 1):
        real, rest = ordered[:i], sum(n for _, n in ordered[i:])
        while len(real) < k:
            a, n = real[-1]
            real = sorted([*real[:-1], (a, n - n // 2), (a, n // 2)], key=lambda x: -x[1])
        score = sum(n * math.log((1 - noise) / k) - math.lgamma(n + 1) for _, n in real) + rest * math.log(noise) - math.lgamma(rest + 1)
        if best is None or score > best[0] + 1e-9:
            best = (score, real)
    return best[1]


def called(spark, cells, k):
    rows = [("amp", f"c{i}", "Reference", a, n) for i, counts in enumerate(cells) for a, n in counts]
    df = spark.createDataFrame(rows, "amplicon string, cell string, ref string, allele_key string, n long")
    out: dict[str, list] = {}
    for r in sorted(alleles.allele_call(df, CallParams(ploidy=k)).collect(), key=lambda r: (r["cell"], r["slot"])):
        out.setdefault(r["cell"], []).append((r["allele_key"], r["n"]))
    return [out[f"c{i}"] for i in range(len(cells))]


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_calls_match_the_plain_version(spark, k):
    r = random.Random(k)
    cells = [[(a, r.choice([1, 2, 5, 30, r.randint(1, 400)])) for a in r.sample("ABCDEF", r.randint(1, 6))] for _ in range(60)]
    assert called(spark, cells, k) == [call(c, k) for c in cells]


def test_known_diploid_calls(spark):
    hom = [True, False, True, False, False, False]
    cells = [[("A", a), ("B", b)] for a, b in ((30, 4), (30, 5), (100, 15), (10, 2), (5, 1), (1, 1))]
    assert [len({a for a, _ in c}) == 1 for c in called(spark, cells, 2)] == hom


def test_deep_noisy_cells_stay_heterozygous(spark):
    assert called(spark, [[("A", 200), ("B", 180), *[(f"n{i}", 1) for i in range(300)]]], 2)[0] == [("A", 200), ("B", 180)]


def test_log_factorial(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(n,) for n in (0, 1, 2, 10, 255, 256, 1000, 100_000)], "n long").select("n", alleles.log_factorial(F.col("n")).alias("lf")).collect()
    assert all(r["lf"] == pytest.approx(math.lgamma(r["n"] + 1), rel=1e-12, abs=1e-12) for r in rows)


def test_reads_without_annotation_count_as_neither(spark):
    reads = spark.createDataFrame([("a", "c", "Reference", "", "ACGT"), ("a", "c", "Reference", "DEL= INS= SUB=", "ACGT"), ("a", "d", "Reference", "", "AC"), ("a", " ", "Reference", "", "AC"),
                                   ("a", "c", "NA", "", "AC"), ("a", "c", "Reference&X", "", "AC")], "amplicon string, cell string, aln_ref string, ann string, seq string")
    got = {r["cell"]: (r["raw_reads"], r["raw_mod_pct"]) for r in alleles.raw_summary(alleles.usable_reads(reads)).collect()}
    assert got == {"c": (1, 0.0), "d": (0, None)}


def test_consensus_ties(spark):
    made = spark.createDataFrame([("a", "c", "Reference", 1, "k1", 2), ("a", "c", "Reference", 2, "k2", 4), ("b", "c", "Reference", 1, "k1", 2)], "amplicon string, cell string, ref string, slot int, allele_key string, n long")
    seqs = spark.createDataFrame([("a", "c", "k1", "TT", 1), ("a", "c", "k1", "GG", 1), ("a", "c", "k2", "TT", 2), ("a", "c", "k2", "CC", 2), ("b", "c", "k1", "TT", 1), ("b", "c", "k1", "GG", 1)],
                                 "amplicon string, cell string, allele_key string, seq string, n long")
    wild = spark.createDataFrame([("a", "WILD")], "amplicon string, wildtype string")
    got = {(r["amplicon"], r["slot"]): (r["sequence"], r["adjusted"]) for r in alleles.consensus_sequences(made, seqs, wild).collect()}
    assert got == {("a", 1): ("WILD", True), ("a", 2): ("CC", False), ("b", 1): ("GG", False)}
    headers = [r["header"] for r in alleles.allele_records(alleles.consensus_sequences(made, seqs, wild)).orderBy("amplicon", "slot").collect()]
    assert headers == ["@a:Adjusted:k1:c:1", "@a:k2:c:2", "@b:k1:c:1"]
