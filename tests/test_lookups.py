"""The closed form of conflict resolution against a step-by-step simulation, and lookups of small whitelists."""

from __future__ import annotations

import random

from editloom.operators import lookups
from editloom.params import AssignParams


def simulate(entries):
    held, barred = {}, set()
    for _, key, value, kind in sorted(entries):
        if kind == "E":
            held[key] = value
        elif key in barred:
            continue
        elif key in held:
            barred.add(key)
            del held[key]
        else:
            held[key] = value
    return held


def test_conflicts_match_a_simulation(spark):
    r = random.Random(5)
    cases, rows = [], []
    for case in range(150):
        entries = [(i, f"{case}:{r.choice('abc')}", r.choice("xyz"), r.choice("EVV")) for i in range(r.randint(1, 9))]
        cases.append(entries)
        rows += [(case * 100 + o, k, v, kind) for o, k, v, kind in entries]
    got = {r["key"]: r["value"] for r in lookups.resolve(spark.createDataFrame(rows, "ord long, key string, value string, kind string")).collect()}
    assert got == {k: v for entries in cases for k, v in simulate(entries).items()}


def test_exact_barcode_can_vanish(spark):
    found = lookups.barcode_lookup(spark.createDataFrame([(0, "AAAA"), (1, "AAAC")], "ordinal int, barcode string"))
    got = {r["key"]: r["value"] for r in found.collect()}
    assert "AAAA" not in got and got["AAAC"] == "AAAC" and got["CAAA"] == "AAAA" and "AAAG" not in got


def test_without_mismatches(spark):
    table = spark.createDataFrame([(0, "AAAA"), (1, "AAAC")], "ordinal int, barcode string")
    assert sorted(r["key"] for r in lookups.barcode_lookup(table, False).collect()) == ["AAAA", "AAAC"]


def test_primer_variants(spark):
    amplicons = spark.createDataFrame([(0, "one", "ACGTACGTTTTTGGGGCC")], "ordinal int, amplicon string, sequence string")
    got = {r["key"] for r in lookups.primer_lookup(amplicons, AssignParams(primer_length=6)).collect()}
    assert {"ACGTAC", "GTACGT", "GGGGCC", "GGCCCC", "NCGTAC", "CACGTA", "CGTACA"} <= got


def test_later_amplicons_overwrite_windows(spark):
    amplicons = spark.createDataFrame([(0, "a", "chr1", 100, 200), (1, "b", "chr1", 104, 300)], "ordinal int, amplicon string, chr string, start int, end int")
    at = {(r["side"], r["pos"]): r["amplicon"] for r in lookups.position_windows(amplicons).collect()}
    assert at[(1, 100)] == "a" and at[(1, 101)] == "b" and at[(1, 107)] == "b" and at[(2, 203)] == "a" and (1, 108) not in at
    assert [tuple(r) for r in lookups.duplicate_locations(amplicons).collect()] == []


def test_entries_of_one_split_are_made_by_many_tasks(spark):
    """A small file of names is one split; its variants, hundreds for each row, are not made by one task."""
    amplicons = spark.createDataFrame([(i, f"a{i}", "ACGT" * 8) for i in range(50)], "ordinal int, amplicon string, sequence string").coalesce(1)
    assert lookups.primer_entries(amplicons).rdd.getNumPartitions() == 4
    assert lookups.barcode_entries(amplicons.selectExpr("ordinal", "sequence AS barcode")).rdd.getNumPartitions() == 4


def test_repeated_names_and_counts_match_a_simulation(spark):
    """Barcodes that come many times: the first two and the last decide; counts take all of them."""
    r = random.Random(3)
    barcodes = spark.createDataFrame([(i, "".join(r.choices("AC", k=3))) for i in range(60)], "ordinal int, barcode string")
    assert lookups._least_repeats(lookups._named_barcodes(barcodes)).count() <= 3 * 8
    rows = [tuple(x) for x in lookups.barcode_entries(barcodes).select("ord", "key", "value", "kind").collect()]
    held, barred, added, clashes = {}, set(), 0, 0
    for _, key, value, kind in sorted(rows):
        if kind == "E":
            held[key] = value
        elif key in barred:
            clashes += 1
        elif key in held:
            barred.add(key)
            del held[key]
            clashes += 2
        else:
            held[key], added = value, added + 1
    assert {x["key"]: x["value"] for x in lookups.barcode_lookup(barcodes).collect()} == held
    assert tuple(lookups.lookup_counts(lookups.barcode_entries(barcodes)).first()) == (60, added, clashes, len(held))
    keys = barcodes.selectExpr("barcode AS key").distinct()
    assert {x["key"]: x["value"] for x in lookups.barcode_lookup_of(keys, barcodes).collect()} == {k: v for k, v in held.items() if set(k) <= set("AC")}
