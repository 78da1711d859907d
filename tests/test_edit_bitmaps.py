"""Edit patterns as bitmaps over the panel, against lists of names."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from editloom.operators import qc, summary


@pytest.fixture(scope="module")
def made(spark):
    """130 amplicons, 60 cells, few different sets; names whose order with commas differs from the order of places."""
    rng = random.Random(3)
    panel = [f"a{i}" + "!" * (i % 2) for i in range(130)]
    sets = [set(), {panel[0]}, {panel[0], panel[1]}, {panel[63], panel[64]}, {panel[129]}, set(panel), {panel[128], panel[5]}]
    edits = {f"c{i:02}": rng.choice(sets) for i in range(60)}
    rows = [(c, a, 50.0 if a in s else rng.choice([0.0, None])) for c, s in edits.items() for a in panel]
    rows += rows[:200] + [("c00", None, 9.0), ("other", panel[3], 80.0)]  # repeated entries, an entry without amplicon, a cell that is not selected
    dense = spark.createDataFrame(rows, "cell string, amplicon string, mod double").cache()
    quality = spark.createDataFrame([(c, "HQ_HI") for c in edits] + [("other", "LQ_LO")], "cell string, color string")
    return dense, quality, {c: ",".join(sorted(s)) for c, s in edits.items()}, {c: len(s) for c, s in edits.items()}


def test_counts_are_those_of_names(made):
    dense, quality, patterns, sites = made
    got = [tuple(r) for r in qc.edit_combinations(dense, quality).collect()]
    assert sorted(got) == sorted(Counter(patterns.values()).items())
    assert {r["cell"]: r["sites"] for r in qc.cell_bitmaps(dense, quality).collect()} == sites


@pytest.mark.parametrize("n", [1, 3, 5, 50])
def test_most_frequent(made, n):
    dense, quality, patterns, _ = made
    best = sorted(Counter(patterns.values()).items(), key=lambda x: (-x[1], x[0]))[:n]
    want = {c: p for c, p in patterns.items() if p in dict(best)}
    assert {r["cell"]: r["pattern"] for r in qc.top_edit_combinations(dense, quality, n).collect()} == want


def test_ties_are_settled_by_names(spark):
    sets = [["b"], ["a", "z"], ["a"], ["a!"], ["c", "a"], ["z"]]
    dense = spark.createDataFrame([(f"c{i}", a, 1.0) for i, s in enumerate(sets) for a in s], "cell string, amplicon string, mod double")
    quality = spark.createDataFrame([(f"c{i}", "HQ_HI") for i in range(6)], "cell string, color string")
    got = sorted(r["pattern"] for r in qc.top_edit_combinations(dense, quality, 3).collect())
    assert got == sorted(",".join(sorted(s)) for s in sets)[:3]
    assert qc.edit_combinations(dense.limit(0), quality).collect() == [] and qc.top_edit_combinations(dense.limit(0), quality).collect() == []


def test_twenty_thousand_amplicons_take_two_and_a_half_kilobytes(spark):
    dense = spark.sql("SELECT concat('c', c.id) AS cell, printf('amp%05d', a.id) AS amplicon, IF((a.id + c.id) % 3 = 0, 10.0D, 0.0D) AS mod FROM range(6) c JOIN range(20000) a")
    quality = spark.sql("SELECT concat('c', id) AS cell, 'HQ_HI' AS color FROM range(6)")
    found = qc.cell_bitmaps(dense, quality).selectExpr("cell", "8 * size(bitmap) AS bytes", "sites").collect()
    assert len(found) == 6 and all(r["bytes"] <= 2504 and r["sites"] in (6666, 6667) for r in found)
    names = qc.edit_combinations(dense, quality).collect()
    assert sorted(r["cells"] for r in names) == [2, 2, 2] and all(len(r["pattern"].split(",")) in (6666, 6667) for r in names)


def test_a_panel_beyond_the_bound_is_refused(spark, monkeypatch):
    monkeypatch.setattr(summary, "PANEL_LIMIT", 2)
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "amplicon string")
    with pytest.raises(Exception, match="more than 2"):
        summary.panel_array(names, names["amplicon"]).collect()
    assert summary.panel_array(names.where("amplicon < 'c'"), names["amplicon"]).first()[0] == ["a", "b"]
