"""Registered queries against their SQL, and the guard around the removable subpackage."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from editloom.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
#: One query for each step of the pipeline; the driver runs all of them.
CHOSEN = ["parse_funnel", "tag_reads", "lookup_counts", "primer_lookup", "duplicate_locations", "orient_pairs", "call_combination_counts", "split_totals", "reject_reason_permissive", "allele_call", "cell_amplicon_summary",
          "consensus_sequence", "densify_cell_amplicon", "quality_class", "mean_mod_by_depth", "amplicons_per_cell_at_depth", "layer_table", "scan_fastq_pairs", "scan_annotated_reads", "write_matrices"]


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(v[i] for i in order) for v in values), key=repr)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(entry.__file__).parent
    others = [p for p in root.glob("editloom/**/*.py") if "llm" not in p.parts]
    assert others and not [p for p in others if "llm" in p.read_text()]


def test_classes_partition_cells_and_amplicons_add_up(spark):
    cells = QUERIES["quality_class"](spark, SF).count()
    assert sum(r["cells"] for r in QUERIES["quality_class_counts"](spark, SF).collect()) == cells
    totals = QUERIES["split_totals"](spark, SF).first()
    assert sum(r["reads"] for r in QUERIES["reads_per_amplicon"](spark, SF).collect()) == totals["identified"]
    assert totals["total"] == totals["identified"] + totals["chimeric"] + totals["other_location"] + totals["unidentified"]
    funnel = list(QUERIES["parse_funnel"](spark, SF).first().asDict().values())
    assert funnel[0] >= funnel[1] >= funnel[2] >= funnel[3] >= funnel[5] >= funnel[6]


def test_depth_gate_takes_all_usable_amplicons(spark):
    """The gate is 3 reads at every usable amplicon of the panel, the one without reads included."""
    from editloom.plans.fixtures import Fixtures
    from editloom.plans import cell_queries as cq

    rows = cq.dense(Fixtures(spark, "/root/testdata/sf0.001")).where("raw_tot IS NOT NULL").collect()
    least = {}
    for r in rows:
        least[r["cell"]] = min(r["raw_tot"], least.get(r["cell"], r["raw_tot"]))
    assert cq.depth_gate_count(Fixtures(spark, "/root/testdata/sf0.001")).first()["failing_cells"] == sum(n < 3 for n in least.values()) > 0
    assert "amplicon <>" not in ORACLES["depth_gate_count"]
