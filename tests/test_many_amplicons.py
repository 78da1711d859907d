"""Large panels and many reads: files follow the rows, not the amplicons; sorts and derived tables cost no more than they must."""

from __future__ import annotations

import math
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from editloom.operators import alleles, lookups
from editloom.plans import cell_queries, file_queries, read_queries  # noqa: F401  (they register their queries)
from editloom.plans.fixtures import Fixtures
from editloom.plans.registry import QUERIES
from editloom.sources import sinks

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("folders", [7, 1000])
def test_folders_do_not_grow_with_the_panel(spark, tmp_path, folders):
    calls = [f"amplicon AS {c}" for c in ("amp1", "amp2", "amp1_aln", "amp2_aln")]
    rows = spark.range(3000).selectExpr("concat('q', id) AS qname", "concat('C', id % 5) AS cell", "if(id % 10 = 0, NULL, concat('a', id % 300)) AS amplicon").selectExpr(
        "*", *calls, "false AS rescued", "'chr1' AS chr1", "'chr1' AS chr2").localCheckpoint()
    counts = sinks.write_reads_by_amplicon(rows, f"file://{tmp_path}/x", folders=folders)
    assert counts["total"] == counts["aligned"] == 3000 and counts["identified"] == 2700 and counts["unidentified"] == 300
    read = spark.read.parquet(f"file://{tmp_path}/x")
    assert sorted(map(tuple, read.select("qname", "cell", "amplicon", "amp2").collect())) == sorted(
        map(tuple, rows.selectExpr("qname", "cell", "coalesce(amplicon, 'unidentified')", "amp2").collect()))
    made = {p.parent.name for p in Path(tmp_path / "x").glob("*/*.parquet")}
    assert len(made) == (271 if folders == 1000 else 8) and any(m.endswith("=unidentified") for m in made)
    where = {}
    for r in read.selectExpr("amplicon", "_metadata.file_path AS f").distinct().collect():
        where.setdefault(r["amplicon"], set()).add(r["f"])
    assert all(len(f) == 1 for f in where.values())  # an amplicon's pairs are in one file


@pytest.mark.parametrize("name", ["primer_calls", "position_calls"])
def test_sorts_of_lookups_begin_with_what_tells_rows_apart(spark, name):
    """Sorting compares a prefix of the first column: the kind of a seed or a chromosome is the same in most rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    first = set(re.findall(r"Sort \[([a-z]+\d?)#", plan))
    assert first and not first & {"kind", "side", "chr", "chr1", "chr2"}


def test_reads_are_derived_once_for_alleles_and_classes(spark):
    t = Fixtures(spark, SF)
    plan = cell_queries.alleles_of_good_cells(t)._jdf.queryExecution().optimizedPlan().toString()
    assert {"annotated_reads", "good-cells"} <= set(t._stages) and "lineitem.parquet" not in plan and "l_orderkey" not in plan
    lines = plan.split("\n")
    semi = next(i for i, x in enumerate(lines) if "Join LeftSemi" in x)
    assert any("Aggregate" in x for x in lines[:semi])  # cells are selected before their alleles are called


def test_consensus_is_called_once_by_its_sink(spark):
    t = Fixtures(spark, SF)
    file_queries.write_consensus_alleles(t)
    assert "consensus-records" in t._stages


def test_factorials_are_those_of_the_sum(spark):
    got = spark.range(300).select("id", alleles.log_factorial(F.col("id")).alias("x")).collect()
    assert all(abs(r["x"] - math.lgamma(r["id"] + 1)) < 1e-11 * max(1, r["x"]) for r in got)
    assert spark.range(1).select(alleles.log_factorial(F.lit(-1)).alias("x")).first()["x"] == 0
    assert "aggregate(" not in spark.range(5).select(alleles.log_factorial(F.col("id")))._jdf.queryExecution().optimizedPlan().toString()


def test_whole_pairs_are_not_shuffled_for_a_small_lookup(spark):
    """The lookup of barcodes is a table before pairs are joined, so Spark broadcasts it before it shuffles sequences twice."""
    plan = QUERIES["tag_reads"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_repeated_barcodes_have_seeds_once(spark):
    barcodes = spark.range(40).selectExpr("CAST(id AS INT) AS ordinal", "element_at(array('AAAA', 'AAAC', 'GGTT', 'GGTA'), 1 + CAST(id % 4 AS INT)) AS barcode")
    named = lookups._repeats_in_one(lookups._named_barcodes(barcodes))
    assert sorted((r["name_key"], tuple(b // 10_000 for b in r["bases"])) for r in named.collect()) == [("AAAA", (0, 4, 36)), ("AAAC", (1, 5, 37)), ("GGTA", (3, 7, 39)), ("GGTT", (2, 6, 38))]
    whole = lookups.barcode_lookup(barcodes)
    keys = lookups.barcode_entries(barcodes).select("key").distinct()
    assert sorted(map(tuple, lookups.barcode_lookup_of(keys, barcodes).collect())) == sorted(map(tuple, whole.collect()))
