"""Sinks of both mates, counters and SAM splits that do not grow faster than their input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from editloom.plans import file_queries, read_queries  # noqa: F401  (they register their queries)
from editloom.plans.registry import QUERIES
from editloom.sources import fastq, sam, sinks

SF = "/root/testdata/sf0.001"


def test_spoiled_mates_have_the_same_files_where_partitions_are_coalesced(spark):
    """Two writes of differently wide rows were coalesced to different numbers of files."""
    confs = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "60k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.shuffle.partitions": "64"}  # partitions as small as those of a large table are beside the defaults
    before = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        found = {r["check"]: r for r in QUERIES["assert_inputs"](spark, SF).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["total"] for r in found.values()} == {6000} and all(r["failed"] for r in found.values())


@pytest.mark.parametrize("compress", [True, False])
def test_mates_are_written_in_one_pass_and_lanes_are_cut(spark, tmp_path, compress):
    pairs = spark.range(0, 2500, 1, 3).selectExpr("concat('r', id % 900) AS name", "repeat('A', cast(id % 7 AS int)) AS seq1", "repeat('I', cast(id % 7 AS int)) AS qual1", "cast(id AS string) AS seq2", "cast(id AS string) AS qual2")
    path = f"file://{tmp_path}/x"
    sinks.write_mates(pairs, sinks.fastq_line("name", "seq1", "qual1"), sinks.fastq_line("name", "seq2", "qual2"), path, compress, lane_pairs=400)
    r1, r2 = sinks.mates_of(spark, path)
    assert len(r1) == len(r2) == 9  # three partitions, cut after 400
    read = fastq.read_pairs(spark, r1, r2).drop("lane", "ordinal")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, pairs.collect()))


@pytest.mark.parametrize("name", ["parse_funnel", "merge_metrics", "filter_min_length", "parse_funnel_pct"])
def test_counters_take_no_sequences_through_joins(spark, name):
    df = QUERIES[name](spark, SF)
    joins = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    upper = joins[: next(i for i, x in enumerate(joins) if "Join LeftOuter" in x)]
    assert not any("TGTCTCTTATACACATCT" in x or "substring(seq1" in x for x in upper)


def test_small_splits_share_tasks(spark, tmp_path):
    (tmp_path / "x.sam").write_text("".join(f"n{i:05d}\t{f}\tchr1\t5\t40\t4M\t*\t0\t0\tACGT\tIIII\n" for i in range(2000) for f in (64, 128)))
    pairs, odd = sam.name_sorted_pairs(spark, f"file://{tmp_path}/x.sam", split_bytes=500)
    assert pairs.count() == 2000 and odd.count() == 0
    assert pairs.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert pairs.agg(F.count_distinct("qname")).first()[0] == 2000
