"""Entries found by seeds against whole lookups, and what the final plans broadcast."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from editloom.operators import assign, lookups
from editloom.params import AssignParams
from editloom.plans import read_queries  # noqa: F401  (registers its queries)
from editloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def as_set(df):
    return sorted(tuple(r) for r in df.select("ord", "key", "value", "kind").collect())


@pytest.mark.parametrize("k", [1, 2, 3, 5, 7])
def test_entries_of_keys_are_all_entries_of_those_keys(spark, k):
    """Few letters, short primers and repeats: shifts meet substitutions and exact keys."""
    r = random.Random(k)
    amplicons = spark.createDataFrame([(i, f"amp{i % 11}", "".join(r.choices("ACAAX", k=r.randrange(1, 2 * k + 3)))) for i in range(25)], "ordinal int, amplicon string, sequence string")
    params = AssignParams(primer_length=k)
    whole = lookups.primer_entries(amplicons, params)
    keys = whole.select("key").union(spark.createDataFrame([("".join(r.choices("ACGTNX", k=r.randrange(0, k + 2))),) for _ in range(200)] + [(None,)], "key string")).distinct().where("crc32(key) % 4 > 0 OR key IS NULL")
    assert as_set(lookups.entries_of_keys(keys, lookups.primer_ends(amplicons, k).select(((F.col("ordinal").cast("long") * 4 + F.col("end_no")) * 10_000).alias("base"), F.col("primer").alias("name_key"), F.col("amplicon").alias("value")), True, True)) == as_set(whole.join(keys, "key"))
    assert sorted(map(tuple, lookups.primer_lookup_of(keys, amplicons, params).collect())) == sorted(map(tuple, lookups.primer_lookup(amplicons, params).join(keys, "key").collect()))


def test_barcodes_of_keys(spark):
    r = random.Random(9)
    barcodes = spark.createDataFrame([(i, "".join(r.choices("ACGT", k=r.choice([4, 4, 9])))) for i in range(120)] + [(200, ""), (201, "A")], "ordinal int, barcode string")
    for mismatches in (True, False):
        whole = lookups.barcode_lookup(barcodes, mismatches)
        keys = whole.select("key").union(barcodes.select("barcode")).union(spark.createDataFrame([("ACGTX",), ("",), ("NNNN",)], "key string")).distinct()
        assert sorted(map(tuple, lookups.barcode_lookup_of(keys, barcodes, mismatches).collect())) == sorted(map(tuple, whole.collect()))


def test_calls_of_empty_tables(spark):
    pairs = spark.createDataFrame([("q", "ACGT", None, "chr1", 5, None, None)], "qname string, primer1 string, primer2 string, chr1 string, pos1 int, chr2 string, pos2 int")
    amplicons = spark.createDataFrame([(0, "a", "ACGTTTTT", "chr1", 4, 40)], "ordinal int, amplicon string, sequence string, chr string, start int, end int")
    params = AssignParams(primer_length=4)
    assert [r.asDict()["amp1"] for r in assign.calls(pairs, amplicons, params).collect()] == ["a"]
    assert assign.calls(pairs.limit(0), amplicons, params).collect() == []
    assert assign.calls(pairs, amplicons.limit(0), params).first()["amp1"] is None


def broadcasts(df):
    """Rows of each broadcast of the plan that ran in the end."""
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "BroadcastExchangeExec":
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found


@pytest.mark.parametrize("name", ["primer_calls", "assign_strict", "correct_barcodes"])
def test_no_lookup_is_broadcast_beyond_the_threshold(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in ("64k", "10m"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            df = QUERIES[name](spark, SF)
            df.collect()
            bound = 1 << 16 if threshold == "64k" else 10 << 20
            assert all(56 * rows <= bound for rows in broadcasts(df))  # a row of two short strings takes 56 bytes
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
