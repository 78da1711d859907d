"""Metrics of lanes are merged whole: counters and reads of each cell."""

from __future__ import annotations

import duckdb

from editloom.operators import demux
from editloom.plans import read_queries  # noqa: F401  (it registers its queries)
from editloom.plans.registry import ORACLES, QUERIES

FLAGGED = "lane string, cell string, has_c1 boolean, has_c2 boolean, valid boolean, corrected boolean, long_enough boolean, clean boolean"
COUNTERS = ("total", "constant1", "constant2", "valid_barcode", "error_corrected", "long_enough", "no_adapter")


def test_cells_of_two_lanes_are_added_up(spark):
    yes, no = (True,) * 3, (False,) * 3
    rows = [("a", "AC", *yes, False, True, True), ("a", "AC", *yes, True, True, True), ("b", "AC", *yes, False, True, True), ("b", "GT", *yes, True, True, True),
            ("a", "GT", *yes, False, True, False), ("a", "CC", *yes, False, False, False), ("b", None, True, False, False, None, False, False), ("b", "AC", *no, False, False, False)]
    found = demux.merge_metrics(demux.lane_metrics(spark.createDataFrame(rows, FLAGGED), "lane"))
    want = [*zip(COUNTERS, [None] * 7, (8, 7, 6, 6, 2, 5, 4), strict=True), ("reads_per_cell", "AC", 3), ("reads_per_cell", "GT", 1)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_no_pairs_give_counters_of_zero(spark):
    found = demux.merge_metrics(demux.lane_metrics(spark.createDataFrame([], FLAGGED), "lane"))
    assert sorted(map(tuple, found.collect())) == sorted((c, None, 0) for c in COUNTERS)


def test_query_matches_sql(spark):
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("part", "orders", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(ORACLES["merge_metrics"])
    got = QUERIES["merge_metrics"](spark, sf)
    assert got.columns == want.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))
    assert got.where("metric = 'reads_per_cell'").count() > 7
