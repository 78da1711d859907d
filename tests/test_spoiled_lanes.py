"""The lanes that assert_inputs checks are compressed, and all of their records are checked."""

from __future__ import annotations

import duckdb

from editloom.plans import file_queries
from editloom.plans.registry import ORACLES, QUERIES
from editloom.sources import sinks

SF = "/root/testdata/sf0.001"


def test_spoiled_lanes_are_compressed(spark, monkeypatch, tmp_path):
    paths = []
    monkeypatch.setattr(file_queries, "path_of", lambda t, purpose: paths.append(f"file://{tmp_path}/{purpose}") or paths[-1])
    got = QUERIES["assert_inputs"](spark, SF)
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLES["assert_inputs"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
    one, two = sinks.mates_of(spark, paths[0])
    assert one and len(one) == len(two) and all(f.endswith(".gz") for f in one + two)
