"""Panels whose places are beyond int: positions are bigint there, int where the SQL's casts hold."""

from __future__ import annotations

import re

import duckdb
import pytest

from editloom.plans import file_queries, read_queries  # noqa: F401  (they register their queries)
from editloom.plans.registry import ORACLES, QUERIES

SF, SHIFT = "/root/testdata/sf0.001", 3_000_000
KEYS = {"part": "p_partkey", "lineitem": "l_partkey", "orders": None}
#: The casts of positions in the SQL of the derived tables.
CAST = re.compile(r"(1000\*\(\w+\+\d\)(?:[+-]\d+)?(?: end)?|start_pos \+ 7) as int\)")


@pytest.fixture(scope="module")
def far(tmp_path_factory):
    """sf0.001 with parts numbered from 3,000,000 on."""
    path = tmp_path_factory.mktemp("far")
    for t, key in KEYS.items():
        columns = f"* REPLACE ({key} + {SHIFT} AS {key})" if key else "*"
        duckdb.sql(f"COPY (SELECT {columns} FROM '{SF}/{t}.parquet') TO '{path}/{t}.parquet'")
    return path


def sql_rows(path, sql):
    con = duckdb.connect()
    for t in KEYS:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    found = con.sql(sql)
    return found.columns, found.fetchall()


def ordered(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["position_windows", "amplicon_locations", "scan_amplicon_info", "scan_amplicon_alignments", "scan_sam_pairs", "scan_sam_sorted_pairs", "sam_unpaired_names", "reads_per_amplicon", "reject_reason_strict", "write_split_reports",
                                  "write_reads_by_amplicon", "split_totals_observed"])
def test_places_beyond_int(spark, far, name):
    wide, n = CAST.subn(r"\1 as bigint)", ORACLES[name])
    assert n
    columns, want = sql_rows(far, wide.replace("CAST(pos AS INT)", "pos"))
    got = QUERIES[name](spark, f"file://{far}")
    assert ordered(got.columns, map(tuple, got.collect())) == ordered(columns, want)


def test_the_sql_has_no_rows_there_and_keeps_int_elsewhere(spark, far):
    with pytest.raises(duckdb.ConversionException):
        sql_rows(far, ORACLES["position_windows"])
    assert dict(QUERIES["position_windows"](spark, SF).dtypes)["pos"] == "int"
    assert dict(QUERIES["scan_sam_pairs"](spark, SF).dtypes)["pos"] == "int"
    assert dict(QUERIES["position_windows"](spark, f"file://{far}").dtypes)["pos"] == "bigint"
