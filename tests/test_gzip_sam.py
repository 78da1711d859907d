"""SAM text is compressed where queries write it, and compressed name-sorted text is paired as plain text is."""

from __future__ import annotations

import gzip

import duckdb
import pytest

from editloom.plans import file_queries  # noqa: F401  (it registers its queries)
from editloom.plans.fixtures import Fixtures
from editloom.plans.registry import ORACLES, QUERIES
from editloom.sources import sam, sinks

from .test_sam_pairs import LINES, ODD, PAIRS, line, read

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_gzip_files_are_paired(spark, tmp_path, end):
    """Larger than a split, of two streams, with an empty line that ends it."""
    cut = len(LINES) // 2
    parts = [end.join(x) + end for x in (LINES[:cut], LINES[cut:])]
    (tmp_path / "x.sam.gz").write_bytes(b"".join(gzip.compress(x.encode()) for x in (*parts, "\n" + line("after", 64) + end + line("after", 128) + end)))
    assert read(spark, tmp_path / "x.sam.gz", 20)[:2] == (PAIRS, ODD)
    (tmp_path / "empty.gz").write_bytes(gzip.compress(b""))
    assert read(spark, tmp_path / "empty.gz", 20)[:2] == ([], [])


def test_a_cut_gzip_file_is_refused(spark, tmp_path):
    (tmp_path / "x.gz").write_bytes(gzip.compress("\n".join(LINES).encode())[:-12])
    with pytest.raises(Exception, match="ends within a gzip stream"):
        sam.name_sorted_pairs(spark, f"file://{tmp_path}/x.gz")[0].collect()


def test_alignments_by_name_are_the_alignments(spark):
    t = Fixtures(spark, SF)
    rows, sorted_rows = t.table("alignments"), t.alignments_by_name()
    assert rows.dtypes == sorted_rows.dtypes
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, sorted_rows.collect()))
    plan = sorted_rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ampA") < plan.index("Exchange hashpartitioning(h")  # sequences are derived above the shuffle


@pytest.mark.parametrize("name", ["scan_sam_sorted_pairs", "sam_unpaired_names", "scan_sam_pairs"])
def test_queries_write_compressed_text_and_match_sql(spark, monkeypatch, tmp_path, name):
    paths = []
    monkeypatch.setattr(file_queries, "path_of", lambda t, purpose: paths.append(f"file://{tmp_path}/{purpose}") or paths[-1])
    got = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
    files = sinks.files_of(spark, paths[0])
    assert files and all(f.endswith(".gz") for f in files)
