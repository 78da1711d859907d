"""Panels as large as those of the largest tables: nothing of them goes through the driver."""

from __future__ import annotations

import random

import pytest

from editloom.operators import lookups
from editloom.params import AssignParams

PANEL = "ordinal int, amplicon string, chr string, start int, end int"


def test_duplicate_locations_are_not_broadcast(spark):
    amplicons = spark.range(30).selectExpr("cast(id as int) AS ordinal", "concat('a', id) AS amplicon", "'chr1' AS chr", "cast(id div 3 * 100 as int) AS start", "cast(id div 3 * 100 + 64 as int) AS end")
    found = lookups.duplicate_locations(amplicons)
    assert found.count() == 30
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("window", [0, 1, 3])
def test_duplicate_locations_match_all_pairs(spark, window):
    """Also below zero, at one place, with null places and repeated names."""
    r = random.Random(window)
    rows = []
    for i in range(120):
        at = r.choice([None, *range(-40, 40)])
        rows.append((i, f"a{i % 100}", r.choice(["chr1", "chr2", None]), at, None if at is None else at + r.randint(1, 9)))
    want = {(b[1], a[1]) for a in rows for b in rows if a[0] < b[0] and None not in (a[2], a[3], b[3]) and a[2] == b[2] and (abs(b[3] - a[3]) <= window or abs(b[4] - 1 - a[4]) <= window)}
    got = [tuple(x) for x in lookups.duplicate_locations(spark.createDataFrame(rows, PANEL), AssignParams(window=window)).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
