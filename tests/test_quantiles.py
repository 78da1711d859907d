"""Exact quantiles by rank, against a sort in memory."""

from __future__ import annotations

import math
import random

import pytest

from editloom.operators.quantiles import quantiles

SHARES = [0.0, 0.25, 0.5, 0.975, 0.9999, 1.0]


def brute(values):
    values = sorted(values)
    found = []
    for s in SHARES:
        p = (len(values) - 1) * s
        low, high = values[math.floor(p)], values[math.ceil(p)]
        found.append(low if low == high else (math.ceil(p) - p) * low + (p - math.floor(p)) * high)
    return found


def test_equals_a_sort(spark):
    rng = random.Random(5)
    rows = [("hot", float(int(rng.expovariate(0.01)))) for _ in range(4000)]
    rows += [("signs", rng.uniform(-3, 3)) for _ in range(500)] + [("wide", rng.choice([-1, 1]) * 10.0 ** rng.randint(0, 15)) for _ in range(300)]
    rows += [("same", 7.0)] * 50 + [("one", -2.5), ("nulls", None), (None, 4.0), (None, 8.0), ("some", None), ("some", 0.0)]
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    table = spark.createDataFrame(rows, "_n string, `_v.x` double")  # names as the operator has them inside
    got = {r["_n"]: (r["quantiles"], r["n"]) for r in quantiles(table, ["_n"], "_v.x", SHARES).collect()}
    assert got == {k: (brute(v), len(v)) for k, v in groups.items()}


def test_no_keys_two_keys_and_no_rows(spark):
    table = spark.createDataFrame([(i % 2, i % 3, i) for i in range(60)], "a int, b int, v long")
    whole = quantiles(table, [], "v", SHARES).collect()
    assert [(r["quantiles"], r["n"]) for r in whole] == [(brute([float(i) for i in range(60)]), 60)]
    got = {(r["a"], r["b"]): r["quantiles"] for r in quantiles(table, ["a", "b"], "v", SHARES).collect()}
    assert got == {(a, b): brute([float(i) for i in range(60) if i % 2 == a and i % 3 == b]) for a in range(2) for b in range(3)}
    none = table.where("v < 0")
    assert quantiles(none, ["a"], "v", SHARES).collect() == [] and [r["n"] for r in quantiles(none, [], "v", SHARES).collect()] == [None]


@pytest.mark.parametrize("shares", [[0.5], [0.1, 0.9]])
def test_rows_are_read_once_and_held_by_no_aggregate(spark, tmp_path, shares):
    spark.range(20000).selectExpr("id % 3 AS k", "id * 7 % 1009 AS v").write.parquet(str(tmp_path / "t"))
    found = quantiles(spark.read.parquet(str(tmp_path / "t")), ["k"], "v", shares)
    assert found.count() == 3
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_" not in plan
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]
