"""Calls of pairs against plain lookups, and how often pairs are shuffled for them."""

from __future__ import annotations

import random

import pytest

from editloom.operators import assign, lookups
from editloom.params import AssignParams
from editloom.plans import read_queries  # noqa: F401  (registers its queries)
from editloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
AMPLICON = "ordinal int, amplicon string, sequence string, chr string, start int, end int"
PAIR = "qname string, primer1 string, primer2 string, chr1 string, pos1 int, chr2 string, pos2 int"


def by_name(rows):
    return sorted(((r["qname"], *[r[c] for c in assign.CALLS]) for r in rows), key=repr)


def plain(spark, pairs, amplicons, params):
    """The calls by dictionaries of the whole lookups; null equals nothing."""
    primers = {r["key"]: r["value"] for r in lookups.primer_lookup(amplicons, params).collect()}
    at = {(r["side"], r["chr"], r["pos"]): r["amplicon"] for r in lookups.position_windows(amplicons, params).collect() if r["chr"] is not None and r["pos"] is not None}
    return sorted(((p["qname"], primers.get(p["primer1"]), primers.get(p["primer2"]), at.get((1, p["chr1"], p["pos1"])), at.get((2, p["chr2"], p["pos2"]))) for p in pairs.collect()), key=repr)


@pytest.mark.parametrize("spread", [12, 300, 5_000, 60_000])
@pytest.mark.parametrize("star", [False, True])
def test_calls_are_those_of_whole_lookups(spark, spread, star):
    """Amplicons that share places, overlap, or stand alone; below 0 too; pairs of one amplicon, of two and of none; names that repeat; nulls."""
    r = random.Random(spread)
    k, params = 6, AssignParams(primer_length=6)
    rows = []
    for i in range(40):
        start = r.choice([r.randrange(-spread, spread), rows[-1][4] if rows and rows[-1][4] is not None else 0, None if i % 13 == 12 else 7])
        rows.append((i, f"amp{i % 37}", "".join(r.choices("ACGT", k=20)), r.choice(["chr1", "chr1", "chr2", "*" if star else "chr3", None if i % 11 == 10 else "chr1"]), start, None if start is None else start + r.choice([20, 21, 30])))
    amplicons = spark.createDataFrame(rows, AMPLICON)

    def primer(s):
        kind = r.randrange(8)
        return None if kind == 0 else "".join(r.choices("ACGTN", k=k)) if kind == 1 else "N" + s[1:] if kind == 2 else s[1:] + "A" if kind == 3 else s

    def place(a, pos):
        other = r.choice(rows)
        return r.choice([(a[3], pos), (a[3], pos), (other[3], other[4]), ("*", -1), (None, pos), (a[3], None), ("chr1", r.randrange(-spread, spread))]) if pos is not None else ("*", -1)

    pairs = []
    for i in range(1_500):
        a, b = r.choice(rows), r.choice(rows)
        b = a if r.random() < .8 else b
        shift = r.choice([0, 3, -3, 4, -4, r.randrange(-1_100, 1_100)])
        pairs.append((f"q{i % 1_400}", primer(a[2][:k]), primer(b[2][-k:]), *place(a, None if a[4] is None else a[4] + shift), *place(b, None if b[5] is None else b[5] - shift)))
    pairs = spark.createDataFrame(pairs, PAIR)
    called = assign.calls(pairs, amplicons, params)
    assert called.columns == [*pairs.columns, *assign.CALLS]
    assert by_name(called.collect()) == plain(spark, pairs, amplicons, params)


def test_rooms(spark):
    at = {0: 100, 1: 100, 2: 400, 3: 8_192, 4: 8_190, 5: -3, 6: 50_000, 7: 51_023}
    amplicons = spark.createDataFrame([(i, f"a{i}", "ACGT", "c", p, None) for i, p in at.items()], AMPLICON)
    rooms = {r["ordinal"]: r["room1"] for r in lookups.rooms(amplicons).collect()}
    assert rooms == {2: 300, 3: 2, 4: 2, 5: 103, 6: 1_023, 7: 1_023}  # 0 and 1 share their place
    assert [tuple(x) for x in lookups.rooms(amplicons.where("ordinal = 2")).collect()] == [(2, lookups.REACH, None)]


def shuffled(df, column):
    """Rows written by the shuffles of that column in the plan that ran in the end, each shuffle once."""
    plan, found = df._jdf.queryExecution().executedPlan(), {}

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ReusedExchangeExec":
            return None
        output = [node.output().apply(i).name() for i in range(node.output().size())]
        if name == "ShuffleExchangeExec" and column in output:
            found[node.id()] = node.metrics().apply("shuffleRecordsWritten").value()
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return sum(found.values())


@pytest.mark.parametrize("name", ["assign_strict", "candidate_set", "reject_reason_permissive"])
def test_pairs_are_shuffled_about_once(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
        df = QUERIES[name](spark, SF)
        pairs = len(df.collect())
        assert pairs <= shuffled(df, "qname") <= 1.5 * pairs
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
