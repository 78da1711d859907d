"""Keys, texts and fingerprints that a third of all rows have."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from editloom.llm import common, sharding, simhash
from editloom.llm.common import join_counted, written

from . import brute


def test_join_counted_sends_heavy_keys_by_broadcast_and_the_rest_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(common, "HEAVY", 10)
    keys = ["hot"] * 500 + ["warm"] * 160 + [f"k{i % 300}" for i in range(800)]
    rows = written(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i long"), "rows")
    values = written(rows.groupBy("k").agg(F.count("*").alias("n"), F.max("i").alias("last")), "values")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only what is marked is broadcast
    try:
        joined = join_counted(rows, values, "k", "n")
        plan = joined._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        assert values.where("n > 146").count() == 2 and joined.columns == ["k", "i", "last"]
        last = {k: i for i, k in enumerate(keys)}
        assert sorted(map(tuple, joined.collect())) == sorted((k, i, last[k]) for i, k in enumerate(keys))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("n", [0, 1, 5])
def test_join_counted_of_few_rows(spark, n):
    rows = written(spark.createDataFrame([("a", i) for i in range(n)], "k string, i long"), "rows")
    assert join_counted(rows, written(rows.groupBy("k").agg(F.count("*").alias("n")), "values"), "k", "n").count() == n


@pytest.mark.parametrize("heavy", [1000, 4])
def test_shards_with_a_hot_text_and_a_hot_key(spark, monkeypatch, heavy):
    monkeypatch.setattr(common, "HEAVY", heavy)
    r = random.Random(heavy)
    docs = [(i, "the same text") for i in range(200)] + [(77_777, f"text {i} " + "x" * r.randrange(90)) for i in range(200)] + [(1000 + i, f"other {i % 150}") for i in range(180)] + [(None, None)] * 20
    got = sharding.shard_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), 7).collect()
    assert Counter(x["doc_id"] for x in got) == Counter(k for k, _ in docs)
    shards = defaultdict(list)
    for x in got:
        shards[x["shard"]].append((x["slot"], 2**63 if x["doc_id"] is None else x["doc_id"], x["size"]))
    for found in shards.values():
        assert [s for s, _, _ in sorted(found)] == list(range(len(found)))
        assert [k for _, k, _ in sorted(found)] == sorted(k for _, k, _ in found)
    crcs = defaultdict(set)
    for x in got:
        crcs[x["text_crc32"], x["size"]].add(x["shard"])
    assert all(len(s) == 1 for s in crcs.values())
    assert sum(x["size"] for x in got) == sum(len(t or "") + 1 for _, t in docs)


@pytest.mark.parametrize("heavy", [1000, 3])
def test_simhash_with_a_hot_fingerprint(spark, monkeypatch, heavy):
    monkeypatch.setattr(common, "HEAVY", heavy)
    r = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    base = r.choices(words, k=300)
    docs = [(3 * i, "one and the same text of some words") for i in range(100)] + [(3 * i + 1, None) for i in range(60)]
    for i in range(60):
        own = list(base)
        own[r.randrange(300)] = "changed"
        docs += [(3 * i + 2, " ".join(own)), (1000 + i, " ".join(r.choices(words, k=30)))]
    got = {x["doc_id"]: x for x in simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    keys, texts = sorted(got), dict(docs)
    assert len(got) == len(docs)
    prints = [brute.simhash(texts[k]) for k in keys]
    assert [got[k]["fp"] for k in keys] == [simhash.signed(f) for f in prints]
    assert [got[k]["component_id"] for k in keys] == brute.components(keys, prints)
