"""The mix against a plain schedule: every slot one after the other."""

from __future__ import annotations

from collections import defaultdict
from math import floor

import pytest
from xxhash import xxh64_intdigest

from editloom.llm import mixing

from . import brute


def order_of(key, size, seed=42):
    h = xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    for v in (key, size):
        h = xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), h)
    return h - 2**64 if h >= 2**63 else h, key, size


def plain_mix(docs, slots):
    """{key: words taken} for docs (key, source, text)."""
    by_source: dict = defaultdict(list)
    for key, source, text in docs:
        by_source[source].append((key, len(brute.WORD.findall((text or "").encode()))))
    sizes = {s: sum(n for _, n in found) for s, found in by_source.items()}
    goal = mixing.targets(sizes, mixing.cycling_weights(list(sizes)))
    per_block = max(1.0, sum(sizes.values()) / slots)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    lengths, blocks, bounds, upto = [], [], [], 0.0
    for s in names:
        n = sizes[s]
        lengths.append(max(1, -(-n // max(1, min(n, max(mixing.LEAST_BLOCKS, round(n / per_block)))))))
        blocks.append(max(1, -(-n // lengths[-1])))
        upto += goal[s] / (n / blocks[-1]) if n else 0.0
        bounds.append(upto)
    rank, times = [0] * len(names), [defaultdict(int) for _ in names]
    for i in range(round(upto)):
        point = (i + 0.5) * mixing.GOLDEN
        at = (point - floor(point)) * upto
        s = min(sum(b <= at for b in bounds), len(names) - 1)
        epoch, block = divmod(rank[s], blocks[s])
        rank[s] += 1
        times[s][block] += epoch < mixing.REPEATS
    taken = {}
    for s, name in enumerate(names):
        start = 0
        for key, n in sorted(by_source[name], key=lambda d: order_of(*d)):
            taken[key] = sum(times[s][w // lengths[s]] for w in range(start, start + n))
            start += n
    return taken


SOURCES = ["a", "b", None, "é", "Z"]
DOCS = [(i, SOURCES[min(4, i * i % 7)], "w " * (i * 37 % 90) if i % 11 else None) for i in range(300)] + [(1000, "huge", "x " * 5000), (1001, "none", "")]


@pytest.mark.parametrize("slots", [100, 1 << 18])
def test_taken_words_are_those_of_the_plain_schedule(spark, slots):
    df = spark.createDataFrame(DOCS, "doc_id long, source string, text string")
    got = {r["doc_id"]: r["taken"] for r in mixing.Mixture(df, slots=slots).taken().collect()}
    assert got == plain_mix(DOCS, slots)


def test_reruns_agree_under_any_setting(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, source string, text string")
    expected, before = plain_mix(DOCS, 1 << 18), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("4", "8", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = {r["doc_id"]: r["taken"] for r in mixing.Mixture(df.repartition(int(partitions) % 7 + 1)).taken().collect()}
            assert got == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
