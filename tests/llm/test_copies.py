from __future__ import annotations

import random
from itertools import combinations

import corpus_pipeline
from editloom.llm import copies
from editloom.llm.common import read_table

SF = "/root/testdata/sf0.001"


def shingles(text, words=5):
    found = (text or "").encode().lower().split()
    return {b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}


def greedy(texts):
    """By ascending key: a text stays if it is less than 0.8 like all that stay."""
    stay: dict = {}
    for k in sorted(texts):
        own = shingles(texts[k])
        if all(len(own & s) < 0.8 * len(own | s) for s in stay.values()):
            stay[k] = own
    return sorted(stay)


def test_near_copies_of_the_stage(spark):
    docs = read_table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = greedy(texts)
    assert sum(len(shingles(texts[a]) & shingles(texts[b])) >= 0.8 * len(shingles(texts[a]) | shingles(texts[b])) for a, b in combinations(want, 2)) == 0
    got = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs.union(docs), SF)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == want


def test_edits_and_chains(spark, monkeypatch):
    """Copies with edits, and chains of which each link is similar but the ends are not, with and without rounds."""
    r = random.Random(5)
    texts = {}
    for base in range(12):
        words = [f"w{r.randrange(5000)}" for _ in range(200)]
        for copy in range(10):
            texts[len(texts)] = " ".join(words)
            words[r.randrange(200)] = f"x{base}_{copy}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for rounds in (0, 4):
        monkeypatch.setattr(copies, "ROUNDS", rounds)
        got = sorted(x["doc_id"] for x in copies.one_of_each_group(docs).collect())
        assert got == greedy(texts) and 12 < len(got) < 120


def test_long_chains_take_no_rounds(spark, tmp_path, monkeypatch):
    """1,000 revisions, each like the next few: one component, settled by one task; with a small bound, in rounds."""
    r = random.Random(6)
    words, texts = [f"w{r.randrange(5000)}" for _ in range(150)], {}
    for i in range(1000):
        texts[i] = " ".join(words)
        words[(7 * i) % 150] = f"x{i}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    written = []
    monkeypatch.setattr(copies, "written", lambda df, purpose, real=copies.written: written.append(purpose) or real(df, purpose))
    got = sorted(x["doc_id"] for x in copies.one_of_each_group(docs).collect())
    assert got == greedy(texts) and 100 < len(got) < 700
    assert written.count("copies-gone") <= copies.ROUNDS + 1


def test_components_are_settled_by_tasks_or_in_rounds(spark):
    r = random.Random(7)
    edges = {(a, b) for _ in range(400) for a, b in [sorted((r.randrange(200), r.randrange(200)))] if a < b}
    gone = set()
    for b in range(200):
        if any((a, b) in edges and a not in gone for a in range(b)):
            gone.add(b)
    df = spark.createDataFrame(sorted(edges), "a long, b long")
    for most in (10**6, 3, 0):
        found = [x["node"] for part in copies.settled(df, most) for x in part.collect()]
        assert set(found) == gone
    assert copies.settled(df.limit(0)) == []


def test_a_bucket_of_very_many_texts(spark):
    """40,000 short texts that begin alike, as boilerplate does: many share buckets, few are similar."""
    texts = {i: f"all rights are reserved by the owner number {i} of {i // 7} and {i * 31 % 977}" if i % 50 else "all rights are reserved by the owner of this and that" for i in range(40_000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"] for x in copies.one_of_each_group(docs).collect()}
    assert {i for i in got if i % 50 == 0} == {0} and len(got) == 1 + 40_000 - 800
