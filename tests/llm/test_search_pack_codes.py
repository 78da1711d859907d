"""Ranked search, packing and vector codes against plain versions, with odd cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from editloom.llm import packing, queries, ranked, vector_codes
from editloom.llm.common import read_table

from .test_operators import ODD, SF, documents, table, texts  # noqa: F401  (fixtures)

TERM = re.compile(ranked.TERM)
LOWER = str.maketrans(ranked._UPPER, ranked._LOWER)


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, top=20):
    """docs: (key, text) rows; items: {item: list of texts}."""
    held = [(k, Counter(plain_terms(t))) for k, t in docs]
    held = [(k, c, sum(c.values())) for k, c in held if c]
    total, df = sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    found = {}
    for item, said in items.items():
        asked, scores = [t for text in said for t in plain_terms(text)], []
        weight = {t: math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) for t in asked if df[t]}
        for k, c, n in held:
            m = 75 + 25 * n * len(held) // total
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if c[t])
            if score > 0:
                scores.append((-score, k is None, k or 0, k))
        found[item] = [(i + 1, k, -s) for i, (s, _, _, k) in enumerate(sorted(scores)[:top])]
    return {i: f for i, f in found.items() if f}


def searched(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r["item_id"]].append((r["rank"], r["doc_id"], r["score"]))
    return {i: sorted(f) for i, f in found.items()}


def test_op11(spark, table, texts):  # noqa: F811
    benchmark = read_table(spark, SF, "benchmark")
    benchmark.write.mode("overwrite").parquet(f"{table}/benchmark.parquet")
    got = searched(queries.op11_ranked_search(spark, table))
    assert got == plain_search(sorted(texts.items()), {r["item_id"]: [r["text"]] for r in benchmark.collect()})


@pytest.mark.parametrize("segment_docs, group_docs, item_block, broadcast", [(3, 7, 2, 1 << 20), (1, 1, 1, 0), (1000, 1000, 1000, 1 << 20)])
def test_search_odd_cases(spark, segment_docs, group_docs, item_block, broadcast):
    r = random.Random(3)
    docs = [(i, " ".join(r.choices("abcdefgh", weights=[50, 30, 10, 5, 3, 1, 1, 1], k=r.randrange(1, 30)))) for i in range(60)]
    docs += [(100 + i, "same words d e f") for i in range(40)] + [(100, "same words d e f")] * 3 + [(None, "d e f"), (None, None), (200, None), (201, ""), (202, " .,;"), (203, "x" * 9000), (204, "Größe é漢😀 D")]
    items = [(1, "D e F same"), (2, "a a a b c"), (3, None), (4, "..."), (5, "nowhere"), (6, "größe é漢😀 GRÖßE"), (7, "h g f h"), (7, "h g f h"), (7, "a"), (None, "a b"), (9, "same words")]
    index = ranked.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumn("term", F.lit(1)), segment_docs=segment_docs)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("r"))
    plain = defaultdict(list)
    for k, t in dict.fromkeys(items):
        plain[k].append(t)
    assert searched(ranked.search(index, asked, 5, item_block=item_block, group_docs=group_docs, broadcast_bytes=broadcast)) == plain_search(docs, plain, 5)


def test_search_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.search(ranked.build_index(docs.limit(0)), items).collect() == []
    assert ranked.search(ranked.build_index(docs), items.limit(0)).collect() == []
    assert len(ranked.search(ranked.build_index(docs.union(docs.withColumn("text", F.lit("c")))), items).collect()) == 1


def test_search_scores_few_documents():
    """Splitting at documents of greatest impact leaves most of a large group unseen, and takes copies in ascending order."""
    import pyarrow as pa

    r = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    segment, docs, terms = ranked._Segment(), 8000, 0
    for k in range(docs):
        text = r.choices(words, weights=[1 / (i + 1) for i in range(300)], k=60) if k % 400 else [f"w{i}" for i in range(100, 140)]
        segment.add(k, Counter(w.encode() for w in text))
        terms += len(text)
    lists = pa.Table.from_batches([segment.rows(0)])
    asked = pa.array([None, *[[{"item": 1, "times": 1}]] * (len(lists) - 1)], pa.list_(pa.struct([("item", pa.int64()), ("times", pa.int64())])))
    df = lists["docs"].to_pylist()
    weight = pa.array([None, *[math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for n in df[1:]]], pa.int64())
    found = ranked.PostingLists(lists.append_column("weight", weight).append_column("items", asked), docs, terms)
    codes = {t: i for i, t in enumerate(dict.fromkeys(t for t in lists["term"].to_pylist() if t))}
    place, score, scored = found.best(np.array([codes[f"w{i}".encode()] for i in range(100, 140)]), np.ones(40, np.int64), 10)
    assert place.tolist() == [400 * i for i in range(10)] and len(set(score.tolist())) == 1
    assert scored < docs / 4


def test_term_counts_in_slices(monkeypatch):
    text = " ".join(random.Random(5).choices(["Word", "é漢", "a-b", "zz\x00y", "x" * 50], k=400))
    monkeypatch.setattr(ranked, "SLICE", 64)
    assert {k.decode(): n for k, n in ranked.term_counts(text.encode()).items()} == Counter(plain_terms(text))


# Packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))


def check_pieces(pieces, ids_of, capacity):
    """Every id of every document in one piece; sequences gapless, and full or as long as a power of two. Returns lengths by sequence."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(ids_of)
    for key, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            part = ids_of[key][at : at + p["length"]]
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids_of[key]), zlib.crc32(np.array(part, "<u4").tobytes()))
            at += p["length"]
        assert at == len(ids_of[key])
    lengths = {}
    for s, own in by_sequence.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
        lengths[s] = at
    return lengths


def test_op12(spark, table, texts, library):  # noqa: F811
    ids = {k: [*library.encode(t or "", add_special_tokens=False).ids, 1] for k, t in texts.items()}
    lengths = check_pieces(queries.op12_cost_packing(spark, table).collect(), ids, 2048)
    assert sum(n < 2048 for n in lengths.values()) <= 11 * 3  # the table has three parts


def test_packing_odd_cases(spark, library):
    file = queries.tokenizer_path("byte_bpe_50k.json")
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no key"), (500, "long " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).withColumn("ids", F.lit("x")).withColumn("start", F.lit(0))
    ids = {k: [*library.encode(t or "", add_special_tokens=False).ids, 7] for k, t in rows}
    for capacity, window in ((64, 1 << 22), (16, 100), (1, 5), (1 << 20, 1 << 22)):
        packed = packing.pack_documents(df, file, 7, capacity=capacity, window_tokens=window)
        pieces = packed.select("*", F.floor(F.octet_length("ids") / 4).alias("length"), F.crc32("ids").alias("ids_crc32")).collect()
        check_pieces(pieces, ids, capacity)
    twice = packing.pack_documents(df.union(df).coalesce(1), file, 7)
    assert twice.agg(F.sum(F.octet_length("ids"))).first()[0] == 2 * 4 * sum(map(len, ids.values()))
    assert packing.pack_documents(df.limit(0), file, 7).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        packing.pack_documents(df, file, 7, capacity=100)


def plain_assign(lengths, room, linear, quadratic):
    room, cost, left, out = list(room), [0] * len(room), [[n, i, 0] for i, n in enumerate(lengths)], []
    while left:
        left.sort(key=lambda x: (-x[0], x[1], x[2]))
        n, piece, before = left.pop(0)
        fits = [s for s in range(len(room)) if room[s] >= n] or [s for s in range(len(room)) if room[s]]
        s = min(fits, key=lambda s: (cost[s], s))
        part = min(n, room[s])
        out.append((piece, before, part, s))
        room[s] -= part
        cost[s] += linear * part + quadratic * part * part
        if part < n:
            left.append([n - part, piece, before + part])
    return out


def test_assignment_is_greedy_by_cost():
    r = random.Random(6)
    for _ in range(20):
        lengths = [r.randrange(1, 65) for _ in range(r.randrange(0, 60))]
        room = packing.capacities(sum(lengths), 64)
        assert packing.assign(lengths, room, 3, 2) == plain_assign(lengths, room.tolist(), 3, 2)
    # Costs come out even, where first-fit by length alone puts all short pieces together.
    lengths = [r.randrange(1, 2048) for _ in range(4000)]
    room = packing.capacities(sum(lengths), 2048)
    cost = np.zeros(len(room))
    for _, _, n, s in packing.assign(lengths, room, 1, 1):
        cost[s] += n + n * n
    full = cost[room == 2048]
    assert full.std() < 0.35 * full.mean()


# Vector codes


def plain_codes(rows, parts, entries, rounds, scale):
    """rows: (key, label, vector); exact, in Python's whole numbers."""
    kept = [(k, lab, [math.floor(x * scale) for x in v]) for k, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    length = -(-max((len(v) for _, _, v in kept), default=0) // parts) * parts
    width = length // parts
    kept = [(k, lab, v + [0] * (length - len(v))) for k, lab, v in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[v[i * width : (i + 1) * width] for _, _, v in first] for i in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for i in range(parts):
            members = defaultdict(list)
            for _, _, v in kept:
                x = v[i * width : (i + 1) * width]
                members[nearest(x, books[i])[1]].append(x)
            books[i] = [[sum(c) // len(members[j]) for c in zip(*members[j])] if members[j] else e for j, e in enumerate(books[i])]
    out = []
    for k, lab, v in kept:
        found = [nearest(v[i * width : (i + 1) * width], books[i]) for i in range(parts)]
        out.append((k, lab, tuple(j for _, j in found), sum(d for d, _ in found)))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def as_rows(df):
    return sorted(((r["vec_id"], r["label"], tuple(r["codes"]), r["error"]) for r in df.collect()), key=repr)


def test_op13(spark):
    real = [(r["vec_id"], r["label"], r["embedding"]) for r in read_table(spark, SF, "embeddings").collect()]
    expected, digest = plain_codes(real, 16, 64, 2, 256)
    by_label = Counter()
    for _, lab, _, e in expected:
        by_label[lab] += e
    got = {r["vec_id"]: r for r in queries.op13_vector_codes(spark, SF).collect()}
    assert len(got) == len(expected)
    for k, lab, codes, error in expected:
        r = got[k]
        assert (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) == ("".join(f"{c:02x}" for c in codes), error, by_label[lab], digest)


@pytest.mark.parametrize("entries, pivots", [(4, 1), (5, 3), (64, 8)])
def test_codes_odd_cases(spark, entries, pivots):
    r = random.Random(7)
    rows = [(i, i % 3 or None, [r.choice([-1.5, -0.25, 0.0, 0.3, 2.0]) for _ in range(8)]) for i in range(60)]
    rows += [(3, 1, rows[3][2]), (70, 2, None), (71, 2, [1.0] * 7 + [None]), (72, 2, [math.nan] * 8), (73, None, [math.inf] * 8), (74, 1, [1.0, 2.0]), (75, 1, []), (None, None, [0.1] * 8), (-5, 9, [60000.0] * 8), (80, 9, [-60000.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("x", F.lit(1)).withColumn("error", F.lit("e"))
    coded, books = vector_codes.fit_codes(df, parts=4, entries=entries, pivots=pivots)
    expected, digest = plain_codes(rows, 4, entries, 2, 256)
    assert (as_rows(coded), books.sha256()) == (sorted(expected, key=repr), digest)
    sums = Counter()
    for _, lab, _, e in expected:
        sums[lab] += e
    for bound in (0, 100):
        found = vector_codes.with_label_errors(coded, bound).collect()
        assert len(found) == len(expected) and all(x["label_error"] == sums[x["label"]] for x in found)


def test_codes_empty_table_and_refusal(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert sum(len(r["codes"]) for r in vector_codes.fit_codes(spark.createDataFrame([(1, 1, []), (2, 1, [])], schema))[0].collect()) == 32
    df = spark.createDataFrame([(1, 1, None), (2, None, [math.nan])], schema)
    coded, books = vector_codes.fit_codes(df)
    assert vector_codes.with_label_errors(coded).collect() == [] and books.sha256() == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError, match="squared distances"):
        vector_codes.fit_codes(spark.createDataFrame([(1, 1, [1e30] * 16)], df.schema))


def test_pivots_prune():
    r = np.random.default_rng(8)
    centres = r.integers(-4000, 4000, (64, 4))
    parts = centres[r.integers(0, 64, 3000)] + r.integers(-60, 60, (3000, 4))
    pivots = vector_codes.choose_pivots(centres)
    code, error, evaluated = vector_codes.nearest(parts, vector_codes.pivot_distances(parts, pivots), centres, pivots)
    exact = ((parts[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (code == exact.argmin(axis=1)).all() and (error == exact.min(axis=1)).all()
    assert evaluated < 3000 * 64 / 10
