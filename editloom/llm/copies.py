"""Near copies by exact similarity: the share of five-word shingles that two texts have in common (Jaccard).

Candidates come from SimHash: texts whose fingerprints of five-word shingles differ in at most 3 bits share a bucket of
the covering tables (simhash.py) for certain. At a similarity of 0.8, though, about 10 of 64 bits differ, give or take 3,
and tables that cover 16 bits would be 131,071. So each text also has `BANDS` MinHash buckets, each the hash of `ROWS`
least values of its shingles under random linear orders; two texts of similarity s share one with a chance of
1 - (1 - s ** ROWS) ** BANDS, which is 0.99994 at 0.8 and grows with s.

A text is dropped only if its exact similarity with a text that stays is at least the threshold, so there are no chains.
Texts are taken by least key. While buckets are large, each is compared with its first text only, if that one comes
first in all its buckets and so stays for certain. What is left is compared in blocks of a bucket by sketches, the last
bytes of all `ROWS` * `BANDS` least values: of a pair of 0.8 fewer than 119 of 192 are equal with a chance of 1e-9. Only
pairs that pass go on to the exact comparison. The pairs that are similar are a graph; each of its components is settled
by one task, text by text in the order of keys, so that long chains of revisions take no rounds of their own. Only
components of more than `SETTLED` pairs are worked off in rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_runs, free_names, run_batches, written
from .components import connected_components
from .simhash import RADIUS, covering_masks, fingerprint_of, shingle_hashes, signed, text_words

WORDS = 5
SIMILARITY = 0.8
ROWS, BANDS = 6, 32
#: Rounds of comparisons with first texts before the rest is compared in pairs; no bound of what is compared.
ROUNDS = 4
_PART = 4096
BLOCK = 512
#: Share of equal bytes in the sketches of a pair that is compared exactly.
SKETCH_SHARE = 0.62
#: Pairs of one text that a task compares.
PAIRS = 1024
#: Similar pairs of a component that one task settles.
SETTLED = 1_000_000


def shingle_set(hashes) -> object:
    """Ascending distinct hashes of a text's shingles; a text without words has one of its own."""
    import numpy as np

    return np.unique(hashes) if len(hashes) else np.zeros(1, np.uint64)


def hashes_of(found: list[bytes], words: int):
    import numpy as np

    return np.concatenate([np.zeros(0, "<u8"), *shingle_hashes(found, words)])


def text_node(found: list[bytes]) -> int:
    """Texts of the same words in the same order are one node."""
    from xxhash import xxh3_64_intdigest

    return signed(xxh3_64_intdigest(b" ".join(found)))


def _mixed(x):
    import numpy as np

    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def least_values(hashes, rows: int = ROWS, bands: int = BANDS):
    """The least value of a text's distinct shingle hashes under each of rows * bands random linear orders."""
    import numpy as np

    random = np.random.default_rng(20)
    factors, shifts = random.integers(0, 2**64, (2, rows * bands), np.uint64)
    factors |= np.uint64(1)
    least = np.full(rows * bands, 2**64 - 1, np.uint64)
    for lo in range(0, len(shingles := shingle_set(hashes)), _PART):
        x = shingles[lo : lo + _PART, None] * factors[None, :] + shifts[None, :]
        np.minimum(least, x.min(axis=0), out=least)
    return least


def buckets(hashes, least, rows: int = ROWS, bands: int = BANDS):
    """One signed long for each MinHash band of a text's shingle hashes and each covering table of their SimHash."""
    import numpy as np

    out = np.arange(bands, dtype=np.uint64)
    for column in least.reshape(bands, rows).T:
        out = _mixed(out ^ column)
    masks = np.array(covering_masks(RADIUS), np.uint64)
    tables = _mixed((masks & np.uint64(fingerprint_of([hashes]))) ^ _mixed(np.arange(1, len(masks) + 1, dtype=np.uint64) << np.uint64(32)))
    return np.concatenate([out, tables]).view(np.int64)


def _with_buckets(documents: DataFrame, key: str, text: str, words: int) -> DataFrame:
    import pyarrow as pa

    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("buckets", pa.list_(pa.int64())), ("sketch", pa.binary())])

    def bucketed(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            nodes, found, sketches = [], [], []
            for t in batch.column(1):
                own = text_words(t.as_py())
                hashes = hashes_of(own, words)
                least = least_values(hashes)
                nodes.append(text_node(own))
                found.append(buckets(hashes, least))
                sketches.append(_mixed(least).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], schema=schema)

    return documents.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(bucketed, "key long, node long, buckets array<long>, sketch binary")


def _sets(documents: DataFrame, words: int) -> DataFrame:
    """(node, shingles): the shingle set of each (text) as bytes."""
    import pyarrow as pa

    def found(batches: Iterator) -> Iterator:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                texts = [text_words(t.as_py()) for t in batch.column(0).slice(lo, 64)]
                yield pa.RecordBatch.from_arrays([pa.array([text_node(t) for t in texts], pa.int64()), pa.array([shingle_set(hashes_of(t, words)).tobytes() for t in texts], pa.binary())],
                                                 names=["node", "shingles"])

    return documents.mapInArrow(found, "node long, shingles binary").dropDuplicates(["node"])


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The rows (a, b) of pairs whose exact similarity is at least `similarity`."""
    import pyarrow as pa

    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("parts"))
    # A text of many pairs is repeated for each part of them: at most one more row for every PAIRS pairs.
    of_a = sets.join(counts, sets["node"] == counts["a"]).select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("shingles").alias("of_a"))
    large = written(counts.where("parts > 1"), "copies-parts")
    rows = pairs.join(large, "a", "left").withColumn("part", F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    rows = rows.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b").join(of_a, ["a", "part"]).select("a", "b", "of_a", "of_b")

    def near(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                ok = min(len(x), len(y)) >= similarity * max(len(x), len(y))
                if ok:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok = both >= similarity * (len(x) + len(y) - both)
                good.append(ok)
            kept = batch.select([0, 1]).filter(pa.array(good, pa.bool_()))
            if kept.num_rows:
                yield kept

    return rows.mapInArrow(near, "a long, b long")


def _firsts(rows: DataFrame) -> DataFrame:
    """(bucket, first): the node of least key of each bucket of at least two nodes. Partial aggregates, so no task sees a large bucket whole."""
    found = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.min(F.struct("least", "node"))["node"].alias("first"))
    return found.where("size > 1").select("bucket", "first")


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of buckets of at least two nodes, with the bucket's first node. Spark's adaptive join splits the rows of a large bucket."""
    return rows.drop("first").join(_firsts(rows), "bucket")


def _without(rows: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    return rows.join(gone.select(F.col(gone.columns[0]).alias(column)).distinct(), column, "left_anti")


def _alike(batches: Iterator) -> Iterator:
    """(a, b): pairs of a run whose sketches agree enough, the one of least key first. Rows: run, least, node, sketch."""
    import numpy as np
    import pyarrow as pa

    for runs in run_batches(batches):
        run, least, node = (runs.column(i).to_numpy() for i in range(3))
        sketch = np.frombuffer(b"".join(runs.column(3).to_pylist()), np.uint8).reshape(len(run), -1)
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        found = [np.zeros((0, 2), np.int64)]
        for s, e in zip(starts, np.r_[starts[1:], len(run)]):
            order = s + np.lexsort((node[s:e], least[s:e]))
            own, names = sketch[order], node[order]
            for i in range(len(own) - 1):
                later = i + 1 + np.flatnonzero((own[i + 1 :] == own[i]).sum(axis=1) >= SKETCH_SHARE * own.shape[1])
                found.append(np.stack([np.full(len(later), names[i]), names[later]], axis=1))
        both = np.concatenate(found)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def _settle(edges):
    """The nodes that go of a component's pairs (a before b): a node goes if one before it is like it and stays."""
    import pyarrow as pa

    before: dict[int, int] = {}
    after: dict[int, list[int]] = {}
    for a, b in zip(edges["a"].to_pylist(), edges["b"].to_pylist()):
        before[b] = before.get(b, 0) + 1
        after.setdefault(a, []).append(b)
    ready, gone = [a for a in after if a not in before], set()
    while ready:
        node = ready.pop()
        for b in after.get(node, ()):
            if node not in gone:
                gone.add(b)
            before[b] -= 1
            if not before[b]:
                ready.append(b)
    return pa.table([pa.array(sorted(gone), pa.int64())], names=["node"])


def settled(edges: DataFrame, most: int = SETTLED) -> list[DataFrame]:
    """Tables (node) of the nodes that go, for distinct pairs (a before b) of similar nodes."""
    if edges.isEmpty():
        return []
    roots = connected_components(edges)
    # A component's root, its least node, has no row of its own.
    marked = written(edges.join(roots, edges["a"] == roots["node"], "left").select(F.coalesce("root", "a").alias("root"), "a", "b"), "copies-components")
    large = written(marked.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > most).select("root"), "copies-large")
    small = marked.join(large, "root", "left_anti")
    gone = [written(small.groupBy("root").applyInArrow(_settle, "node long"), "copies-gone")]
    edges = written(marked.join(large, "root", "left_semi").select("a", "b"), "copies-edges")
    while not edges.isEmpty():
        stay = edges.select("a").distinct().join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        gone.append(written(edges.join(stay, "a", "left_semi").select(F.col("b").alias("node")).distinct(), "copies-gone"))
        edges = written(_without(_without(edges, "a", gone[-1]), "b", gone[-1]), "copies-edges")
    return gone


def dropped_nodes(distinct: DataFrame, documents: DataFrame, key: str, text: str, words: int, similarity: float) -> DataFrame:
    """(node): nodes with a node of at least `similarity` that comes earlier and stays. distinct: node, least, buckets, sketch."""
    rows = written(_shared(distinct.select("node", "least", F.explode("buckets").alias("bucket"))), "copies-buckets")
    needed = rows.select(F.col("least").alias(key)).distinct()
    sets = written(_sets(documents.join(needed, key, "left_semi").select(text), words), "copies-sets")
    gone = []
    for _ in range(ROUNDS):
        pairs = written(rows.select(F.col("first").alias("a"), F.col("node").alias("b")).where("a <> b").distinct(), "copies-pairs")
        if pairs.isEmpty():
            break
        sure = written(_without(pairs, "a", pairs.select("b")), "copies-sure")
        gone.append(written(similar(sure, sets, similarity).select(F.col("b").alias("node")).distinct(), "copies-gone"))
        rows = written(_shared(_without(_without(rows, "node", gone[-1]), "node", sure.select("a"))), "copies-buckets")
    left = rows.drop("first").join(distinct.select("node", "sketch"), "node").select("bucket", "least", "node", "sketch")
    pairs = written(block_runs(left, ["bucket"], "node", BLOCK, "copies-blocks").mapInArrow(_alike, "a long, b long").distinct(), "copies-pairs")
    edges = written(similar(pairs, sets, similarity), "copies-edges")
    gone += settled(edges)
    out = rows.select("node").where("false")
    for part in gone:
        out = out.union(part)
    return out.distinct()


def one_of_each_group(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that stay, with all their columns: of near copies the one of least key; of repeated rows one.

    A document without key goes by a hash of its text, above all keys, so it stays if no other document is like it.
    """
    above = F.xxhash64(text).bitwiseAND(F.lit(2**62 - 1)).bitwiseOR(F.lit(2**62))
    (own,) = free_names(documents, "_key")
    keyed = documents.withColumn(own, F.coalesce(F.col(key).cast("long"), above))
    rows = written(_with_buckets(keyed, own, text, words), "copies")
    distinct = written(rows.groupBy("node").agg(F.min("key").alias("least"), F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch")), "copies-distinct")
    gone = dropped_nodes(distinct, keyed, own, text, words, similarity)
    kept = _without(distinct.select("node", "least"), "node", gone).select(F.col("least").alias(own)).distinct()
    return keyed.join(kept, own, "left_semi").dropDuplicates([own]).drop(own)
