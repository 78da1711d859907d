"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit of a fingerprint has a nonzero vector of radius + 1 bits; the mask of a nonzero vector v keeps the bits whose
vector has an odd number of ones in common with v. The vectors of at most `radius` differing bits cannot span all
radius + 1 dimensions, so some v is orthogonal to them all, its mask drops them all, and the pair has equal masked
fingerprints in that table: no pair within the radius is missed. With radius 3 there are 15 tables of about 34 bits.

Only distinct fingerprints are compared. A bucket of many fingerprints is cut into blocks by a hash, from a count of its
members; each pair of blocks is compared by itself, wherever Spark puts it, and gives the edges of a spanning forest
instead of all its pairs. No task sees a whole bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_runs, join_counted, run_batches, written
from .components import connected_components

RADIUS = 3
BLOCK = 1024


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """2 ** (radius + 1) - 1 masks; any two words that differ in at most `radius` bits agree under one of them."""
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if ((i % vectors + 1) & v).bit_count() % 2) for v in range(1, vectors + 1)]


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, and white space of ASCII only


def shingle_hashes(found: list[bytes], words: int) -> Iterator:
    """XXH64 (seed 42) of the word shingles, repeats included, in parts; fewer words are one shingle, no words none."""
    import numpy as np
    from xxhash import xxh64_intdigest

    if found and len(found) < words:
        yield np.array([xxh64_intdigest(b" ".join(found), 42)], "<u8")
    for lo in range(0, len(found) - words + 1, 65_536):
        part = found[lo : lo + 65_536 + words - 1]
        yield np.array([xxh64_intdigest(s, 42) for s in map(b" ".join, zip(*[part[i:] for i in range(words)]))], "<u8")


def fingerprint_of(parts: Iterator) -> int:
    """64 bits: each is set if it is in over half the hashes; 0 without any."""
    import numpy as np

    counts, n = np.zeros(64, np.int64), 0
    for hashes in parts:
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = 3) -> int:
    return fingerprint_of(shingle_hashes(text_words(text), words))


def with_fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, fp): fp a signed long. A null or empty text, or one of white space, has fingerprint 0."""
    import pyarrow as pa

    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def fingerprints(batches: Iterator) -> Iterator:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([signed(fingerprint(t.as_py(), words)) for t in batch.column(1)], pa.int64())], schema=schema)

    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(fingerprints, "key long, fp long")


def forest(members, radius: int):
    """(node, root) edges that join what links of at most `radius` differing bits join among an array of fingerprints."""
    import numpy as np

    members = np.unique(members)
    x = members.view(np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    label = np.arange(len(members))
    while True:
        best = np.where(near, label[None, :], len(members)).min(axis=1)
        best = best[best]
        if (best == label).all():
            break
        label = best
    moved = np.flatnonzero(label != np.arange(len(members)))
    return members[moved], members[label[moved]]


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp); their components are those of all pairs within the radius."""
    import pyarrow as pa

    masks = F.array(*[F.lit(signed(m)) for m in covering_masks(radius)])
    rows = distinct.select("fp", F.posexplode(masks).alias("table", "mask")).select("fp", "table", F.col("fp").bitwiseAND(F.col("mask")).alias("bucket"))
    rows = block_runs(rows, ["table", "bucket"], "fp", block, "simhash-buckets")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def link(batches: Iterator) -> Iterator:
        import numpy as np

        for runs in run_batches(batches):
            run, fp = runs.column(0).to_numpy(), runs.column(1).to_numpy()
            starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
            sizes = np.diff(np.r_[starts, len(run)])
            two = starts[sizes == 2]
            a, b = fp[two], fp[two + 1]
            near = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= radius
            found = [(a[near], b[near])]
            found += [forest(fp[s : s + n], radius) for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[i] for f in found])) for i in (0, 1)], schema=schema)

    return rows.mapInArrow(link, "a long, b long")


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = RADIUS) -> DataFrame:
    """(key, fp, component_id): one row for each document.

    component_id is the least key that links of at most `radius` differing bits reach, the document's own included;
    texts without words are linked like others. Null keys take part but are never a component's id, unless a component
    has no other key: then it is null. An empty table gives no rows. A fingerprint of very many documents, or a component
    of very many fingerprints, is no hot key of a join.
    """
    docs = written(with_fingerprints(documents, key, text, words), "simhash")
    distinct = written(docs.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("rows")), "simhash-distinct")
    components = connected_components(fingerprint_links(distinct.select("fp"), radius))
    roots = distinct.join(components, distinct["fp"] == components["node"], "left").select("fp", "rows", "least", F.coalesce("root", "fp").alias("root"))
    roots = written(roots, "simhash-roots")
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("fingerprints"))
    ids = written(join_counted(roots.drop("least"), least, "root", "fingerprints").select("fp", "rows", "component_id"), "simhash-ids")
    return join_counted(docs, ids, "fp", "rows").select(F.col("key").alias(key), "fp", "component_id")
