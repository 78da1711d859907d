"""Ranked lexical search with range-maximum sparse tables over posting lists.

An index is built from all documents without a shuffle: each task numbers the documents that it reads, in segments of a
bounded number, and keeps a posting list for every term of a segment. It knows nothing of queries.

A search takes a table of items. Segments are gathered into groups of a bounded number of documents and postings, and
items into blocks. Each task gets one group's posting lists of one block's terms, with documents in ascending key order:

* A posting's impact is its share of a score before the term's weight. For each list a sparse table names the posting of
  the greatest impact in any range, from two overlapping ranges of a power of two.
* For each item, intervals of documents are kept with a bound: the sum, over the item's terms, of weight times the
  greatest impact in the interval. The intervals of the greatest bounds are split first, each at the document of its
  greatest weighted impact, whose score is computed; what is left on both sides gets bounds of its own.
* Intervals whose bound is below the least of the best scores so far go. At equality those go that begin behind the
  last of the best documents, as equal scores are in ascending key order.

So a task never scores documents that cannot be among the best, and nothing is left out that could be.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LAST_KEY, written

#: Terms are the maximal runs of characters that are no ASCII control, space, punctuation: ASCII letters and digits, and all beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same on UTF-8: bytes of other characters are all above 127, so separators are single bytes.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or re.match(rb"[0-9a-z]", bytes([b])) else 32 for b in range(256))

#: Bounds of a segment of the index, and of a group of segments that one task searches.
SEGMENT_DOCS, SEGMENT_POSTINGS = 2048, 1 << 20
GROUP_DOCS, GROUP_POSTINGS = 16_384, 1 << 22
#: Items that are searched together.
ITEM_BLOCK = 512
#: Bytes of text that are cut into terms at once, about.
SLICE = 1 << 22
#: Intervals that are split at once, at most.
SPLITS = 512
#: A block's terms with their items go to all tasks only up to this size; beyond it the index is shuffled by term.
BROADCAST_BYTES = 16 << 20

_PER_COUNTER = 1 << 20
INDEX_SCHEMA = "segment long, term binary, docs int, numbers array<int>, counts array<int>, ids array<long>"


def term_counts(text: bytes) -> Counter:
    """How often each term occurs in a text in UTF-8."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            part = text[at:end].translate(_BYTES)
            while end < len(text) and _BYTES[text[end]] != 32:
                end += 1
            part += text[at + len(part) : end].translate(_BYTES)
        else:
            part = text[at:].translate(_BYTES)
        counts.update(part.split(b" "))
        at = end
    counts.pop(b"", None)
    return counts


class _Segment:
    def __init__(self):
        self.ids: list[int | None] = []
        self.lengths = array("i")
        self.terms: dict[bytes, int] = {}
        self.term, self.doc, self.tf = array("i"), array("i"), array("i")

    def add(self, key: int | None, counts: Counter) -> None:
        terms, doc = self.terms, len(self.ids)
        self.ids.append(key)
        self.lengths.append(sum(counts.values()))
        self.term.extend([terms.setdefault(t, len(terms)) for t in counts])
        self.tf.extend(counts.values())
        self.doc.extend([doc] * len(counts))

    def rows(self, number: int):
        """A row of the documents' keys and lengths, then a row for each term with its documents' numbers and counts."""
        import numpy as np
        import pyarrow as pa

        term = np.frombuffer(self.term, np.int32)
        order = np.argsort(term, kind="stable")
        sizes = np.bincount(term, minlength=len(self.terms))
        ends = np.r_[0, len(self.ids), len(self.ids) + np.cumsum(sizes)].astype(np.int32)  # the first list is the row of documents
        docs = pa.array(np.frombuffer(self.doc, np.int32)[order])
        counts = pa.concat_arrays([pa.array(np.frombuffer(self.lengths, np.int32)), pa.array(np.frombuffer(self.tf, np.int32)[order])])
        none = pa.nulls(len(sizes), pa.list_(pa.int64()))
        numbers = pa.concat_arrays([pa.nulls(1, pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array((ends[1:] - len(self.ids)).astype(np.int32)), docs)])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(sizes) + 1, number, np.int64)), pa.array([None, *self.terms], pa.binary()), pa.array(np.r_[len(self.ids), sizes].astype(np.int32)),
             numbers, pa.ListArray.from_arrays(pa.array(ends), counts), pa.concat_arrays([pa.array([self.ids], pa.list_(pa.int64())), none])],
            names=["segment", "term", "docs", "numbers", "counts", "ids"])


def build_index(documents: DataFrame, key: str = "doc_id", text: str = "text", segment_docs: int = SEGMENT_DOCS, segment_postings: int = SEGMENT_POSTINGS) -> DataFrame:
    """(segment, term, docs, numbers, counts, ids): posting lists of all terms of all documents, a written table.

    A row of a term has the numbers of its documents within the segment and how often they hold it; the row without a
    term has the keys and the numbers of terms of the segment's documents. Documents without terms (null and empty texts
    too) are not in it. Repeated rows are documents of their own. No documents give an empty index.
    """
    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))

    def build(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        number, segment = TaskContext.get().partitionId() * _PER_COUNTER, _Segment()
        for batch in batches:
            for k, t in zip(*batch.columns, strict=True):
                counts = term_counts(t.as_py() or b"")
                if counts:
                    segment.add(k.as_py(), counts)
                if len(segment.ids) >= segment_docs or len(segment.term) >= segment_postings:
                    yield segment.rows(number)
                    number, segment = number + 1, _Segment()
        if segment.ids:
            yield segment.rows(number)

    return written(rows.mapInArrow(build, INDEX_SCHEMA), "ranked-index")


class PostingLists:
    """One group's posting lists of one block's terms, each with a sparse table of its greatest impacts."""

    def __init__(self, table, docs: int, terms: int):
        import numpy as np
        import pyarrow.compute as pc

        heads = table.filter(pc.is_valid(table["ids"])).combine_chunks()
        segments, sizes = heads["segment"].to_numpy(), heads["docs"].to_numpy()
        first = np.cumsum(sizes) - sizes
        ids = pc.list_flatten(heads["ids"]).combine_chunks()
        absent = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(LAST_KEY).to_numpy(zero_copy_only=False)
        order = np.lexsort((absent, ids))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.keys = [None if a else k for k, a in zip(ids[order].tolist(), absent[order].tolist(), strict=True)]
        n = pc.list_flatten(heads["counts"]).to_numpy()[order].astype(np.int64)
        if len(n) and int(n.max()) * docs * 25 >= 1 << 63:
            n = n.astype(object)
        norm = (75 + (25 * n * docs) // max(1, terms)).astype(np.int64)

        lists = table.filter(pc.is_valid(table["term"])).combine_chunks()
        coded = lists["term"].combine_chunks().dictionary_encode() if len(lists) else None
        of_row = coded.indices.to_numpy() if coded is not None else np.zeros(0, np.int64)
        own, at = np.unique(of_row, return_index=True)
        self.weights = lists["weight"].to_numpy()[at]
        self.items = lists["items"].take(at)
        lengths = lists["docs"].to_numpy()
        by_segment = np.argsort(segments)
        offset = first[by_segment][np.searchsorted(segments[by_segment], lists["segment"].to_numpy())]
        doc = place[pc.list_flatten(lists["numbers"]).to_numpy() + np.repeat(offset, lengths)]
        tf = pc.list_flatten(lists["counts"]).to_numpy().astype(np.int64)
        self.span = max(1, len(order))
        key = np.repeat(of_row.astype(np.int64), lengths) * self.span + doc
        order = np.argsort(key)
        self.key, doc, tf = key[order], doc[order], tf[order]
        self.doc = doc.astype(np.int32)
        self.impact = ((1_000_000_000 * tf) // (1000 * tf + 12 * norm[doc])).astype(np.int32)
        self.starts = np.searchsorted(self.key, np.arange(len(own) + 1, dtype=np.int64) * self.span)
        longest = int(np.diff(self.starts).max(initial=1))
        self.log = np.zeros(longest + 1, np.int32)
        self.log[1:] = np.floor(np.log2(np.arange(1, longest + 1)))
        # Level k, place i: the posting of the greatest impact among the 2**k from i on; the first of them if several are equal.
        self.table = np.zeros((int(self.log[-1]) + 1, len(self.key)), np.int32)
        self.table[0] = np.arange(len(self.key))
        for k in range(1, len(self.table)):
            half, below = 1 << (k - 1), self.table[k - 1]
            a, b = below[:-half], below[half:]
            self.table[k, : len(a)] = np.where(self.impact[a] >= self.impact[b], a, b)

    def greatest(self, a, b):
        """(posting, impact) of the greatest impact in the ranges a to b (exclusive); impact 0 where a range is empty."""
        import numpy as np

        size = b - a
        some = size > 0
        a, k = np.where(some, a, 0), self.log[np.maximum(size, 1)]
        left, right = self.table[k, a], self.table[k, np.where(some, b - (1 << k), 0)]
        x, y = self.impact[left], self.impact[right]
        return np.where(x >= y, left, right), np.where(some, np.maximum(x, y), 0)

    def best(self, terms, times, top: int, splits: int = SPLITS):
        """(document, score) of the best documents by descending score, then ascending document; also how many were scored."""
        import numpy as np

        weights = self.weights[terms] * times
        terms, weights = terms[weights > 0], weights[weights > 0]
        column = terms.astype(np.int64) * self.span
        docs, scores, scored, width = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 16

        def bounded(low, a, b):
            posting, impact = self.greatest(a, b)
            share = impact * weights
            bound = share.sum(axis=1)
            at = self.doc[posting[np.arange(len(a)), share.argmax(axis=1)]] if len(weights) else np.zeros(len(a), np.int32)
            return low, a, b, bound, at.astype(np.int64)

        waiting = bounded(np.zeros(1, np.int64), self.starts[terms][None], self.starts[terms + 1][None])
        while True:
            least, last = (scores[-1], docs[-1]) if len(docs) == top else (1, self.span)
            low, _, _, bound, _ = waiting
            open_ = (bound > least) | ((bound == least) & (low <= last))
            waiting = [x[open_] for x in waiting]
            if not len(waiting[0]):
                return docs, scores, scored
            if len(waiting[0]) > width:
                order = np.argpartition(-waiting[3], width)
                now, waiting = [x[order[:width]] for x in waiting], [x[order[width:]] for x in waiting]
            else:
                now, waiting = waiting, [x[:0] for x in waiting]
            width = min(splits, 2 * width)
            low, a, b, _, at = now
            wanted = column + at[:, None]
            posting = np.searchsorted(self.key, wanted)
            inside = posting < b  # as the document is in the interval, a <= posting <= b
            holds = inside & (self.key[np.where(inside, posting, 0)] == wanted)
            found = (np.where(holds, self.impact[np.where(inside, posting, 0)], 0) * weights).sum(axis=1)
            scored += len(at)
            docs, scores = np.r_[docs, at], np.r_[scores, found]
            order = np.lexsort((docs, -scores))[:top]
            docs, scores = docs[order], scores[order]
            sides = bounded(np.r_[low, at + 1], np.r_[a, posting + holds], np.r_[posting, b])
            waiting = [np.concatenate(x) for x in zip(waiting, sides, strict=True)]


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term, times) of the items' texts; rows of one key are one item, exact repeats count once."""
    rows = items.select(F.col(key).cast("long").alias("item"), F.col(text).alias("text")).distinct()
    terms = rows.select("item", F.explode(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(TERM), F.lit(0))).alias("term"))
    return terms.groupBy("item", F.col("term").cast("binary").alias("term")).agg(F.count("*").alias("times"))


def search(index: DataFrame, items: DataFrame, top: int = 20, key: str = "item_id", text: str = "text", doc_key: str = "doc_id",
           item_block: int = ITEM_BLOCK, group_docs: int = GROUP_DOCS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, rank, doc_key, score): each item's best documents with a score above 0, equal scores by ascending key, null keys last.

    A term's weight is floor(1000 ln((2N + 2) / (2df + 1))), its impact in a document 10^9 tf div (1000 tf + 12 m), with
    m = 75 + 25 n N div L; a score sums weight times impact over an item's terms with repeats. Items without terms, or
    whose terms no document holds, give no rows; nor does an empty index. At most `top` rows of an item leave a task.
    """
    spark = index.sparkSession
    counter = F.pmod("segment", F.lit(_PER_COUNTER))
    heads = index.where("term IS NULL").agg(F.sum("docs").alias("docs"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("terms"), F.max(F.floor(F.col("segment") / _PER_COUNTER)).alias("tasks")).first()
    docs, terms, tasks = heads["docs"] or 0, heads["terms"] or 0, (heads["tasks"] or 0) + 1
    wanted = written(item_terms(items, key, text), "ranked-item-terms")
    blocks = max(1, -(-wanted.agg(F.count_distinct(F.struct("item"))).first()[0] // item_block))

    # Both tables are as small as the items' texts; the index's column of terms is all that is read of it here.
    df = index.where("term IS NOT NULL").select("term", "docs").join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("docs").alias("df"))
    weighed = df.withColumn("weight", F.floor(1000 * F.ln((F.lit(2 * docs + 2).cast("double")) / (2 * F.col("df") + 1))).cast("long"))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    lists = wanted.groupBy("term", block.alias("block")).agg(F.collect_list(F.struct("item", "times")).alias("items"))
    lists = written(lists.join(weighed, "term"), "ranked-terms")
    size = lists.agg(F.sum(F.octet_length("term") + 64 + 32 * F.size("items")), F.sum("df")).first()
    groups = max(1, -(-docs // group_docs), -(-(size[1] or 0) // (blocks * GROUP_POSTINGS)), min(int(spark.conf.get("spark.sql.shuffle.partitions")), docs // SEGMENT_DOCS))
    group = F.pmod(counter * tasks + F.floor(F.col("segment") / _PER_COUNTER), F.lit(groups)).cast("int").alias("group")

    small = F.broadcast(lists) if (size[0] or 0) <= broadcast_bytes else lists
    postings = index.where("term IS NOT NULL").join(small, "term").select(group, "block", "segment", "term", "docs", "numbers", "counts", "ids", "weight", "items")
    of_docs = index.where("term IS NULL").select(group, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "segment", "term", "docs", "numbers", "counts", "ids",
                                                 F.lit(None).cast("long").alias("weight"), F.lit(None).cast(lists.schema["items"].dataType).alias("items"))

    def best(table):
        import numpy as np
        import pyarrow as pa

        found = PostingLists(table, docs, terms)
        of: dict = {}
        for term, pairs in enumerate(found.items.to_pylist()):
            for pair in pairs:
                of.setdefault(pair["item"], []).append((term, pair["times"]))
        out: tuple[list, list, list] = ([], [], [])
        for item, pairs in of.items():
            at, times = np.array(pairs, np.int64).T
            place, score, _ = found.best(at, times, top)
            for column, values in zip(out, ([item] * len(place), [found.keys[p] for p in place], score.tolist()), strict=True):
                column.extend(values)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["item", "doc", "score"])

    found = postings.unionByName(of_docs).groupBy("group", "block").applyInArrow(best, "item long, doc long, score long")
    by_item = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(key), "rank", F.col("doc").alias(doc_key), "score")
