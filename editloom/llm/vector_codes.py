"""Vector codes by a product quantiser whose nearest entries are found by LAESA.

A vector of whole numbers is cut into equal parts; each part has a codebook. A few entries of each first codebook, far
apart, are its pivots for good. Distances of every part to its pivots are computed once and kept with the part. In each
round the pivots' distances to the entries are computed anew; by the triangle inequality the difference of the two
distances to a pivot is a lower bound of the distance between part and entry. Entries are tried in ascending order of
the greatest such bound, and left out as soon as the bound exceeds the best squared distance so far. Distances are
evaluated in whole numbers, so codes and errors are exact; bounds are lowered by more than their rounding.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Pivots of each part.
PIVOTS = 6
SCALE = 256
#: Components beyond this, after scaling, are refused: squared distances of 8,192 of them would not fit a long.
LARGEST = 1 << 24
#: Labels up to this number go to all tasks with their sums.
BROADCAST_LABELS = 100_000
#: Parts that are searched at once.
STEP = 4096


def choose_pivots(entries, pivots: int = PIVOTS):
    """Entries far apart, (pivots, length): the first one, then each time the one farthest from all chosen."""
    import numpy as np

    chosen, least = [0], None
    for _ in range(min(pivots, len(entries)) - 1):
        far = ((entries - entries[chosen[-1]]) ** 2).sum(axis=1)
        least = far if least is None else np.minimum(least, far)
        chosen.append(int(least.argmax()))
    return entries[chosen]


def pivot_distances(parts, pivots):
    """Distances of each part to each pivot, rounded square roots of whole numbers."""
    import numpy as np

    return np.sqrt(((parts[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2).astype(np.float64))


def nearest(parts, to_pivots, entries, pivots):
    """(entry, squared distance) of the entry nearest to each part, the first of equally near ones; and how many distances were evaluated."""
    import numpy as np

    n, rows, never = len(parts), np.arange(len(parts)), np.iinfo(np.int64).max
    best, code = np.full(n, never, np.int64), np.zeros(n, np.int64)
    of_entries = pivot_distances(entries, pivots)
    bound = np.zeros((n, len(entries)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - of_entries[None, :, p]), out=bound)
    # Both distances are right within 2**-53 of themselves; they are below 2**32, as components are below 2**24.
    np.maximum(bound * (1 - 2.0**-40) - 2.0**-18, 0, out=bound)
    np.square(bound, out=bound)
    evaluated = 0
    while len(rows):  # a row ends when its least bound, infinite for entries that were tried, is beyond its best
        entry = bound[rows].argmin(axis=1)
        low = bound[rows, entry]
        going = low <= best[rows]
        rows, entry = rows[going], entry[going]
        found = ((parts[rows] - entries[entry]) ** 2).sum(axis=1)
        evaluated += len(rows)
        bound[rows, entry] = np.inf
        nearer = (found < best[rows]) | ((found == best[rows]) & (entry < code[rows]))
        best[rows[nearer]], code[rows[nearer]] = found[nearer], entry[nearer]
    return code, best, evaluated


class Codebooks:
    """Entries and pivots of each part: arrays (entries, length), whole numbers."""

    def __init__(self, entries: list, pivots: list):
        self.entries, self.pivots = entries, pivots

    def sha256(self) -> str:
        numbers = [str(x) for part in self.entries for entry in part for x in entry.tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _matrix(column, width: int):
    import numpy as np

    return np.asarray(column.flatten()).reshape(len(column), width)


def whole_vectors(vectors: DataFrame, key: str, vector: str, label: str, parts: int, scale: int) -> tuple[DataFrame, int]:
    """(key, label, x) of the kept rows and the length of x: components times scale, rounded down, zeros behind short vectors."""
    v = F.col(vector)
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), F.transform(v, lambda x: x.cast("double") * scale).alias("x"))
    seen = kept.agg(F.max(F.size("x")).alias("n"), F.max(F.array_max(F.transform("x", F.abs))).alias("most")).first()
    kept = kept.withColumn("x", F.transform("x", lambda x: F.floor(x)))
    if (seen["most"] or 0) >= LARGEST:
        raise ValueError(f"a component times {scale} is {seen['most']}: beyond {LARGEST} squared distances do not fit a long")
    length = -(-(seen["n"] or 0) // parts) * parts
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(length) - F.size("x")))
    return kept.withColumn("x", padded), length


def fit_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
              rounds: int = ROUNDS, pivots: int = PIVOTS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """(key, label, codes, error) of each kept row, and the codebooks: codes is an array with an entry's place for each part.

    Rows go whose vector is null or holds null, NaN or infinite components. The codebooks start as the parts of the
    vectors of the least keys (null keys last, equal keys by their components); fewer rows give fewer entries. Vectors
    shorter than the longest, and lengths that the parts do not divide, count as filled up with zeros. An empty table
    gives no rows and empty codebooks. The driver holds the codebooks and their sums: parts * entries rows, whatever the
    number of vectors.
    """
    import numpy as np

    whole, length = whole_vectors(vectors, key, vector, label, parts, scale)
    width = length // parts
    least = whole.orderBy(F.col("key").asc_nulls_last(), "x").limit(entries).collect()
    first = np.array([r["x"] for r in least], np.int64).reshape(len(least), length)
    books = Codebooks([first[:, i * width : (i + 1) * width] for i in range(parts)], [])
    if not len(first):
        return whole.select("key", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error")).withColumnRenamed("key", key), books
    books.pivots = [choose_pivots(e, pivots) for e in books.entries]
    fixed = books.pivots

    def with_distances(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = _matrix(batch.column(2), length)
            d = [pivot_distances(x[:, i * width : (i + 1) * width], fixed[i]) for i in range(parts)]
            d = np.concatenate(d, axis=1) if len(x) else np.zeros((0, 1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * d.shape[1]), pa.array(d.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["key", "label", "x", "d"])

    label_type = whole.schema["label"].dataType.simpleString()
    table = written(whole.mapInArrow(with_distances, f"key long, label {label_type}, x array<long>, d array<double>"), "vector-parts")

    def searched(batch, current: list):
        """(codes, squared distances), both (rows, parts), of a batch's vectors."""
        x = _matrix(batch.column(batch.schema.get_field_index("x")), length)
        d = _matrix(batch.column(batch.schema.get_field_index("d")), sum(map(len, fixed))).reshape(len(x), parts, -1)
        codes, errors = np.zeros((len(x), parts), np.int64), np.zeros((len(x), parts), np.int64)
        for low in range(0, len(x), STEP):
            rows = slice(low, low + STEP)
            for i in range(parts):
                codes[rows, i], errors[rows, i], _ = nearest(x[rows, i * width : (i + 1) * width], d[rows, i], current[i], fixed[i])
        return x, codes, errors

    for _ in range(rounds):
        current = books.entries

        def sums(batches: Iterator, current=current) -> Iterator:
            """A row for each part and entry that a task's vectors use: their number and the sum of each component."""
            import pyarrow as pa

            size = len(current[0])
            count, total = np.zeros((parts, size), np.int64), np.zeros((parts, size, width), np.int64)
            for batch in batches:
                x, codes, _ = searched(batch, current)
                for i in range(parts):
                    count[i] += np.bincount(codes[:, i], minlength=size)
                    np.add.at(total[i], codes[:, i], x[:, i * width : (i + 1) * width])
            part, entry = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))],
                                             names=["part", "entry", "n", "total"])

        summed = table.select("x", "d").mapInArrow(sums, "part int, entry int, n long, total array<long>").groupBy("part", "entry")
        moved = [e.copy() for e in books.entries]
        for r in summed.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(j))) for j in range(width)]).alias("total")).collect():
            moved[r["part"]][r["entry"]] = [t // r["n"] for t in r["total"]]
        books.entries = moved

    final = books.entries

    def coded(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            _, codes, errors = searched(batch, final)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * parts), pa.array(codes.reshape(-1).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, pa.array(errors.sum(axis=1))], names=["key", "label", "codes", "error"])

    return table.mapInArrow(coded, f"key long, label {label_type}, codes array<int>, error long").withColumnRenamed("key", key), books


def with_label_errors(coded: DataFrame, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """Adds label_error: the errors of all rows of equal label added up, null labels together.

    Sums are partial before they are shuffled. Few labels go to all tasks; more are joined, where Spark's adaptive join
    splits a hot label.
    """
    coded = written(coded, "vector-codes")
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "vector-labels")
    right = sums.withColumnRenamed("label", "_label")
    right = F.broadcast(right) if sums.count() <= broadcast_labels else right
    return coded.join(right, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
