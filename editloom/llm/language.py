"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams (n = 1 to `MOST`) that both have, whatever their counts,
over the geometric mean of how many each has: a blended-spectrum presence kernel. Landmark texts approximate it
(Nyström), and a one-versus-rest ridge regression on the landmark features scores each language. As the kernel is a
product of presence vectors, landmarks and ridge weights fold into one matrix of n-grams by languages, and a batch of
texts is scored by one matrix product.

Letters are lower-cased by code point; everything else counts as a space. N-grams are hashed to 2**20 numbers and those
that some landmark has are the features.

Training: a bounded sample of labelled texts is drawn by hash. The landmarks' n-grams go to the driver as lists of
numbers; every other text of the sample is reduced by the executors to its kernel values with the landmarks, so what the
driver holds does not depend on the length of texts. The weights have features times languages numbers of 4 bytes:
under a megabyte for a few languages, 800 MB if 200 languages had every n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, written

MOST = 4
BINS = 1 << 20
UNKNOWN = "und"
#: The bounded sample of labelled rows that the classifier is fitted on: so many texts of each language and altogether at most.
TEXTS_PER_LANGUAGE = 300
TEXTS = 6_000
#: Landmarks of each language and altogether at most, and n-grams of a landmark: a longer text stands in with those of least number.
LANDMARKS_PER_LANGUAGE = 60
LANDMARKS = 1_200
LANDMARK_GRAMS = 1 << 15
MOST_LANGUAGES = 200
RIDGE = 1e-2
#: Rows that pass the hash threshold for each one that is wanted, on average; the surplus is ranked and left out.
SURPLUS = 4
_BLOCK = 1 << 16


@lru_cache(maxsize=1)
def _letters():
    """The code point that stands for each code point: a letter's simple lower case, or a space."""
    import numpy as np

    table = np.full(0x110000, 32, np.uint64)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def letter_codes(text: str):
    import numpy as np

    return _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]


def gram_bins(codes):
    """Hashed n-grams of a text's codes, block by block; n-grams of spaces only are left out."""
    import numpy as np

    multiplier = np.uint64(0x9E3779B97F4A7C15)
    for lo in range(0, len(codes), _BLOCK):
        part = codes[lo : lo + _BLOCK + MOST - 1]
        h = np.zeros(len(part), np.uint64)
        for n in range(1, MOST + 1):
            if len(part) < n:
                break
            h = (h[: len(part) - n + 1] ^ (part[n - 1 :] + np.uint64(n << 32))) * multiplier
            h ^= h >> np.uint64(29)
            real = part[: len(h)] != 32
            for j in range(1, n):
                real |= part[j : j + len(h)] != 32
            yield (h >> np.uint64(44))[real].astype(np.int64)


@dataclass
class Classifier:
    languages: list[str]
    column: object  # int32 of BINS: the feature of each hashed n-gram, or the number of features for none
    weights: object  # features by languages

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score of 0 to 1) of each text; `und` and 0.0 if it has no letter or no language was learned."""
        return [found[:2] for found in self.judge(texts)]

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language and score of each text, and whether it has a letter: that tells `no letters` from `no language was learned`."""
        import numpy as np

        features = len(self.weights)
        present = np.zeros((len(texts), features + 1), np.bool_)
        lettered = np.zeros(len(texts), np.bool_)
        for i, text in enumerate(texts):  # one text at a time as a string
            codes = letter_codes((text.as_py() if hasattr(text, "as_py") else text) or "")
            lettered[i] = bool((codes != 32).any())
            if lettered[i]:
                for bins in gram_bins(codes):
                    present[i, self.column[bins]] = True
        x = present[:, :features].astype(np.float32)
        norm = np.sqrt(np.maximum(1.0, x.sum(axis=1)))[:, None]
        if not self.languages:
            return [(UNKNOWN, 0.0, bool(ok)) for ok in lettered]
        margins = (x @ self.weights) / norm
        best = margins.argmax(axis=1)
        sure = np.clip((margins[np.arange(len(texts)), best] + 1) / 2, 0.0, 1.0)
        return [(self.languages[b], float(s), True) if ok else (UNKNOWN, 0.0, False) for b, s, ok in zip(best, sure, lettered, strict=True)]


class Landmarks:
    """Landmark texts by n-gram: which landmarks have each feature."""

    def __init__(self, rows: list):
        """rows: an ascending integer array of distinct hashed n-grams for each landmark."""
        import numpy as np

        rows = [np.asarray(bins)[:LANDMARK_GRAMS] for bins in rows]
        self.count = len(rows)
        self.norms = np.sqrt([max(1, len(bins)) for bins in rows])
        grams = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        order = np.argsort(grams, kind="stable")
        self.owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(bins) for bins in rows])[order]
        self.vocabulary, first = np.unique(grams[order], return_index=True)
        self.start = np.r_[first, len(grams)]
        self.column = np.full(BINS, len(self.vocabulary), np.int32)
        self.column[self.vocabulary] = np.arange(len(self.vocabulary))

    def kernel(self, bins):
        """Kernel values of one text with all landmarks: shared features over the root of both numbers of features."""
        import numpy as np

        features = self.column[np.asarray(bins)]
        features = features[features < len(self.vocabulary)]
        lengths = self.start[features + 1] - self.start[features]
        # The owners of all features one after the other.
        places = np.repeat(self.start[features] - np.r_[0, lengths.cumsum()[:-1]], lengths) + np.arange(lengths.sum()) if len(features) else np.zeros(0, np.int64)
        shared = np.bincount(self.owner[places], minlength=self.count)
        return shared / (self.norms * max(1.0, len(features)) ** 0.5)

    def weights(self, by_landmark):
        """Features by languages: each feature's sum over the landmarks that have it. by_landmark: landmarks by languages."""
        import numpy as np

        scaled = by_landmark / self.norms[:, None]
        return np.stack([np.add.reduceat(scaled[self.owner, c], self.start[:-1]) for c in range(scaled.shape[1])], axis=1).astype(np.float32)


def solve(landmarks: Landmarks, own_kernel, labels: list[str], kernels, ridge: float = RIDGE) -> Classifier:
    """The classifier from the landmarks' kernel matrix and the examples' labels and kernel rows (examples by landmarks)."""
    import numpy as np

    languages = sorted(set(labels))
    values, vectors = np.linalg.eigh(np.asarray(own_kernel, np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # kernel row @ root are the Nystroem features
    phi = np.asarray(kernels, np.float64) @ root
    own = np.array([languages.index(label) for label in labels])
    y = np.where(own[:, None] == np.arange(len(languages)), 1.0, -1.0)
    weight = 1.0 / np.bincount(own)[own] * len(own)  # each language counts alike
    scaled = phi * weight[:, None]
    w = np.linalg.solve(phi.T @ scaled + ridge * weight.sum() * np.eye(phi.shape[1]) / phi.shape[1], scaled.T @ y)
    return Classifier(languages, landmarks.column, landmarks.weights(root @ w))


def nothing_learned() -> Classifier:
    import numpy as np

    return Classifier([], np.zeros(BINS, np.int32), np.zeros((0, 0), np.float32))


def fit(examples: list, landmarks_per_language: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Classifier:
    """Fits on (language, ascending integer array of hashed n-grams) examples; those first in each language are the landmarks."""
    import numpy as np

    examples = [(lang, bins) for lang, bins in examples if len(bins)]
    if not examples:
        return nothing_learned()
    languages = len({lang for lang, _ in examples})
    taken: dict[str, int] = {}
    marks = []
    for lang, bins in examples:
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= quota(landmarks_per_language, LANDMARKS, languages):
            marks.append(bins)
    landmarks = Landmarks(marks)
    own = [landmarks.kernel(np.asarray(bins)[:LANDMARK_GRAMS]) for bins in marks]
    return solve(landmarks, own, [lang for lang, _ in examples], [landmarks.kernel(bins) for _, bins in examples], ridge)


def quota(each: int, altogether: int, languages: int) -> int:
    return max(1, min(each, altogether // max(1, languages)))


def held_out(key):
    """True for a quarter of the documents, by the checksum of the id's text."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(documents: DataFrame, key: str, text: str, label: str, per_language: int) -> tuple[DataFrame, int]:
    """(label, h, text) of the sample and its number of languages: of each label the texts of least hash.

    A threshold on the hash of the id, from one count of ids for each label, leaves a few times the wanted rows; only
    these are ranked, so no task sees more of a label than that, however many rows it has. Of rows with the same label and
    id the least text counts.
    """
    rows = documents.where(F.col(label).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key)))
    rows = rows.select(F.col(label).alias("label"), F.xxhash64(F.lit(7), F.col(key).cast("string")).alias("h"), F.col(text).alias("text"))
    counted = rows.groupBy("label").agg(F.approx_count_distinct("h").alias("ids")).limit(MOST_LANGUAGES + 1).collect()
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    wanted = quota(per_language, TEXTS, len(counted))
    shares = [(r["label"], min(1.0, SURPLUS * (wanted + 20) / max(1, r["ids"]))) for r in counted]
    table = documents.sparkSession.createDataFrame(shares, "label string, share double")
    share_of_hash = (F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)))
    near = rows.join(F.broadcast(table), "label").where(share_of_hash < F.col("share"))  # a row for each language
    once = near.groupBy("label", "h").agg(F.min("text").alias("text"))
    first = Window.partitionBy("label").orderBy("h")
    return once.withColumn("n", F.row_number().over(first)).where(F.col("n") <= wanted), len(counted)


def learn(documents: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = TEXTS_PER_LANGUAGE) -> Classifier:
    """A classifier from a sample of the labelled rows that are not held out: per_language of each label, least hash first.

    Rows without label, text or letters are not learned from; a null id is no obstacle, all null ids are one id. More
    than MOST_LANGUAGES labels are refused. Without labelled rows nothing is learned. Reruns learn the same.
    """
    import numpy as np
    import pyarrow as pa

    sample, languages = training_sample(documents, key, text, label, per_language)
    if not languages:
        return nothing_learned()

    def grams(batches: Iterator) -> Iterator:
        for batch in batches:
            found = []
            for t in batch.column(2):
                bins = list(gram_bins(letter_codes(t.as_py())))
                found.append(np.unique(np.concatenate(bins)).astype(np.int32).tobytes() if bins else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["label", "h", "bins"])

    sample = written(sample.select("label", "h", "text").mapInArrow(grams, "label string, h long, bins binary").where(F.length("bins") > 0), "language-sample")
    marks = sample.withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy("h"))).where(F.col("n") <= quota(LANDMARKS_PER_LANGUAGE, LANDMARKS, languages))
    found = marks.select("label", "h", F.substring("bins", 1, 4 * LANDMARK_GRAMS).alias("bins")).orderBy("label", "h").collect()
    if not found:
        return nothing_learned()
    landmarks = Landmarks([np.frombuffer(r["bins"], np.int32) for r in found])
    model = documents.sparkSession.sparkContext.broadcast(landmarks)  # at most LANDMARKS * LANDMARK_GRAMS numbers

    def kernels(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = [model.value.kernel(np.frombuffer(b.as_buffer(), np.int32)).astype(np.float64).tobytes() for b in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["label", "h", "row"])

    examples = sample.mapInArrow(kernels, "label string, h long, row binary").orderBy("label", "h").collect()  # at most TEXTS * LANDMARKS numbers
    own = [landmarks.kernel(np.frombuffer(r["bins"], np.int32)) for r in found]
    return solve(landmarks, own, [r["label"] for r in examples], [np.frombuffer(r["row"], np.float64) for r in examples])


def predict(documents: DataFrame, classifier: Classifier, text: str = "text", lettered: str | None = None,
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Adds lang_pred and score (`names`). A null text, or one without letters, is `und` with score 0, and so is any if nothing was learned.

    `lettered` names a further column, true for texts with a letter. Columns of these names are replaced.
    """
    import pyarrow as pa

    model = documents.sparkSession.sparkContext.broadcast(classifier)  # bounded by the landmarks: see above
    added = [*names, *([lettered] if lettered else [])]
    kept = [c for c in documents.columns if c not in added]
    (body,) = free_names(documents, "_text")
    rows = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(body))

    def classify(batches: Iterator) -> Iterator:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                found = model.value.judge(part.column(part.num_columns - 1))
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                judged = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*columns, *judged[: len(added)]], names=[*kept, *added])

    empty = [F.lit(x).alias(name) for x, name in zip(("", 0.0, True), added)]
    schema = rows.select(*[F.col(f"`{c}`") for c in kept], *empty).schema
    return rows.mapInArrow(classify, schema)


def identify(documents: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score) of each row: learned from the labelled rows that are not held out.

    Null ids count as not held out. Equal texts get equal results; repeated rows come as often as they are there; of
    equally good languages the first by name is given. An empty table gives no rows.
    """
    classifier = learn(documents, key, text, label)
    return predict(documents.select(F.col(key).alias(key), held_out(F.col(key)).alias("held_out"), F.col(text).alias("_body")), classifier, "_body").drop("_body")
