from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from editloom.llm import language

ALPHABETS = ["abcdef", "ghijkl", "mnopqr", "абвгде", "αβγδεζ", "stuvwx"]


def texts_of(language_number, count, seed=0):
    r = np.random.default_rng([language_number, seed])
    letters = ALPHABETS[language_number % len(ALPHABETS)] + chr(0x4E00 + language_number)
    return [" ".join("".join(r.choice(list(letters), r.integers(2, 9))) for _ in range(r.integers(5, 60))) for _ in range(count)]


def bins_of(text):
    found = list(language.gram_bins(language.letter_codes(text)))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def plain_margins(examples, tests, per_language):
    """Explicit kernel, landmarks and weighted ridge, with Python sets."""
    def kernel(a, b):
        a, b = set(a), set(b)
        return len(a & b) / (len(a) * len(b)) ** 0.5

    languages = sorted({lang for lang, _ in examples})
    marks = [b for lang in languages for b in [b for own, b in examples if own == lang][:per_language]]
    features = {g for m in marks for g in m}
    seen = [[g for g in b if g in features] for _, b in examples]
    k = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(k)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = np.array([[kernel(a, b) for b in marks] for a in seen]) @ root
    y = np.array([[1.0 if own == lang else -1.0 for lang in languages] for own, _ in examples])
    counts = [sum(own == lang for own, _ in examples) for lang in languages]
    weight = np.array([len(examples) / counts[languages.index(own)] for own, _ in examples])
    left = (phi * weight[:, None]).T @ phi + language.RIDGE * weight.sum() * np.eye(phi.shape[1]) / phi.shape[1]
    w = np.linalg.solve(left, (phi * weight[:, None]).T @ y)
    rows = [[g for g in bins_of(t) if g in features] for t in tests]
    return languages, np.array([[kernel(a, b) for b in marks] for a in rows]) @ root @ w


def test_scores_are_those_of_the_explicit_kernel():
    examples = [(f"l{i}", bins_of(t)) for i in range(4) for t in texts_of(i, 12 + i)]
    tests = [t for i in range(4) for t in texts_of(i, 5, seed=9)]
    found = language.fit(examples, landmarks_per_language=5).judge(tests)
    languages, margins = plain_margins(examples, tests, 5)
    best = margins.argmax(axis=1)
    assert [f[0] for f in found] == [languages[b] for b in best] == [f"l{i}" for i in range(4) for _ in range(5)]
    assert np.allclose([f[1] for f in found], np.clip((margins.max(axis=1) + 1) / 2, 0, 1), atol=1e-4)


def test_learning_in_spark_gives_the_same_as_fitting_on_the_driver(spark):
    rows = [(100 * i + j, t, f"l{i}") for i in range(3) for j, t in enumerate(texts_of(i, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample, _ = language.training_sample(docs, "doc_id", "text", "lang", 20)
    ordered = sorted((r["label"], r["h"], r["text"]) for r in sample.collect())
    assert len(ordered) == 60
    want = language.fit([(label, bins_of(t)) for label, _, t in ordered])
    got = language.learn(docs, per_language=20)
    assert got.languages == want.languages and np.array_equal(got.column, want.column) and np.allclose(got.weights, want.weights, atol=1e-5)


def test_fifty_languages_fit_in_bounded_memory():
    import tracemalloc

    examples = [(f"l{i:02d}", bins_of(t)) for i in range(50) for t in texts_of(i, 120)]
    tracemalloc.start()
    model = language.fit(examples)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 30
    tests = [(f"l{i:02d}", t) for i in range(50) for t in texts_of(i, 3, seed=5)]
    assert np.mean([f[0] == lang for f, (lang, _) in zip(model.judge([t for _, t in tests]), tests)]) > 0.95


def test_a_hot_label_is_not_ranked_whole(spark):
    """20,000 rows of one label: the threshold leaves a small part of them to the ranking."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('some text ', id) AS text", "'en' AS lang")
    sample, _ = language.training_sample(docs, "doc_id", "text", "lang", 50)
    assert sample.count() == 50
    rows = docs.selectExpr("shiftrightunsigned(xxhash64(7, cast(doc_id as string)), 11) / double(1L << 53) AS share")
    assert rows.where(f"share < {language.SURPLUS * 70 / 14000}").count() < 1000


def test_languages_are_filled_in(spark):
    rows = [(100 * i + j, t, f"l{i}" if j % 4 else None) for i in range(3) for j, t in enumerate(texts_of(i, 60))] + [(None, "abc", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'kept' AS _predicted", "1 AS score", "2 AS _lettered")
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, "")
    found = kept.collect()
    assert kept.columns == docs.columns and len(found) == 181 and {(r["_predicted"], r["score"], r["_lettered"]) for r in found} == {("kept", 1, 2)}
    assert all(r["lang"] == f"l{r['doc_id'] // 100}" for r in found if r["doc_id"] is not None)


@pytest.mark.parametrize("label", [None, "en"])
def test_lettered_documents_stay_when_nothing_is_learned(spark, label):
    """Without labels, or with labels on the held-out quarter only."""
    rows = [(i, f"clean words {i}", label) for i in range(60)] + [(100, "123 !", None), (101, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.where(language.held_out(docs["doc_id"]) | (docs["doc_id"] >= 100)) if label else docs
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, "")
    want = sorted(r["doc_id"] for r in docs.where("doc_id < 100").collect())
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == want != []


def test_more_labels_than_the_bound_are_refused_before_any_cut(spark):
    rows = [(i, f"text {i}", f"l{i % 250}") for i in range(2000)]
    with pytest.raises(ValueError, match="more than 200 languages"):
        language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=1)
