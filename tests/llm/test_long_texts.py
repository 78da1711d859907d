"""Texts that pattern matchers, quadratic merges or one-piece encoders do not survive, against the tokenizers library."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from editloom.llm import queries, token_counts
from editloom.llm.byte_bpe import byte_bpe, long_spaces

from . import brute

PATH = queries.tokenizer_path("byte_bpe_50k.json")
UNITS = {"spaces": " ", "line ends": "\n", "tabs": "\t", "ideographs": "漢", "signs": "=", "digits": "7", "letters": "a", "crlf": "\r\n", "ideographic spaces": "\u3000"}


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def encoded(text, **sizes):
    return np.concatenate(list(token_counts.encode_in_chunks(byte_bpe(PATH), text, **sizes))).tolist()


@pytest.mark.parametrize("unit", UNITS)
@pytest.mark.parametrize("tail", ["", "x y", "<|endoftext|>z"])
def test_many_characters_of_a_kind(unit, tail):
    text = UNITS[unit] * ((200_000 if tail else 2_000_000) // len(UNITS[unit])) + tail
    assert encoded(text) == library().encode(text, add_special_tokens=False).ids


def test_both_queries_take_such_texts(spark, tmp_path):
    texts = [" " * 1_000_000, "a" + "\n" * 1_000_000 + "b", "漢" * 500_000, None, "short"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    want = [library().encode(t or "", add_special_tokens=False).ids for t in texts]
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op4_token_counts(spark, f"file://{tmp_path}").collect()}
    assert [got[i] for i in range(len(texts))] == [len(w) for w in want]
    files = {r["doc_id"]: r["ids_crc32"] for r in queries.op9_token_files(spark, f"file://{tmp_path}").collect()}
    assert [files[i] for i in range(len(texts))] == [brute.crc([*w, 0]) for w in want]


@pytest.mark.parametrize("seed", range(4))
def test_splices_of_random_texts(seed):
    """Chunks that begin and end anywhere: within runs, contractions, characters of several bytes and added tokens."""
    r = random.Random(seed)
    parts = ["a", "the", " the", " ", "  ", "\n", "\r\n", "'s", "'", "'re", "1", "½", "漢", "é", "😀", "!", "==", "<|endoftext|>", "<|endof", "text|>", "\u3000", "\x85", "ing",
             "a" * 30, " " * 40, "漢" * 25, "=" * 33, "\n" * 17]
    own = library()
    for _ in range(400):
        some = [r.choice(parts) for _ in range(r.randint(1, 8))]
        text = "".join(r.choice(some) for _ in range(r.randint(1, 100)))
        want = own.encode(text, add_special_tokens=False).ids
        for chunk_chars, overlap_chars in ((60, 30), (97, 40), (200, 100)):
            assert encoded(text, chunk_chars=chunk_chars, overlap_chars=overlap_chars) == want, repr(text)


def test_overlaps_widen_until_chunks_align():
    encoder, widths = byte_bpe(PATH), []

    class Seen:
        byte_lengths, apostrophe, longest_added = encoder.byte_lengths, encoder.apostrophe, encoder.longest_added

        @staticmethod
        def encode(text):
            widths.append(len(text))
            return encoder.encode(text)

    text = "=" * 4999 + "a b c d e f g " * 100  # tokens of 64 signs: a chunk from within the run is out of step
    ids = np.concatenate(list(token_counts.encode_in_chunks(Seen, text, 500, 40))).tolist()
    assert ids == library().encode(text, add_special_tokens=False).ids and max(widths) > 4999


def test_unspaced_text_takes_time_in_proportion():
    took = []
    for n in (1_000_000, 4_000_000):
        began = time.process_time()
        token_counts_of = sum(map(len, token_counts.encode_in_chunks(byte_bpe(PATH), "漢" * n)))
        took.append(time.process_time() - began)
        assert token_counts_of == 3 * n
    assert took[1] < 10 * took[0] + 1


def test_long_spaces():
    text = "a" + " " * 5000 + "b" + "\n" * 4000 + "c " * 3000 + "\t" * 10_000
    assert list(long_spaces(text)) == [(1, 5001), (len(text) - 10_001, len(text))]
    assert list(long_spaces("")) == list(long_spaces("x" * 10_000)) == []
