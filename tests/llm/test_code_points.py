"""op2's words against the tokenizers library on every code point, alone and beside combining marks."""

from __future__ import annotations

import unicodedata

import pytest

from editloom.llm import bpe, queries


@pytest.fixture(scope="module")
def encoder():
    return bpe.SegmentTreeBpe(queries.tokenizer_path("word_bpe_49k.json"))


def differing(encoder, samples):
    found = [s for s in samples if not s.isascii() and encoder._cut(s) != encoder._cut_by_library(s)]
    return [f"{[hex(ord(c)) for c in s]}" for s in found[:5]]


def test_checked_ranges_cut_alike(encoder):
    """Every code point of the ranges that Python's own tables cut, alone and beside a mark above and one below."""
    points = [chr(c) for a, z in bpe.CHECKED for c in range(a, z + 1)]
    assert not any(bpe._OTHERS.search(c) for c in points) and len(points) > 90_000
    assert differing(encoder, (f"A{c}B 1 a{c}\u0301 {c}\u0323 a\u0301{c} \u0323{c}" for c in points)) == []


def test_marks_of_the_ranges_cut_alike(encoder):
    marks = [chr(c) for a, z in bpe.CHECKED for c in range(a, z + 1) if unicodedata.combining(chr(c))]
    assert all(0x300 <= ord(c) <= 0x36F for c in marks)
    assert differing(encoder, (f"{letter}{m}{n}" for letter in "ao\u03b9" for m in marks for n in marks)) == []


def test_other_code_points_are_the_library_s(encoder):
    """The library's ids for all other code points, those that only some tables know among them, in stretches of 256."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    inside = {c for a, z in bpe.CHECKED for c in range(a, z + 1)}
    others = [c for c in range(0x110000) if c not in inside and not 0xD800 <= c < 0xE000]
    assert {0x0558, 0x088F, 0x1C89, 0xA7CB, 0x10940, 0x07FD, 0x08D3, 0x0C3C, 0x1AC0, 0x1DF6, 0x0EBA} <= set(others)
    samples = ["".join(f"A{chr(c)}B 1 a{chr(c)}\u0301 {chr(c)}\u0323 " for c in others[i : i + 256]) for i in range(0, len(others), 256 if len(others) < 50_000 else 4096)]
    samples += [f"A{chr(c)}B 1 {chr(c)}\u0301{chr(c)}\u0323" for c in others if unicodedata.combining(chr(c)) or unicodedata.category(chr(c)) == "Cn"][::7]
    import numpy as np

    for lo in range(0, len(samples), 512):
        part = samples[lo : lo + 512]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_batch(part)] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
