"""FASTQ pairs cut at any byte, in plain files and BGZF blocks; listing, globs and packing."""

from __future__ import annotations

import gzip
import random
import struct
import zlib

import pytest

from editloom.sources import fastq


def bgzf(data: bytes, block: int) -> bytes:
    out = b""
    for i in [*range(0, len(data), block), len(data)]:  # ends with an empty block
        part = data[i : i + block]
        deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = deflate.compress(part) + deflate.flush()
        head = b"\x1f\x8b\x08\x04" + bytes(6) + b"\x06\x00BC\x02\x00" + struct.pack("<H", 18 + len(body) + 8 - 1)
        out += head + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


def mates(n, seed=1, end="\n"):
    r = random.Random(seed)
    pairs = [(f"r{i} x", *["".join(r.choices("ACGT@+", k=r.randrange(1, 9))) for _ in range(2)]) for i in range(n)]
    text = [end.join(x for name, *seqs in pairs for x in (f"@{name}", seqs[m], "+", "@" * len(seqs[m]))) + end for m in (0, 1)]
    return pairs, [t.encode() for t in text]


def read(spark, one, two, size):
    rows = fastq.read_pairs(spark, [f"file://{one}"], [f"file://{two}"], split_bytes=size).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in rows] == list(range(len(rows)))
    assert all(r["qual1"] == "@" * len(r["seq1"]) and r["qual2"] == "@" * len(r["seq2"]) for r in rows)
    return [(r["name"], r["seq1"], r["seq2"]) for r in rows]


@pytest.mark.parametrize("size", [1, 7, 50, 1 << 20])
def test_plain_files_are_cut_at_any_byte(spark, tmp_path, size):
    """Size 1 cuts at every byte."""
    pairs, text = mates(6)
    one, two = tmp_path / "a.fastq", tmp_path / "b.fastq"
    one.write_bytes(text[0])
    two.write_bytes(text[1][:-1])  # without the last line end
    assert read(spark, one, two, size) == pairs


@pytest.mark.parametrize("size", [23, 64, 1 << 20])
def test_blocks_are_splits(spark, tmp_path, size):
    pairs, text = mates(12, 2, "\r\n")
    one, two = tmp_path / "a.fastq.gz", tmp_path / "b.fastq.gz"
    one.write_bytes(bgzf(text[0], 30))
    two.write_bytes(bgzf(text[1], 41))
    assert read(spark, one, two, size) == pairs
    assert fastq.pair_plan(fastq.split_lines(spark, [f"file://{one}"], [f"file://{two}"], 64)).count() > 3


def test_lanes_of_all_kinds(spark, tmp_path):
    """A plain gzip file makes its lane one task; a cut mate ends its lane; empty files give no rows."""
    pairs, text = mates(9, 3)
    files = {"a1.fq": text[0], "a2.fq": text[1][:-5], "b1.fq.gz": gzip.compress(text[0]), "b2.fq": text[1], "c1.fq": b"", "c2.fq": text[1]}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    rows = fastq.read_pairs(spark, f"file://{tmp_path}/?1.*", f"file://{tmp_path}/?2.*", split_bytes=20).orderBy("lane", "ordinal").collect()
    assert [(r["lane"], r["name"], r["seq1"], r["seq2"]) for r in rows] == [(0, *p) for p in pairs] [: len(pairs) - 1] + [(1, *p) for p in pairs]


def test_records_without_marks_are_refused(spark, tmp_path):
    _, text = mates(5, 4)
    (tmp_path / "a").write_bytes(text[0])
    (tmp_path / "b").write_bytes(text[1].replace(b"@r3", b"r3"))
    one, two = [f"file://{tmp_path}/a"], [f"file://{tmp_path}/b"]
    with pytest.raises(Exception, match="record 3 has no @"):
        fastq.read_pairs(spark, one, two).collect()
    rows = fastq.read_checked_pairs(spark, one, two, strict=False).orderBy("ordinal").collect()
    assert [(r["name2"], r["marked"]) for r in rows] == [(f"r{i} x", i != 3) for i in range(5)]


def test_globs_and_names_with_commas(spark, tmp_path):
    for folder in ("run_on_A", "run_on_B,2", "other"):
        (tmp_path / folder).mkdir()
        for name in ("x,1.fq", "y.fq", "z.txt"):
            (tmp_path / folder / name).write_text(f"@id:{folder}:c\nAC\n+\nII\n")
    found = [p.removeprefix(f"file://{tmp_path}/") for p, size in fastq.list_files([f"file://{tmp_path}/run_on_*/*.fq"])]
    assert found == ["run_on_A/x,1.fq", "run_on_A/y.fq", "run_on_B,2/x,1.fq", "run_on_B,2/y.fq"]
    rows = fastq.filtered_alleles(fastq.read_records(spark, f"{tmp_path}/run_on_*/x,1.fq")).collect()
    assert sorted(tuple(r) for r in rows) == [("A", "run_on_A", "AC"), ("B,2", "run_on_B,2", "AC")]
    assert fastq.list_files([f"{tmp_path}/nothing*/*"]) == [] and fastq.read_records(spark, f"{tmp_path}/nothing*").count() == 0


def test_many_small_files_share_partitions(tmp_path, monkeypatch):
    from pyarrow import fs

    for i in range(3000):
        (tmp_path / f"f{i:04d}.fq").write_bytes(b"@r\nA\n+\nI\n")
    calls = []
    real = fs.LocalFileSystem.get_file_info
    monkeypatch.setattr(fastq, "_place", lambda path, place=fastq._place: (Counting(place(path)[0], calls), place(path)[1]))
    import json

    for paths in ([f"file://{tmp_path}/*.fq"], [f"file://{tmp_path}/f{i:04d}.fq" for i in range(3000)]):
        calls.clear()
        parts = fastq.RecordReader({"paths": json.dumps(paths), "pack_bytes": "10000"}).partitions()
        assert len(parts) == 3 and sum(len(p.paths) for p in parts) == 3000 and len(calls) == 1
    assert real


class Counting:
    def __init__(self, files, calls):
        self.files, self.calls, self.type_name = files, calls, files.type_name

    def get_file_info(self, what):
        self.calls.append(what)
        return self.files.get_file_info(what)
