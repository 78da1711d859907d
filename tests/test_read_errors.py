from __future__ import annotations

import gzip
import json
import random

import pyarrow as pa
import pytest

from editloom.sources import fastq

RECORD = "@id:9:CELL x\nACGT\n+\nIIII\n"


def reader(*paths, **options):
    return fastq.RecordReader({"paths": json.dumps(paths)} | options)


def read(path):
    return [b.num_rows for b in reader(path).read(fastq.Files([path]))]


def test_errors_of_files_fail_the_read(tmp_path):
    with pytest.raises(OSError):
        read(f"file://{tmp_path}/missing.fastq")
    (tmp_path / "broken.fastq.gz").write_bytes(b"no gzip at all, but long enough to be read")
    with pytest.raises(OSError):
        read(f"file://{tmp_path}/broken.fastq.gz")


def test_a_transient_error_is_raised(tmp_path, monkeypatch):
    with gzip.open(tmp_path / "a.fastq.gz", "wt") as f:
        f.write(RECORD * 10)

    def failing(path):
        yield [pa.array([x]) for x in "abcd"]
        raise OSError("connection reset")

    monkeypatch.setattr(fastq, "records", failing)
    with pytest.raises(OSError, match="reset"):
        read(f"file://{tmp_path}/a.fastq.gz")


def test_a_cut_stream_ends_with_a_warning(tmp_path):
    path = tmp_path / "cut.fastq.gz"
    with gzip.open(path, "wt") as f:
        f.write(RECORD * 50)
    path.write_bytes(path.read_bytes()[:-12])
    with pytest.warns(UserWarning, match="is cut"):
        read(f"file://{path}")
    with pytest.raises((EOFError, OSError)):
        list(reader(f"file://{path}", cut_files="false").read(fastq.Files([f"file://{path}"])))


def test_batches_number_on_and_lines_are_trimmed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fastq, "BATCH", 3)
    for name, n in (("a", 8), ("b", 7)):
        (tmp_path / name).write_bytes(b"".join(b"@@r%d x\r\nAC\n+\nII\r\r\n" % i for i in range(n)) + b"@part\nA\n+\n")
    one, two = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    with pytest.warns(UserWarning, match="within record 8"):
        got = [r for b in reader(one).read(fastq.Files([one])) for r in b.to_pylist()]
    assert [(r["ordinal"], r["name"], r["seq"], r["plus"], r["qual"]) for r in got] == [(i, f"@r{i} x", "AC", "+", "II") for i in range(8)]
    assert [r["ordinal"] for r in fastq.read_pairs(spark, [one], [two]).orderBy("ordinal").collect()] == list(range(7))
    (tmp_path / "none").write_bytes(b"")
    assert read(f"file://{tmp_path}/none") == []


def test_a_cut_stream_keeps_the_records_before_the_cut(tmp_path):
    r, path = random.Random(2), tmp_path / "long.fastq.gz"
    with gzip.open(path, "wt") as f:
        f.write("".join(f"@r{i}\n{''.join(r.choices('ACGT', k=60))}\n+\n{'I' * 60}\n" for i in range(6000)))
    path.write_bytes(path.read_bytes()[:-200])
    with pytest.warns(UserWarning, match="is cut"):
        assert 5000 < sum(read(f"file://{path}")) < 6000


def test_missing_files_are_refused_before_any_task(tmp_path):
    (tmp_path / "a.fastq").write_text(RECORD)
    there, missing = f"file://{tmp_path}/a.fastq", f"file://{tmp_path}/b.fastq"
    with pytest.raises(FileNotFoundError, match="b.fastq"):
        fastq._checked_lanes([there], [missing])
    with pytest.raises(FileNotFoundError, match="b.fastq"):
        reader(there, missing).partitions()
    assert len(reader(there).partitions()) == 1
