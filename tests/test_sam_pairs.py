"""Name-sorted SAM text: pairs and odd names, however the file is cut."""

from __future__ import annotations

import pytest

from editloom.sources import sam


def line(name, flag, pos=10):
    return f"{name}\t{flag}\tchr1\t{pos}\t40\t4M\t*\t0\t0\tACGT\tIIII"


NAMES = ["a", "bb", "c", "dd", "e", "f"]
LINES = ["@HD\tVN:1.0", "@SQ\tSN:chr1"] + [line(n, f, i) for i, n in enumerate(NAMES) for f in {"bb": (64,), "dd": (64, 128, 320), "e": (128, 64)}.get(n, (64, 144))]
PAIRS = [("a", 64, 144), ("c", 64, 144), ("e", 64, 128), ("f", 64, 144)]
ODD = [("bb", 1, 1), ("dd", 3, 2)]


def read(spark, path, size):
    pairs, odd = sam.name_sorted_pairs(spark, f"file://{path}", size)
    return sorted((r["qname"], r["flag1"], r["flag2"]) for r in pairs.collect()), sorted(tuple(r) for r in odd.collect()), pairs


@pytest.mark.parametrize("size, end, empty", [(37, "\r\n", False), (100, "\n", True), (1 << 20, "\n", False)])
def test_pairs_are_the_same_however_the_file_is_cut(spark, tmp_path, size, end, empty):
    text = end.join(LINES) + ("\n\n" + line("after", 64) + "\n" + line("after", 128) + "\n" if empty else end if size != 100 else "")
    (tmp_path / "x.sam").write_bytes(text.encode())
    pairs, odd, df = read(spark, tmp_path / "x.sam", size)
    assert (pairs, odd) == (PAIRS, ODD)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "qname" not in "".join(x for x in plan.split("\n") if "Exchange" in x) and "Join" not in plan  # only the list of splits is dealt out


def test_every_cut(tmp_path):
    """Each split size, and so each byte as the start of a split."""
    import pyarrow as pa

    for end in ("\n", "\r\n"):
        data = end.join([*LINES[:7], line("c", 144, 3)]).encode()
        f = pa.BufferReader(data)
        whole = [b"".join(g) for g in sam._groups(f, 0, len(data), len(data))]
        assert len(whole) == 3
        for size in range(1, len(data) + 1):
            assert [b"".join(g) for at in range(0, len(data), size) for g in sam._groups(f, at, at + size, len(data))] == whole


def test_fields_and_odd_files(spark, tmp_path):
    (tmp_path / "x.sam").write_text(line("a", 64, 11) + "\n" + line("a", 128, 21))
    pairs, _ = sam.name_sorted_pairs(spark, f"file://{tmp_path}/x.sam")
    assert tuple(pairs.first()) == ("a", 64, "chr1", 10, 40, "4M", "ACGT", "IIII", 128, "chr1", 20, 40, "4M", "ACGT", "IIII")
    for name, text in (("none", ""), ("headers", "@HD\n@SQ\n"), ("empty", "\n" + line("a", 64))):
        (tmp_path / name).write_text(text)
        assert read(spark, tmp_path / name, 3)[:2] == ([], [])
    (tmp_path / "long").write_text("n" * 3000 + line("a", 64) + "\n" + "n" * 3000 + line("a", 128) + "\n" + line("z", 64) + "\n")
    assert read(spark, tmp_path / "long", 700)[1] == [("z", 1, 1)] and len(read(spark, tmp_path / "long", 700)[0]) == 1
