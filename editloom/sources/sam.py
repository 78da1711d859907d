"""Name-sorted SAM text, paired where it is read.

Mates follow each other, so a task pairs the lines of its byte range without a shuffle. The group of a name belongs to
the range in which its first line starts: a task looks back for the name of the line before its range, skips what
continues that group, and reads on behind its range until its own last group ends. Header lines are passed over; the
first empty line ends a file. A gzip file is read by one task, as it cannot be cut.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .fastq import SPLIT_BYTES, _chunks, _place, list_files

_CHUNK = 1 << 20
#: Bytes that a task reads, about, if its splits are smaller.
TASK_BYTES = 32 << 20
#: The fields that are read of a line, by number.
FIELDS = {"flag": 1, "chr": 2, "pos": 3, "mapq": 4, "cigar": 5, "seq": 9, "qual": 10}
_INTS = ("flag", "pos", "mapq")


def pair_schema(position: str = "int") -> str:
    """The columns of all names; positions are of type position, int or bigint."""
    return "qname string, records int, firsts int, " + ", ".join(f"{c}{i} {position if c == 'pos' else 'int' if c in _INTS else 'string'}" for i in (1, 2) for c in FIELDS)


def _whole_lines(path: str) -> Iterator[tuple[int, bytes]]:
    """(number, line) of a gzip file's lines up to the first empty one."""
    number, rest = 0, b""
    for chunk in _chunks(path):
        *lines, rest = (rest + chunk).split(b"\n")
        for line in lines:
            if not line:
                return
            yield number, line
            number += 1
    if rest:
        yield number, rest


def _lines(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that start from `start`, the start of a line, on and before `end`."""
    at, rest = start, b""
    size = f.size()
    while at < end:
        upto = at + len(rest)
        data = f.read_at(min(_CHUNK, size - upto), upto) if upto < size else b""
        if not data:
            if rest:
                yield at, rest
            return
        *lines, rest = (rest + data).split(b"\n")
        for line in lines:
            if at >= end:
                return
            yield at, line
            at += len(line) + 1


def _line_before(f, start: int) -> tuple[int, bytes]:
    """(start of the first line that starts at `start` or behind it, the line before that)."""
    size, back, end = f.size(), 0, start - 1  # a line that starts at `start` has its line end before it
    while True:
        data = f.read_at(min(_CHUNK, size - end), end) if end < size else b""
        if not data:
            return size, b""
        found = data.find(b"\n")
        if found >= 0:
            end += found
            break
        end += len(data)
    while True:
        back = min(end, max(256, 2 * back))
        data = f.read_at(back, end - back)
        found = data.rfind(b"\n")
        if found >= 0 or back == end:
            return end + 1, data[found + 1 :]


def _name(line: bytes) -> bytes:
    return line.split(b"\t", 1)[0]


def empty_line(f, start: int, end: int) -> int | None:
    """Offset of the first empty line that starts in the range; at the end of a file there is none."""
    at = max(0, start - 1)
    if start == 0 and f.size() and f.read_at(1, 0) == b"\n":
        return 0
    while at < end:
        data = f.read_at(min(_CHUNK + 1, end + 1 - at), at)
        found = data.find(b"\n\n")
        if found >= 0:
            return at + found + 1
        at += max(1, len(data) - 1)
        if len(data) < 2:
            return None
    return None


def _groups(f, start: int, split_end: int, end: int) -> Iterator[list[bytes]]:
    """The lines of each name whose group starts in the range."""
    if start:
        start, before = _line_before(f, start)
        skipping = None if before.startswith(b"@") else _name(before)
    else:
        skipping = None
    return _grouped(_lines(f, start, end), skipping, split_end)


def _grouped(lines: Iterator[tuple[int, bytes]], skipping: bytes | None = None, split_end: int | None = None) -> Iterator[list[bytes]]:
    """The lines of each name, after those of the name `skipping`, whose first line is before split_end."""
    group: list[bytes] = []
    name = None
    for at, line in lines:
        line = line.rstrip(b"\r")
        own = _name(line)
        if line.startswith(b"@") and name is None and skipping is None:
            continue
        if own == skipping:
            continue
        skipping = None
        if own != name:
            if group:
                yield group
            if split_end is not None and at >= split_end:
                return
            group, name = [], own
        group.append(line)
    if group:
        yield group


def _row(group: list[bytes]) -> tuple:
    """Of a name's records: their number, how many are first mates, and the fields of the first and the second mate where there is one of each."""
    fields = [line.decode().split("\t") for line in group]
    second = [int(x[1]) & 0x80 != 0 for x in fields]
    picked = [None] * (2 * len(FIELDS))
    if len(fields) == 2 and sum(second) == 1:
        picked = [int(x[i]) - (c == "pos") if c in _INTS else x[i] if i < len(x) else None for x in sorted(fields, key=lambda x: int(x[1]) & 0x80) for c, i in FIELDS.items()]
    return (fields[0][0], len(fields), second.count(False), *picked)


def name_sorted_pairs(spark: SparkSession, paths: list[str] | str, split_bytes: int = SPLIT_BYTES, position: str = "int") -> tuple[DataFrame, DataFrame]:
    """Pairs (qname, then flag, chr, pos, mapq, cigar, seq, qual of each mate, with 1 and 2 behind) and the names that are none (qname, records, firsts).

    pos is 0-based, as elsewhere, and of type position. A name whose group is not one first and one second mate is in the second table, with
    its numbers of records and of first mates; a name that comes in several places, as in files that are not sorted by
    name, is there several times. Nothing is shuffled but the list of splits; a plain file is looked through once before
    for an empty line, which ends it. Files that end with .gz are a split each.
    """
    files = list_files([paths] if isinstance(paths, str) else paths)
    table = spark.createDataFrame(files, "path string, size long").where("size > 0")
    step = F.when(F.col("path").endswith(".gz"), F.col("size")).otherwise(F.lit(split_bytes))
    splits = table.select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, step)).alias("start"))
    number = max(1, sum(1 if path.endswith(".gz") else -(-size // split_bytes) for path, size in files))
    # Small splits share a task: a task has costs of its own, and there are two for each split.
    tasks = min(number, 10_000, max(2 * spark.sparkContext.defaultParallelism, -(-sum(size for _, size in files) // TASK_BYTES)))
    splits = splits.withColumn("place", F.row_number().over(Window.orderBy("path", "start")) - 1).repartitionById(tasks, F.expr(f"CAST(place % {tasks} AS INT)"))  # a row for each split

    def look(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["path"].endswith(".gz"):
                    continue
                fs, inner = _place(row["path"])
                with fs.open_input_file(inner) as f:
                    at = empty_line(f, row["start"], min(row["size"], row["start"] + split_bytes))
                if at is not None:
                    found.append((row["path"], at))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([a for _, a in found], pa.int64())], names=["path", "at"])

    ends = {r["path"]: r["at"] for r in splits.mapInArrow(look, "path string, at long").groupBy("path").agg(F.min("at").alias("at")).collect()}  # at most a row for each file

    schema = pair_schema(position)

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        of = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
        names, types = zip(*[(x.split()[0], of[x.split()[1]]) for x in schema.split(", ")], strict=True)

        def batch_of(rows: list[tuple]):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        def groups(row: dict) -> Iterator[list[bytes]]:
            if row["path"].endswith(".gz"):
                yield from _grouped(_whole_lines(row["path"]))
                return
            fs, inner = _place(row["path"])
            end = min(row["size"], ends.get(row["path"], row["size"]))
            if row["start"] < end:
                with fs.open_input_file(inner) as f:
                    yield from _groups(f, row["start"], row["start"] + split_bytes, end)

        for batch in batches:
            for row in batch.to_pylist():
                rows: list[tuple] = []
                for group in groups(row):
                    rows.append(_row(group))
                    if len(rows) == 4096:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    found = splits.mapInArrow(read, schema)
    pair = (F.col("records") == 2) & (F.col("firsts") == 1)
    return found.where(pair).drop("records", "firsts"), found.where(~pair).select("qname", "records", "firsts")
