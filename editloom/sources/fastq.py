"""FASTQ files as DataFrames.

`read_pairs` reads R1 and R2 in lockstep. Plain files, and gzip files made of BGZF blocks, are cut at any byte: a first
pass counts the line ends of each split, and their running sums say which line a split starts in. A record is four
lines, so each split of R1 knows the numbers of its records, and which split of R2 to look for them in. Other gzip files
are read by one task each.

`read_records` reads single files, given by paths and globs. They come from directory listings, with their sizes, and
many small ones share a partition. Records reach Spark as Arrow batches. Paths may be local or anything that pyarrow's
file systems read.
"""

from __future__ import annotations

import fnmatch
import json
import struct
import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.sequence import annotation_edits, annotation_reference, first_token, last_field, second_last_field
from .sinks import scratch

BATCH = 4096
#: Bytes that a task reads of R1, about; bytes of small files that share a partition.
SPLIT_BYTES = 64 << 20
_CHUNK = 1 << 20
PAIR_COLUMNS = ("lane", "ordinal", "name", "seq1", "qual1", "seq2", "qual2")
#: With both mates' names, and whether both records have their marks: @ and +.
CHECKED_SCHEMA = "lane int, ordinal long, name string, seq1 string, qual1 string, name2 string, seq2 string, qual2 string, marked boolean"
RECORD_SCHEMA = "path string, ordinal long, name string, seq string, plus string, qual string"
#: The start of a BGZF block up to the two bytes of its size.
_BGZF, _BGZF_EXTRA = b"\x1f\x8b\x08\x04", b"\x06\x00BC\x02\x00"


def _place(path: str):
    from pyarrow import fs

    if "://" not in path:
        path = f"file://{path.removeprefix('file:')}"
    return fs.FileSystem.from_uri(path)


def list_files(paths: list[str]) -> list[tuple[str, int]]:
    """(path, bytes) of paths and globs (* ? [ ] within a path's parts), in their order, a glob's files by name.

    Each directory is listed once, whatever the number of its files. A path that is not there is refused; a glob may match none.
    """
    from pyarrow import fs

    listed: dict = {}

    def children(files, folder: str) -> dict:
        at = (files.type_name, folder)
        if at not in listed:
            found = files.get_file_info(fs.FileSelector(folder or "/", allow_not_found=True))
            listed[at] = {x.base_name: x for x in found}
        return listed[at]

    out = []
    for path in paths:
        wild = next((i for i, c in enumerate(path) if c in "*?["), None)
        start = path if wild is None else path[: path.rindex("/", 0, wild)]  # URIs have no wildcards
        files, inner = _place(start)
        if wild is None:
            folder, _, name = inner.rpartition("/")
            info = children(files, folder).get(name)
            if info is None or info.type != fs.FileType.File:
                raise FileNotFoundError(f"there is no file {path}")
            out.append((path, info.size))
            continue
        found = [("", None)]
        for part in path[len(start) + 1 :].split("/"):
            found = [(f"{at}/{name}", info) for at, _ in found for name, info in sorted(children(files, inner + at).items()) if fnmatch.fnmatchcase(name, part)]
        out += [(start + at, info.size) for at, info in found if info.type == fs.FileType.File]
    return out


def _block_size(head: bytes) -> int | None:
    """Bytes of the BGZF block that starts with these 18 bytes, or None."""
    if len(head) < 18 or head[:4] != _BGZF or head[10:16] != _BGZF_EXTRA:
        return None
    return struct.unpack_from("<H", head, 16)[0] + 1


def _gzip_kind(path: str) -> str:
    """plain, bgzf (blocks) or gzip (one task)."""
    if not path.endswith(".gz"):
        return "plain"
    files, inner = _place(path)
    with files.open_input_stream(inner, compression=None) as f:
        return "bgzf" if _block_size(f.read(18)) else "gzip"


def _blocks(f, start: int, end: int | None) -> Iterator[bytes]:
    """What the BGZF blocks hold that start from `start` on, and before `end`.

    At an offset within a block the next one is found by its first bytes, and by the block that must follow it.
    """
    size = f.size()
    at = start
    while at < size:
        window = f.read_at(min(_CHUNK, size - at), at)
        found = window.find(_BGZF)
        while found >= 0:
            length = _block_size(window[found : found + 18]) if found + 18 <= len(window) else _block_size(f.read_at(18, at + found))
            if length and (at + found + length == size or _block_size(f.read_at(18, at + found + length))):
                break
            found = window.find(_BGZF, found + 1)
        if found >= 0:
            at += found
            break
        at += max(1, len(window) - len(_BGZF) + 1)
    while at < size and (end is None or at < end):
        data, upto = f.read_at(min(_CHUNK + (1 << 16), size - at), at), 0
        while upto < len(data) and (end is None or at + upto < end):
            length = _block_size(data[upto : upto + 18])
            if length is None:
                raise OSError(f"no BGZF block at byte {at + upto}")
            if upto + length > len(data):
                break
            yield zlib.decompress(data[upto : upto + length], 31)
            upto += length
        if not upto:
            raise EOFError("the last BGZF block is cut")
        at += upto


def _gunzip(f) -> Iterator[bytes]:
    """What gzip streams, one after the other, hold; zeros behind them are padding. What precedes an error is given first."""
    stream, inside = zlib.decompressobj(31), False
    try:
        while data := f.read(1 << 16):
            while data and (inside or data.strip(b"\0")):
                out = stream.decompress(data)
                inside, data = not stream.eof, stream.unused_data
                if stream.eof:
                    stream = zlib.decompressobj(31)
                yield out
    except zlib.error as error:
        raise OSError(f"no gzip stream: {error}") from error
    if inside:
        raise EOFError("the file ends within a gzip stream")


def _chunks(path: str, start: int = 0, end: int | None = None) -> Iterator[bytes]:
    """A file's contents from an offset on, decompressed; `end` ends it there, or with the block before it."""
    files, inner = _place(path)
    kind = _gzip_kind(path)
    if kind == "gzip":
        with files.open_input_stream(inner, compression=None) as f:
            yield from _gunzip(f)
        return
    with files.open_input_file(inner) as f:
        if kind == "bgzf":
            yield from _blocks(f, start, end)
            return
        size = f.size() if end is None else min(end, f.size())
        for at in range(start, size, _CHUNK):
            yield f.read_at(min(_CHUNK, size - at), at)


class _Lines:
    """A file's lines from an offset on, without the first `skip` line ends."""

    def __init__(self, path: str, start: int = 0, skip: int = 0):
        self.path, self.chunks, self.ready, self.rest, self.failed = path, _chunks(path, start), [], b"", None
        while skip:
            chunk = next(self.chunks, None)
            if chunk is None:
                return
            n = chunk.count(b"\n")
            if n < skip:
                skip -= n
                continue
            self.rest = chunk.split(b"\n", skip)[-1]
            skip = 0
        if self.rest:
            *self.ready, self.rest = self.rest.split(b"\n")

    def take(self, n: int) -> list[bytes]:
        """The next n lines, or those that are left. An error of reading comes after the lines before it."""
        ready = self.ready
        while len(ready) < n and self.chunks is not None:
            try:
                chunk = next(self.chunks, None)
            except (EOFError, OSError, zlib.error) as error:
                self.failed, chunk = error, None
            if chunk is None:
                self.chunks = None
                if self.rest and self.failed is None:
                    ready.append(self.rest)
                break
            *lines, self.rest = (self.rest + chunk).split(b"\n")
            ready += lines
        self.ready = ready[n:]
        return ready[:n]


def _columns(lines: list[bytes]):
    """name (without @), sequence, plus line, quality and marked, of lines that are a multiple of four."""
    import pyarrow as pa
    import pyarrow.compute as pc

    name, seq, plus, qual = (pc.utf8_rtrim(pa.array(lines[i::4], pa.string()), characters="\r") for i in range(4))
    at = pc.starts_with(name, "@")
    return pc.if_else(at, pc.utf8_slice_codeunits(name, 1), name), seq, plus, qual, pc.and_(at, pc.starts_with(plus, "+"))


def _must_be_marked(path: str, start: int, columns) -> None:
    if not columns[4].true_count == len(columns[4]):
        bad = columns[4].to_pylist().index(False)
        raise ValueError(f"{path}: record {start + bad} has no @ before its name, or no + in its third line: {columns[0][bad].as_py()!r}, {columns[2][bad].as_py()!r}")


def records(path: str) -> Iterator:
    """Batches of whole records as Arrow columns: name, sequence, plus line, quality. All but the last batch have BATCH rows.

    Stops at an incomplete record, with a warning. An error of reading is raised after the whole records before it; a
    record without @ and + is refused.
    """
    lines, start = _Lines(path), 0
    while found := lines.take(4 * BATCH):
        whole = len(found) // 4 * 4
        if whole:
            columns = _columns(found[:whole])
            _must_be_marked(path, start, columns)
            yield columns[:4]
            start += whole // 4
        if whole < len(found) and lines.failed is None and any(found[whole:]):
            warnings.warn(f"{path} ends within record {start}", stacklevel=2)
    if lines.failed is not None:
        raise lines.failed


def is_cut(path: str) -> bool:
    """True if a gzip file's bytes were all read without error, but end within a stream."""
    if not path.endswith(".gz"):
        return False
    files, inner = _place(path)
    with files.open_input_stream(inner, compression=None) as f:
        stream, inside = zlib.decompressobj(31), False
        while data := f.read(_CHUNK):
            while data:
                try:
                    stream.decompress(data)
                except zlib.error:
                    return False
                inside, data = not stream.eof, stream.unused_data
                if stream.eof:
                    stream = zlib.decompressobj(31)
    return inside


# Pairs


def _checked_lanes(r1: list[str], r2: list[str]) -> list[tuple]:
    """(lane, mate, path, bytes) of two lists that pair up; missing files are refused before any task starts."""
    found = [list_files([paths] if isinstance(paths, str) else paths) for paths in (r1, r2)]
    if len(found[0]) != len(found[1]):
        raise ValueError(f"r1 and r2 must list as many files, not {len(found[0])} and {len(found[1])}")
    if {path for path, _ in found[0]} & {path for path, _ in found[1]}:
        raise ValueError("a file is listed as r1 and as r2")
    return [(lane, mate, path, size) for mate, files in enumerate(found, 1) for lane, (path, size) in enumerate(files)]


def split_lines(spark: SparkSession, r1: list[str], r2: list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(lane, mate, path, start, before, begins, whole, lines): the splits of all files, a written table.

    `before` counts the line ends before the split, `begins` is false if it starts within a line, `lines` counts the
    file's lines. A gzip file without blocks is one split with `whole` true and unknown counts.
    """
    lanes = _checked_lanes(r1, r2)
    files = spark.createDataFrame(lanes, "lane int, mate int, path string, size long")
    splits = files.select("lane", "mate", "path", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("size", F.lit(1)) - 1, F.lit(split_bytes))).alias("start"))
    number = sum(-(-max(1, size) // split_bytes) for *_, size in lanes)
    splits = splits.withColumn("place", F.row_number().over(Window.orderBy("lane", "mate", "start")) - 1).repartitionById(min(number, 10_000), F.expr(f"place % {min(number, 10_000)}"))  # a row for each split

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["start"] and _gzip_kind(row["path"]) == "gzip":
                    continue
                whole, ends, last = not row["start"] and _gzip_kind(row["path"]) == "gzip", 0, None
                for chunk in () if whole else _chunks(row["path"], row["start"], row["start"] + split_bytes):
                    ends += chunk.count(b"\n")
                    last = chunk.endswith(b"\n") if chunk else last
                out.append((row["lane"], row["mate"], row["path"], row["start"], ends, last, whole))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lane", "mate", "path", "start", "ends", "last", "whole"])

    counted = splits.mapInArrow(count, "lane int, mate int, path string, start long, ends long, last boolean, whole boolean")
    earlier = Window.partitionBy("lane", "mate").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy("lane", "mate").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = counted.select("lane", "mate", "path", "start", F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("before"), F.coalesce(F.last("last", True).over(earlier), F.lit(True)).alias("begins"), "whole",
                           (F.sum("ends").over(all_) + F.when(F.last("last", True).over(all_), 0).otherwise(F.when(F.last("last", True).over(all_).isNull(), 0).otherwise(1))).alias("lines"))
    path = scratch(spark, "fastq-splits")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def pair_plan(splits: DataFrame) -> DataFrame:
    """(lane, r1, start1, skip1, r2, start2, skip2, first, n): what each task reads, n null to the shorter file's end.

    The split of R2 for a split of R1 is the last one that starts no later than the wanted line: found by order, without a join of ranges.
    """
    one_task = F.max("whole").over(Window.partitionBy("lane"))
    shorter = F.min(F.floor(F.col("lines") / 4)).over(Window.partitionBy("lane"))
    line = F.col("before") + F.when(F.col("begins"), 0).otherwise(1)
    by_start = Window.partitionBy("lane", "mate").orderBy("start")
    rows = splits.withColumn("one_task", one_task).withColumn("records", shorter).withColumn("line", line)
    rows = rows.withColumn("first", F.ceil(F.col("line") / 4)).withColumn("upto", F.least(F.coalesce(F.ceil(F.lead("line").over(by_start) / 4), F.col("records")), "records"))
    rows = rows.withColumn("n", F.when(~F.col("one_task"), F.col("upto") - F.col("first"))).where("IF(one_task, start = 0, mate = 2 OR n > 0)")
    wanted = F.when(F.col("mate") == 1, F.when(F.col("one_task"), 0).otherwise(4 * F.col("first"))).otherwise(F.when(F.col("one_task"), 0).otherwise(F.col("line")))
    order = Window.partitionBy("lane").orderBy("wanted", F.desc("mate"), "start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    second = F.last(F.when(F.col("mate") == 2, F.struct("path", "start", "before")), True).over(order)
    found = rows.withColumn("wanted", wanted).withColumn("second", second).where("mate = 1")
    return found.select("lane", F.col("path").alias("r1"), F.col("start").alias("start1"), F.when(F.col("one_task"), 0).otherwise(F.col("wanted") - F.col("before")).cast("long").alias("skip1"), F.col("second.path").alias("r2"), F.col("second.start").alias("start2"),
                        F.when(F.col("one_task"), 0).otherwise(F.col("wanted") - F.col("second.before")).cast("long").alias("skip2"), F.when(F.col("one_task"), 0).otherwise(F.col("first")).cast("long").alias("first"), F.col("n").cast("long").alias("n"))


def _read_pairs(batches: Iterator, strict: bool) -> Iterator:
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        for task in batch.to_pylist():
            one, two = _Lines(task["r1"], task["start1"], task["skip1"]), _Lines(task["r2"], task["start2"], task["skip2"])
            at, left = task["first"], task["n"]
            while left is None or left > 0:
                size = BATCH if left is None else min(BATCH, left)
                a, b = one.take(4 * size), two.take(4 * size)
                for lines in (one, two):
                    if lines.failed is not None:
                        raise lines.failed
                n = min(len(a), len(b)) // 4
                if not n:
                    break
                x, y = _columns(a[: 4 * n]), _columns(b[: 4 * n])
                if strict:
                    _must_be_marked(task["r1"], at, x)
                    _must_be_marked(task["r2"], at, y)
                marked = pc.and_(x[4], y[4])
                yield pa.RecordBatch.from_arrays([pa.array([task["lane"]] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), x[0], x[1], x[3], y[0], y[1], y[3], marked],
                                                 names=["lane", "ordinal", "name", "seq1", "qual1", "name2", "seq2", "qual2", "marked"])
                at += n
                left = None if left is None else left - n


def read_checked_pairs(spark: SparkSession, r1: list[str], r2: list[str], split_bytes: int = SPLIT_BYTES, strict: bool = True, splits: DataFrame | None = None) -> DataFrame:
    """As read_pairs, with name2, the mate's name, and marked; without strict, records without @ and + are given as they are."""
    plan = pair_plan(splits or split_lines(spark, r1, r2, split_bytes))
    path = scratch(spark, "fastq-plan")
    plan.withColumn("task", F.row_number().over(Window.orderBy("lane", "first")) - 1).write.parquet(path)  # a row for each task
    tasks = spark.read.parquet(path)
    number = min(10_000, max(1, tasks.count()))
    tasks = tasks.repartitionById(number, F.expr(f"CAST(task % {number} AS INT)")).drop("task")

    return tasks.mapInArrow(lambda batches: _read_pairs(batches, strict), CHECKED_SCHEMA)


def read_pairs(spark: SparkSession, r1: list[str], r2: list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(lane, ordinal, name, seq1, qual1, seq2, qual2) of lanes of paired files, given by paths or globs.

    Ordinals count a lane's records from 0. A lane ends with its shorter file. Records without @ or + are refused with
    the first example. The line ends of plain and BGZF files are counted before, which reads them once more.
    """
    return read_checked_pairs(spark, r1, r2, split_bytes).select(*PAIR_COLUMNS)


# Single files


@dataclass
class Files(InputPartition):
    paths: list[str]


class RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"])
        self.cut_files = options.get("cut_files", "true") == "true"
        self.pack_bytes = int(options.get("pack_bytes", SPLIT_BYTES))

    def partitions(self) -> list[Files]:
        """Files in order, as many to a partition as have pack_bytes together; a larger one is a partition of its own."""
        packed: list[list[str]] = []
        room = 0
        for path, size in list_files(self.paths):
            if not packed or size > room:
                packed.append([])
                room = self.pack_bytes
            packed[-1].append(path)
            room -= size
        return [Files(p) for p in packed] or [Files([])]

    def read(self, partition: Files) -> Iterator:
        import pyarrow as pa

        for path in partition.paths:
            start = 0
            for columns in self._whole(path):
                n = len(columns[0])
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(range(start, start + n), pa.int64()), *columns], names=["path", "ordinal", "name", "seq", "plus", "qual"])
                start += n

    def _whole(self, path: str) -> Iterator:
        """Whole records; with cut_files, a compressed stream that is proven to be cut ends with its last one. Other errors fail the task."""
        try:
            yield from records(path)
        except (EOFError, OSError, zlib.error) as error:
            if not (self.cut_files and is_cut(path)):
                raise
            warnings.warn(f"{path} is cut: {error}", stacklevel=2)


class RecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq_records"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options)


def read_records(spark: SparkSession, paths: list[str] | str, cut_files: bool = True, pack_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, ordinal, name, seq, plus, qual) of files given by paths or globs.

    cut_files: gzip files that end within a stream are read up to there, as filtered alleles are; otherwise they fail.
    """
    spark.dataSource.register(RecordSource)
    listed = json.dumps([paths] if isinstance(paths, str) else list(paths))
    return spark.read.format("fastq_records").options(paths=listed, cut_files=str(cut_files).lower(), pack_bytes=str(pack_bytes)).load()


def annotated_reads(files: DataFrame) -> DataFrame:
    """(read_id, cell, aln_ref, ann, seq) of records whose plus line holds an annotation; others have empty fields."""
    token = first_token(F.col("name"))
    return files.select(token.alias("read_id"), last_field(token).alias("cell"), annotation_reference(F.col("plus")).alias("aln_ref"), annotation_edits(F.col("plus")).alias("ann"), "seq")


def filtered_alleles(files: DataFrame) -> DataFrame:
    """(amplicon, cell, seq): the amplicon from the name of the file's folder, the cell from the second-to-last field of the id."""
    folder = F.regexp_extract("path", r"_on_([^/]+)/[^/]*$", 1)
    return files.select(folder.alias("amplicon"), second_last_field(first_token(F.col("name"))).alias("cell"), "seq").where("cell IS NOT NULL")
