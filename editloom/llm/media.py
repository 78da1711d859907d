"""Media columns: payloads in archives, read by a Spark data source.

`write_archives` stores payloads as members of zip archives. The data source `media_archive` plans one partition per
byte range of an archive, from names and sizes of the archives alone. A partition's reader takes the members whose
headers start in its range from the archive's directory, reads each by its own offset, again if that fails, and
streams batches of them through Arrow. A member that cannot be read keeps its row, with the error in place of its bytes.
"""

from __future__ import annotations

import contextlib
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .common import shared_folder, written

ARCHIVE_BYTES = 128 << 20
RANGE_BYTES = 32 << 20
BATCH_BYTES = 8 << 20
TRIES = 3
SCHEMA = "archive string, member string, offset long, media binary, error string"


@dataclass
class ByteRange(InputPartition):
    archive: str
    start: int
    end: int


def _waits(tries: int) -> list[float]:
    """Seconds between tries: a tenth, then four times as long each."""
    return [0.1 * 4**i for i in range(tries - 1)]


class _Handle:
    """An archive that is opened when it is read from, and again after close()."""

    def __init__(self, files, path: str):
        self.files, self.path, self.opened = files, path, None

    def file(self):
        if self.opened is None:
            self.opened = self.files.open_input_file(self.path)
        return self.opened

    def close(self) -> None:
        if self.opened is not None:
            with contextlib.suppress(OSError):
                self.opened.close()
            self.opened = None


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.tries = int(options.get("tries", TRIES))

    def partitions(self) -> list[ByteRange]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(self.path)
        found = [f for f in files.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.extension == "zip" and not f.base_name.startswith(".")]
        ranges = [ByteRange(f.base_name, a, min(f.size, a + self.range_bytes)) for f in found for a in range(0, f.size, self.range_bytes)]
        return ranges or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        if not partition.archive:
            return
        files, root = fs.FileSystem.from_uri(self.path)
        path = f"{root}/{partition.archive}"
        schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("media", pa.binary()), ("error", pa.string())])
        for wait in (*_waits(self.tries), None):
            try:
                with files.open_input_file(path) as f, zipfile.ZipFile(f) as z:
                    members = sorted((m for m in z.infolist() if partition.start <= m.header_offset < partition.end), key=lambda m: m.header_offset)
                break
            except OSError:
                if wait is None:
                    raise  # the task fails, and Spark runs it again elsewhere
                time.sleep(wait)
        rows: list[tuple] = []
        size = 0
        with contextlib.closing(_Handle(files, path)) as handle:
            for m in members:
                media, error = self._member(handle, m)
                rows.append((partition.archive, m.filename, m.header_offset, media, error))
                size += len(media or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    def _member(self, handle: _Handle, m: zipfile.ZipInfo) -> tuple[bytes | None, str | None]:
        """(media, None), or (None, error) after all tries; each try after the first waits and opens the archive anew."""
        error = None
        for wait in (None, *_waits(self.tries)):
            try:
                if wait is not None:
                    time.sleep(wait)
                f = handle.file()
                name, extra = struct.unpack("<HH", f.read_at(30, m.header_offset)[26:30])
                raw = f.read_at(m.compress_size, m.header_offset + 30 + name + extra)
                media = zlib.decompress(raw, -15) if m.compress_type == zipfile.ZIP_DEFLATED else raw
                if zlib.crc32(media) != m.CRC:
                    raise ValueError("checksum differs")
                return media, None
            except (OSError, ValueError, zlib.error, struct.error) as e:
                error = f"{type(e).__name__}: {e}"
                handle.close()
        return None, error


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


class ArchiveWriter:
    """Writes one archive under a name of its own and moves it to its place when whole."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        self.fs, root = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(root, recursive=True)
        self.path, self.own = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.own)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
        self.bytes = 0

    def add(self, name: str, media: bytes) -> None:
        self.zip.writestr(zipfile.ZipInfo(name), media, zipfile.ZIP_DEFLATED, 1)
        self.bytes += len(media)

    def close(self) -> None:
        self.zip.close()
        self.out.close()
        self.fs.move(self.own, self.path)


def write_archives(rows: DataFrame, key: str, payload: str, pack: Callable[[bytes], bytes], suffix: str = ".wav") -> str:
    """Stores pack(payload) of each row as a member `<key>-<number><suffix>` and returns the folder of archives.

    Each task writes archives of up to ARCHIVE_BYTES, named by its partition, so a repeated task writes the same ones.
    A null key is written `null`, a null payload as no bytes.
    """
    folder = shared_folder(rows.sparkSession, "archives")

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, archives, members, writer = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            for k, p in zip(batch.column(0), batch.column(1), strict=True):
                if writer is None:
                    writer = ArchiveWriter(folder, f"part-{part:05d}-{archives:05d}.zip")
                    archives += 1
                name = "null" if k.as_py() is None else str(k.as_py())
                writer.add(f"{name}-{part}-{members}{suffix}", pack(p.as_py() or b""))
                members += 1
                if writer.bytes >= ARCHIVE_BYTES:
                    writer.close()
                    writer = None
        if writer:
            writer.close()
        yield pa.RecordBatch.from_pydict({"archives": [archives], "members": [members]})

    written(rows.select(F.col(key).cast("long"), F.col(payload).cast("binary")).mapInArrow(write, "archives long, members long"), "archive-manifest")
    return folder


def read_archives(spark: SparkSession, folder: str, **options) -> DataFrame:
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("media_archive").options(path=folder, **options).load()


# Texts as 8-bit samples

UNIT = 64


def to_wave(text: bytes) -> bytes:
    """A RIFF/WAVE file of one channel of unsigned 8-bit samples: the text, then bytes 0 up to a positive multiple of UNIT.

    A chunk `tlen` before the samples holds the length of the text. Equal texts give equal files.
    """
    samples = text.ljust(max(UNIT, -(-len(text) // UNIT) * UNIT), b"\0")
    chunks = b"fmt " + struct.pack("<IHHIIHH", 16, 1, 1, 8000, 8000, 1, 8) + b"tlen" + struct.pack("<IQ", 8, len(text)) + b"data" + struct.pack("<I", len(samples)) + samples
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def from_wave(media: bytes) -> tuple[int, bytes]:
    """(length of the text, samples)."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("no RIFF/WAVE file")
    at, found = 12, {}
    while at + 8 <= len(media):
        size = struct.unpack_from("<I", media, at + 4)[0]
        found[media[at : at + 4]] = media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    return struct.unpack("<Q", found[b"tlen"])[0], found[b"data"]


def wave_feature(samples: bytes) -> str:
    """Mean, deviation, peak and crossings of the middle line of the samples."""
    import numpy as np

    x = np.frombuffer(samples, np.uint8)
    above = x >= 128
    crossings = int(np.count_nonzero(above[1:] != above[:-1]))
    mean = int(x.sum(dtype=np.int64)) / len(x)
    square = int(np.square(x, dtype=np.int64).sum()) / len(x)
    return f"mean={mean:.4f};dev={max(0.0, square - mean * mean) ** 0.5:.4f};peak={int(x.max())};crossings={crossings}"


def wave_features(archives: DataFrame, key: str = "doc_id") -> DataFrame:
    """Digests and features of the members that write_archives stored with to_wave; unreadable members raise."""
    import hashlib

    import pyarrow as pa

    schema = pa.schema([(key, pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
                        ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])

    def features(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for name, media, error in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                if error:
                    raise OSError(f"{name}: {error}")
                media = media.as_py()
                n, samples = from_wave(media)
                k = name.rsplit("-", 2)[0]
                rows.append((None if k == "null" else int(k), n, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-UNIT:]),
                             len(media), hashlib.sha256(media).hexdigest(), wave_feature(samples)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    ddl = f"`{key}` long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return archives.select("member", "media", "error").mapInArrow(features, ddl)
