"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of a range of documents in ascending key order: blocks of `BLOCK` ids, a table of the documents
and an index of block starts. A block stores its minimum, the low bits of each difference from it at the width that
holds the chosen percentile of the differences, and the positions and values of those that need more bits.

Layout, all numbers little-endian:
  blocks        each: uint32 minimum, uint16 ids, uint16 exceptions, uint8 width, packed bits,
                uint16 positions of the exceptions, uint32 their differences from the minimum
  documents     int64 keys, uint8 null flags, uint64 id counts
  index         uint64 start of each block, uint64 end of the last one
  trailer       uint64 documents, uint64 blocks, uint64 ids, 8 bytes magic
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import byte_bpe
from .common import hashed_text, range_cuts, range_number, shared_folder, written
from .token_counts import encode_in_chunks

BLOCK = 1024
PERCENTILE = 0.95
MAGIC = b"PFORIDS1"
_HEAD = struct.Struct("<IHHB")
_TRAILER = struct.Struct("<QQQ8s")
#: Blocks that are packed or unpacked at once.
GROUP = 256
#: Text of one file, about.
FILE_BYTES = 256 << 20


def _bits(values, width: int):
    """The low `width` bits of each value of a 2-d array, packed row by row."""
    import numpy as np

    if width == 0:
        return np.zeros((len(values), 0), np.uint8)
    size = 2 if width <= 16 else 4
    raw = np.ascontiguousarray(values.astype(f"<u{size}")).view(np.uint8).reshape(*values.shape, size)
    bits = np.unpackbits(raw, axis=2, bitorder="little")[:, :, :width]
    return np.packbits(bits.reshape(len(values), -1), axis=1, bitorder="little")


def _values(packed, width: int, n: int):
    """Inverse of _bits: rows of n values."""
    import numpy as np

    if width == 0:
        return np.zeros((len(packed), n), np.uint32)
    size = 2 if width <= 16 else 4
    bits = np.unpackbits(packed, axis=1, count=n * width, bitorder="little").reshape(len(packed), n, width)
    full = np.zeros((len(packed), n, size * 8), np.uint8)
    full[:, :, :width] = bits
    return np.packbits(full, axis=2, bitorder="little").view(f"<u{size}").reshape(len(packed), n).astype(np.uint32)


def pack_blocks(ids) -> list[bytes]:
    """Blocks of a uint32 array; all but the last have BLOCK ids."""
    import numpy as np

    n = len(ids)
    count = -(-n // BLOCK)
    padded = np.full(count * BLOCK, ids[-1] if n else 0, np.uint32)
    padded[:n] = ids
    rows = padded.reshape(count, BLOCK)
    least = rows.min(axis=1)
    over = rows - least[:, None]
    at = min(BLOCK - 1, int(PERCENTILE * BLOCK))
    widths = np.array([int(x).bit_length() for x in np.partition(over, at, axis=1)[:, at]])
    out: list[bytes] = [b""] * count
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        part = over[chosen]
        packed = _bits(part & np.uint32((1 << int(width)) - 1), int(width))
        for i, row, bits in zip(chosen.tolist(), part, packed, strict=True):
            outliers = np.flatnonzero(row >> np.uint32(width)) if width < 32 else np.zeros(0, int)
            size = min(BLOCK, n - i * BLOCK)
            out[i] = _HEAD.pack(int(least[i]), size, len(outliers), int(width)) + bits.tobytes() + outliers.astype("<u2").tobytes() + row[outliers].astype("<u4").tobytes()
    return out


def unpack_blocks(blocks: list[bytes]):
    """The ids of consecutive blocks, one uint32 array."""
    import numpy as np

    heads = [_HEAD.unpack_from(b) for b in blocks]
    rows = np.empty((len(blocks), BLOCK), np.uint32)
    widths = np.array([h[3] for h in heads])
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        size = BLOCK * int(width) // 8
        packed = np.stack([np.frombuffer(blocks[i], np.uint8, size, _HEAD.size) for i in chosen])
        rows[chosen] = _values(packed, int(width), BLOCK)
    for i, (_, _, exceptions, width) in enumerate(heads):
        if exceptions:
            at = _HEAD.size + BLOCK * width // 8
            positions = np.frombuffer(blocks[i], "<u2", exceptions, at)
            rows[i, positions] = np.frombuffer(blocks[i], "<u4", exceptions, at + 2 * exceptions)
    rows += np.array([h[0] for h in heads], np.uint32)[:, None]
    return np.concatenate([row[: h[1]] for row, h in zip(rows, heads, strict=True)]) if heads else np.zeros(0, np.uint32)


class FileWriter:
    """Writes under a name of its own; close() moves the whole file to its place, so that a lost or repeated task does no harm."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        self.fs, root = fs.FileSystem.from_uri(folder)
        self.path, self.own = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.fs.create_dir(root, recursive=True)
        self.out = self.fs.open_output_stream(self.own)
        self.keys, self.nulls, self.counts, self.starts = array("q"), bytearray(), array("Q"), array("Q", [0])
        self.rest: list = []
        self.waiting = 0
        self.ids = 0

    def add(self, key: int | None, ids: Iterator) -> None:
        """A document's ids come in parts, so that a huge one is never held whole."""
        before = self.ids
        for part in ids:
            self.rest.append(part)
            self.waiting += len(part)
            self.ids += len(part)
            if self.waiting >= GROUP * BLOCK:
                self._write(self.waiting // BLOCK * BLOCK)
        self.keys.append(key or 0)
        self.nulls.append(key is None)
        self.counts.append(self.ids - before)

    def _write(self, n: int) -> None:
        import numpy as np

        ids = np.concatenate(self.rest)
        for lo in range(0, n, GROUP * BLOCK):
            blocks = pack_blocks(ids[lo : min(n, lo + GROUP * BLOCK)])
            for b in blocks:
                self.starts.append(self.starts[-1] + len(b))
            self.out.write(b"".join(blocks))
        self.rest, self.waiting = [ids[n:]], len(ids) - n

    def close(self) -> dict:
        import numpy as np

        if self.waiting:
            self._write(self.waiting)
        self.out.write(np.array(self.keys, "<i8").tobytes() + bytes(self.nulls) + np.array(self.counts, "<u8").tobytes() + np.array(self.starts, "<u8").tobytes())
        self.out.write(_TRAILER.pack(len(self.keys), len(self.starts) - 1, self.ids, MAGIC))
        self.out.close()
        self.fs.move(self.own, self.path)
        return {"docs": len(self.keys), "ids": self.ids}


def read_file(folder: str, name: str) -> Iterator[tuple[int | None, int, int, int]]:
    """(key, start in the file, ids, crc32 of the ids as little-endian uint32) of each document, in file order."""
    import numpy as np
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(folder)
    with files.open_input_file(f"{root}/{name}") as f:
        end = f.size()
        docs, blocks, _, magic = _TRAILER.unpack(f.read_at(_TRAILER.size, end - _TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{name} is no token file")
        at = end - _TRAILER.size - 8 * (blocks + 1) - 17 * docs
        keys = np.frombuffer(f.read_at(8 * docs, at), "<i8")
        nulls = f.read_at(docs, at + 8 * docs)
        counts = np.frombuffer(f.read_at(8 * docs, at + 9 * docs), "<u8")
        starts = np.frombuffer(f.read_at(8 * (blocks + 1), at + 17 * docs), "<u8")
        ready, block, start = np.zeros(0, np.uint32), 0, 0
        for i in range(docs):
            want, crc = int(counts[i]), 0
            left = want
            while left:
                if not len(ready):
                    upto = min(blocks, block + GROUP)
                    base = int(starts[block])
                    raw = f.read_at(int(starts[upto]) - base, base)
                    ready = unpack_blocks([raw[int(a) - base : int(b) - base] for a, b in zip(starts[block:upto], starts[block + 1 : upto + 1], strict=True)])
                    block = upto
                part, ready = ready[:left], ready[left:]
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                left -= len(part)
            yield (None if nulls[i] else int(keys[i])), start, want, crc
            start += want


def write_token_files(documents: DataFrame, tokenizer_file: str, end_id: int | None, key: str = "doc_id", text: str = "text",
                      file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Writes the ids of all texts, each followed by end_id, and returns the folder and a manifest (bucket, name, docs, ids).

    One task and file per key range, in ascending key order inside, with about `file_bytes` of text or less; null keys
    come last, equal keys by a hash of the text, so that a key of many rows is spread over several files. A null text is
    empty. Repeated rows are written as often as they come. An empty table gives no file.
    """
    import math

    spark = documents.sparkSession
    folder = shared_folder(spark, "token-files")
    docs = documents.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / file_bytes))
    cuts = range_cuts(docs, F.col("key"), files)
    rows = docs.withColumn("tie", hashed_text("text"))
    rows = rows.withColumn("bucket", range_number(F.col("key"), F.col("tie"), cuts)).repartitionById(len(cuts) + 1, "bucket")
    rows = rows.sortWithinPartitions("bucket", F.col("key").asc_nulls_last(), "tie", "text").select("key", "text", "bucket")

    def write(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder = byte_bpe(tokenizer_file)
        ending = np.array([] if end_id is None else [end_id], np.uint32)
        done: list[dict] = []
        writer, bucket = None, None

        def ids(text: str) -> Iterator:
            yield from encode_in_chunks(encoder, text)
            yield ending

        for batch in batches:
            for k, t, b in zip(*batch.columns, strict=True):
                b = b.as_py()
                if b != bucket:
                    if writer:
                        done.append({"bucket": bucket, "name": f"ids-{bucket:06d}.pfor"} | writer.close())
                    writer, bucket = FileWriter(folder, f"ids-{b:06d}.pfor"), b
                writer.add(k.as_py(), ids(t.as_py()))
        if writer:
            done.append({"bucket": bucket, "name": f"ids-{bucket:06d}.pfor"} | writer.close())
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("bucket", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

    return folder, written(rows.mapInArrow(write, "bucket int, name string, docs long, ids long"), "token-manifest")


def read_token_files(folder: str, manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each document, read from the files; start counts the ids of all files before."""
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files = manifest.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    last = manifest.agg(F.max("bucket")).first()[0]
    files = files.repartitionById(1 + (last or 0), "bucket")  # one file for each task

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for file in batch.to_pylist():
                rows: list[tuple] = []
                for k, start, n, crc in read_file(folder, file["name"]):
                    rows.append((k, file["before"] + start, n, crc))
                    if len(rows) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return files.mapInArrow(read, "key long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)
