"""Cost-balanced packing of token ids into sequences.

What a sequence costs a model is linear in its tokens and, in attention, quadratic in the length of each piece. Each
task packs the documents that it reads, in windows of a bounded number of tokens, without a shuffle:

* A document's ids are cut into whole sequences' worth; such a piece is a sequence of its own. What is left of the
  documents waits in the window.
* The window's tokens are as many as the capacities of its sequences: whole ones, then one for each power of two that
  the rest is the sum of. So no sequence needs padding: each is full, or as long as a power of two.
* Pieces go in descending order of length, and so of cost, each to the sequence of the lowest cost so far among those
  that have room for all of it. Where none has, the piece is cut: the sequence of the lowest cost among those with any
  room is filled up, and what is left of the piece is placed in its turn.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_bpe
from .token_counts import encode_in_chunks

#: Tokens of a sequence.
CAPACITY = 2048
#: Cost of a token, and of a pair of tokens of one piece: the two terms are equal for a piece of 12,288 tokens.
LINEAR, QUADRATIC = 12_288, 1
#: Tokens that wait in a window, about: some thousand sequences, 16 MB.
WINDOW_TOKENS = 1 << 22

_PER_WINDOW = 1 << 33


def capacities(tokens: int, capacity: int):
    """Room of each sequence: together exactly `tokens`, each the whole capacity or a lesser power of two, in descending order."""
    import numpy as np

    whole, rest = divmod(tokens, capacity)
    return np.array([capacity] * whole + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1], np.int64)


def assign(lengths, room, linear: int = LINEAR, quadratic: int = QUADRATIC) -> list[tuple[int, int, int, int]]:
    """(piece, its tokens before, tokens, sequence) of pieces placed in sequences of the given room, in the order of placing.

    Pieces of equal length are placed in their order; of sequences of equal cost the first is taken. The room must
    suffice for all.
    """
    import numpy as np

    room = np.array(room, np.int64)
    cost = np.zeros(len(room), np.int64)
    waiting = [(-int(n), i, 0) for i, n in enumerate(lengths)]
    heapq.heapify(waiting)
    never = np.iinfo(np.int64).max
    placed = []
    while waiting:
        negative, piece, before = heapq.heappop(waiting)
        length = -negative
        sequence = int(np.where(room >= length, cost, never).argmin())
        if room[sequence] < length:
            sequence = int(np.where(room > 0, cost, never).argmin())
        part = min(length, int(room[sequence]))
        placed.append((piece, before, part, sequence))
        room[sequence] -= part
        cost[sequence] += linear * part + quadratic * part * part
        if part < length:
            heapq.heappush(waiting, (part - length, piece, before + part))
    return placed


class _Window:
    """Pieces of documents in sequences, as columns: key, start, ids, doc_tokens, sequence_id, offset."""

    def __init__(self, capacity: int, costs: tuple[int, int], first: int):
        self.capacity, self.costs, self.sequence = capacity, costs, first
        self.out: list[tuple] = []
        self.size = 0
        self.rest: list[tuple] = []
        self.tokens = 0

    def add(self, key: int | None, parts: Iterator) -> None:
        """A document's ids come in parts; whole sequences are cut off as soon as they are there."""
        import numpy as np

        held, waiting, start, whole = [], 0, 0, []
        for part in parts:
            held.append(part)
            waiting += len(part)
            if waiting >= self.capacity:
                ids = np.concatenate(held)
                n = waiting // self.capacity * self.capacity
                whole += [(start + i, ids[i : i + self.capacity].astype("<u4").tobytes()) for i in range(0, n, self.capacity)]
                held, waiting, start = [ids[n:]], waiting - n, start + n
        total = start + waiting
        for at, ids in whole:
            self._put(key, at, ids, total, self.sequence, 0)
            self.sequence += 1
        if waiting:
            self.rest.append((key, start, np.concatenate(held).astype("<u4"), total))
            self.tokens += waiting

    def _put(self, key, start, ids, total, sequence, offset) -> None:
        self.out.append((key, start, ids, total, sequence, offset))
        self.size += len(ids)

    def pack(self) -> None:
        """Places what waits; the window is empty then."""
        room = capacities(self.tokens, self.capacity)
        filled = [0] * len(room)
        for piece, before, n, sequence in assign([len(r[2]) for r in self.rest], room, *self.costs):
            key, start, ids, total = self.rest[piece]
            self._put(key, start + before, ids[before : before + n].tobytes(), total, self.sequence + sequence, filled[sequence])
            filled[sequence] += n
        self.sequence += len(room)
        self.rest, self.tokens = [], 0

    def batch(self):
        import pyarrow as pa

        schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
        columns = zip(*self.out, strict=True) if self.out else [[]] * len(schema)
        found = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        self.out, self.size = [], 0
        return found


def pack_documents(documents: DataFrame, tokenizer_file: str, end_id: int, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   linear: int = LINEAR, quadratic: int = QUADRATIC, window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """(key, start, ids, doc_tokens, sequence_id, offset): pieces of documents in sequences of at most `capacity` tokens.

    A document's ids are those of its text, then end_id; each is in exactly one piece. `ids` holds them as little-endian
    unsigned 32-bit numbers, `start` counts the document's ids before them, `offset` the sequence's. Sequences have
    numbers of their own, not gapless. A null text is empty, and so one id; rows without a key, and repeated rows, are
    documents of their own; an empty table gives no rows; further columns are left out.

    Which documents share sequences follows from how Spark splits the table: a task that is run again packs alike.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"the capacity must be a power of two, but is {capacity}")
    rows = documents.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        from pyspark import TaskContext

        encoder, ending = byte_bpe(tokenizer_file), np.array([end_id], np.uint32)
        window = _Window(capacity, (linear, quadratic), TaskContext.get().partitionId() * _PER_WINDOW)

        def ids(text: str) -> Iterator:
            yield from encode_in_chunks(encoder, text)
            yield ending

        for batch in batches:
            for k, t in zip(*batch.columns, strict=True):
                window.add(k.as_py(), ids(t.as_py()))
                if window.tokens >= window_tokens:
                    window.pack()
                if window.size >= window_tokens:
                    yield window.batch()
        window.pack()
        yield window.batch()

    packed = rows.mapInArrow(pack, "key long, start long, ids binary, doc_tokens long, sequence_id long, offset long")
    return packed.withColumnRenamed("key", key)
