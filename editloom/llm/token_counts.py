"""Token counts by overlap resynchronisation.

A text of more than `chunk_chars` code points is encoded in chunks that overlap. Byte offsets show which tokens two
neighbouring chunks both have on the same bytes of their overlap; after the first of them the left chunk's tokens stop
and the right one's go on. Such a common token proves that the splice is what the whole text gives:

* Tokens that only some part of a text shows are right if each token and its next one are what that pair alone gives.
  Both chunks' tokens are, and the pairs around the common token lie in one chunk or the other.
* The pattern splits both chunks alike after it. It looks at no earlier text; a token of a space and what follows it
  starts a match; any other token lies within a run of letters, of numbers, of white space or of other characters, and
  the run's match ends where the run ends, in both. Tokens with an apostrophe are not taken: it may start a contraction.
* It is no part of an added token that one chunk cuts, as it keeps the longest added token's length from both ends.

Where the overlap has no common token (a run of one character whose tokens are out of step), it is widened fourfold, to
the end of the text if need be. Work stays in proportion to the text, and memory is bounded where chunks come into step.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import ByteBpe, byte_bpe
from .common import free_names

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024


def common_token(encoder: ByteBpe, left, right, shared: int) -> tuple[int, int] | None:
    """Places (in left, in right) of the first token that both have on the same bytes of the last and first `shared` bytes."""
    import numpy as np

    lengths, margin = encoder.byte_lengths, encoder.longest_added
    ends = lengths[left].cumsum()
    ends -= ends[-1] - shared
    first = int((ends - lengths[left]).searchsorted(margin))
    last = int(ends.searchsorted(shared - margin, side="right"))
    if first >= last:
        return None
    own = (ends - lengths[left])[first:last]
    others = lengths[right].cumsum() - lengths[right]
    others = others[: others.searchsorted(shared)]
    _, i, k = np.intersect1d(own, others, assume_unique=True, return_indices=True)
    ids = left[first:last][i]
    good = np.flatnonzero((ids == right[k]) & ~encoder.apostrophe[ids])
    return (first + int(i[good[0]]), int(k[good[0]])) if len(good) else None


def encode_in_chunks(encoder: ByteBpe, text: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> Iterator:
    """Arrays of ids that together are those of the whole text."""
    n = len(text)
    upto, skip = min(n, chunk_chars), 0
    left, start = encoder.encode(text[:upto]), 0
    while upto < n:
        overlap = min(overlap_chars, upto - start)
        right_start = upto - overlap
        while True:
            right_end = min(n, right_start + max(chunk_chars, 2 * overlap))
            right = encoder.encode(text[right_start:right_end])
            found = common_token(encoder, left, right, len(text[right_start:upto].encode("utf-8", "surrogatepass")))
            if found and found[0] >= skip:
                yield left[skip : found[0] + 1]
                left, start, skip, upto = right, right_start, found[1] + 1, right_end
                break
            overlap *= 4
            upto = min(n, right_start + overlap)
            left = encoder.encode(text[start:upto])
            if upto == n:
                break
    yield left[skip:]


def token_counts(documents: DataFrame, tokenizer_file: str, text: str = "text", chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS, limit: int = 1024) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit (n_tokens > limit) to the columns of documents other than the text.

    A null text counts as empty: no bytes, no tokens. Every row keeps its own result, repeated rows too; an empty table
    gives no rows; columns named like the added ones are replaced. A row's chunks are encoded one after the other by one
    task, without a shuffle.
    """
    added = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in documents.columns if c != text and c.lower() not in added]
    (body,) = free_names(documents, "_text")
    rows = documents.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.coalesce(F.col(text), F.lit("")).alias(body))

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder = byte_bpe(tokenizer_file)
        for batch in batches:
            counts = [sum(map(len, encode_in_chunks(encoder, t.as_py(), chunk_chars, overlap_chars))) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], names=[*kept, "n_bytes", "n_tokens"])

    counted = rows.mapInArrow(count, rows.select(*[F.col(f"`{c}`") for c in kept], "n_bytes", F.lit(0).cast("long").alias("n_tokens")).schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
