"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of a word's tree are the merge ranks of its adjacent symbol pairs, ties broken by place; the root is the
leftmost pair of lowest rank. Merging it changes two neighbouring leaves and removes one, so each merge updates three
paths to the root, until the root says that no pair can be merged. The trees of many words are rows of the same numpy
arrays and merge in step; few words, like a single huge one, are merged one by one. Words repeat, so encoded words are
kept in a bounded cache of each Python worker.

Texts are cut into words by Python's Unicode tables where those are known to agree with the tokenizers library's: all
characters of the text are in CHECKED, which a test compares with the library, code point by code point. Other texts
(rare marks, scripts and characters that only one of the tables knows) are cut by the library's own normalizer and
pre-tokenizer; merging is the same for all.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_characters

#: Ranges of code points on which unicodedata, regex and the library's own tables cut alike, alone and beside the marks among them.
CHECKED = ((0x0000, 0x0482), (0x048A, 0x0557), (0x05D0, 0x05EA), (0x0620, 0x064A), (0x0660, 0x066F), (0x1E00, 0x208E), (0x20A0, 0x20C0), (0x2100, 0x2BFF),
           (0x3000, 0x3029), (0x3030, 0x3096), (0x309B, 0xA48C), (0xAC00, 0xD7A3), (0xF900, 0xFAFF), (0xFF01, 0xFFEF), (0x1F000, 0x1FAFF), (0x20000, 0x2B738))
_OTHERS = re.compile("[^" + "".join(f"{chr(a)}-{chr(z)}" for a, z in CHECKED).replace("\\", r"\\") + "]")

NO_PAIR = 2**62
FEW = 16  # a step of numpy's calls costs about as much as a merge in each of so many single trees


class SegmentTreeBpe:
    """The encoder that a tokenizers JSON file describes: NFC and lower case, a split pattern, byte level, merges with a word end."""

    def __init__(self, tokenizer_file: str, keep_words: int = 600_000):
        import numpy as np

        with open(tokenizer_file, encoding="utf-8") as f:
            stated = json.load(f)
        model = stated["model"]
        steps = [s["type"] for s in (stated["normalizer"] or {}).get("normalizers", [])]
        split, level = (stated["pre_tokenizer"] or {}).get("pretokenizers", [{}, {}])
        if steps != ["NFC", "Replace", "Lowercase"] or split.get("type") != "Split" or not split.get("invert") or level.get("type") != "ByteLevel" or level.get("use_regex") or stated["decoder"]:
            raise ValueError(f"{tokenizer_file} describes another kind of tokenizer")
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        added = {t["content"]: t["id"] for t in stated["added_tokens"]}
        # White space is never part of a match, so replacing it by single spaces changes nothing.
        self.words = regex.compile(split["pattern"]["Regex"])
        self.file, self.library = tokenizer_file, None
        self.special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.added = {k: np.array([v], "<u4").tobytes() for k, v in added.items()}
        self.tokens = [""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in [*vocab.items(), *added.items()]:
            self.tokens[i] = token
        chars = byte_characters()
        self.first = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in chars], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([self._key(vocab[a], vocab[b]) for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.rank = dict(zip(keys[::-1].tolist(), range(len(pairs) - 1, -1, -1), strict=True))
        self.half, self.recent, self.old = max(1, keep_words // 2), {}, {}

    @staticmethod
    def _key(a, b):
        return a * 2**31 + b

    def _leaves(self, a, b, at, size: int):
        """rank * size + place of each pair of symbols, NO_PAIR where they don't merge; symbols under 0 are none."""
        import numpy as np

        key = self._key(a, b)
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[i] == key) & (a >= 0) & (b >= 0), self.order[i] * size + at, NO_PAIR)

    def _merge(self, words: list[bytes], size: int) -> list[bytes]:
        """Ids of words of at most `size` bytes, size a power of two."""
        import numpy as np

        n = len(words)
        symbols = np.full((n, size + 1), -1, np.int64)  # one more column stands for no neighbour
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        inside = np.arange(size) < lengths[:, None]
        symbols[:, :size][inside] = self.first[flat]
        symbols[np.arange(n), lengths - 1] = self.last[flat[np.cumsum(lengths) - 1]]
        after = np.tile(np.minimum(np.arange(1, size + 2), size), (n, 1))
        after[:, :size][~inside] = size
        after[np.arange(n), lengths - 1] = size
        before = np.tile(np.arange(-1, size), (n, 1))
        before[:, 0] = size
        places = np.arange(size)
        tree = [self._leaves(symbols[:, :size], symbols[:, 1:], places, size)]
        while tree[-1].shape[1] > 1:
            tree.append(np.minimum(tree[-1][:, 0::2], tree[-1][:, 1::2]))
        rows = np.flatnonzero(tree[-1][:, 0] < NO_PAIR)
        while len(rows):
            rank, at = np.divmod(tree[-1][rows, 0], size)
            gone = after[rows, at]
            right, left = after[rows, gone], before[rows, at]
            whole = self.merged[rank]
            symbols[rows, at], symbols[rows, gone] = whole, -1
            after[rows, at], before[rows, right] = right, at
            tree[0][rows, gone] = NO_PAIR
            tree[0][rows, at] = self._leaves(whole, symbols[rows, right], at, size)
            has = left < size
            tree[0][rows[has], left[has]] = self._leaves(symbols[rows[has], left[has]], whole[has], left[has], size)
            paths = [gone, at, np.where(has, left, at)]
            for low, high in zip(tree, tree[1:]):
                for p in paths:
                    p >>= 1
                    high[rows, p] = np.minimum(low[rows, 2 * p], low[rows, 2 * p + 1])
            rows = rows[tree[-1][rows, 0] < NO_PAIR]
        kept = symbols[:, :size] >= 0
        ids = symbols[:, :size][kept].astype("<u4")
        ends = np.cumsum(kept.sum(axis=1))
        return [x.tobytes() for x in np.split(ids, ends[:-1])]

    def _merge_one(self, word: bytes, size: int) -> bytes:
        """Ids of one word of at most `size` bytes. tree[1] is the root, tree[size + i] the leaf of place i."""
        import numpy as np

        n = len(word)
        first = self.first[np.frombuffer(word, np.uint8)]
        first[-1] = self.last[word[-1]]
        levels = [np.full(size, NO_PAIR, np.int64)]
        levels[0][: n - 1] = self._leaves(first[:-1], first[1:], np.arange(n - 1), size)
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][0::2], levels[-1][1::2]))
        tree = array("q", np.concatenate([[NO_PAIR], *levels[::-1]]).astype(np.int64).tobytes())
        symbols, after, before = array("q", first.tobytes()), array("q", range(1, n + 1)), array("q", range(-1, n - 1))

        def put(place: int, a: int, b: int) -> None:
            rank = self.rank.get(self._key(a, b)) if b >= 0 else None
            i, value = size + place, NO_PAIR if rank is None else rank * size + place
            tree[i] = value
            while i > 1:
                beside = tree[i ^ 1]
                value = min(value, beside)
                i >>= 1
                if tree[i] == value:
                    return
                tree[i] = value

        while (root := tree[1]) < NO_PAIR:
            rank, at = divmod(root, size)
            gone, left = after[at], before[at]
            right = after[at] = after[gone]
            symbols[at] = whole = int(self.merged[rank])
            symbols[gone] = -1
            put(gone, whole, -1)
            if right < n:
                before[right] = at
                put(at, whole, symbols[right])
            else:
                put(at, whole, -1)
            if left >= 0:
                put(left, symbols[left], whole)
        ids = np.frombuffer(symbols, np.int64)
        return ids[ids >= 0].astype("<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        by_size: dict[int, list[str]] = {}
        for w in words:
            by_size.setdefault(max(8, 1 << (len(w.encode()) - 1).bit_length()), []).append(w)
        for size, same in by_size.items():
            step = max(1, 2**17 // size)
            for i in range(0, len(same), step):
                part = same[i : i + step]
                raw = [w.encode() for w in part]
                self.recent.update(zip(part, self._merge(raw, size) if len(part) > FEW else [self._merge_one(w, size) for w in raw], strict=True))

    def _cut(self, text: str) -> list[str]:
        if text.isascii():
            return self.words.findall(text.lower())
        if _OTHERS.search(text):
            return self._cut_by_library(text)
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _cut_by_library(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.file)
            self.byte_of = {ord(c): b for b, c in enumerate(byte_characters())}
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [word.translate(self.byte_of).encode("latin-1").decode() for word, _ in words]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; added tokens inside a text count as themselves."""
        parts = [self.special.split(t) if self.special else [t] for t in texts]
        cut = [[self._cut(p) if i % 2 == 0 else p for i, p in enumerate(found)] for found in parts]
        recent, old = self.recent, self.old
        missing = {w for found in cut for part in found[::2] for w in part if w not in recent}
        if len(recent) + len(missing) > self.half:
            self.old = old = recent
            self.recent = recent = {}
            missing = {w for found in cut for part in found[::2] for w in part}
        recent.update((w, old[w]) for w in missing if w in old)
        self._learn([w for w in missing if w not in recent])
        return [b"".join([b"".join(map(recent.__getitem__, p)) if i % 2 == 0 else self.added[p] for i, p in enumerate(found)]) for found in cut]

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids with spaces between: the file states no decoder."""
        import numpy as np

        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def segment_tree_bpe(tokenizer_file: str) -> SegmentTreeBpe:
    """One encoder for each Python worker and file."""
    return SegmentTreeBpe(tokenizer_file)


def encode_documents(documents: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text", digests_only: bool = False) -> DataFrame:
    """(key, n_tokens, ids, decoded) of every text, or (key, n_tokens, ids_sha256, decoded_sha256).

    ids are little-endian unsigned 32-bit integers. A null text is empty and has no ids; an empty text decodes to the
    empty text. One row for each row of documents.
    """
    import pyarrow as pa

    rows = documents.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kinds = [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] if digests_only else [("ids", pa.binary()), ("decoded", pa.string())]
    schema = pa.schema([("key", pa.int64()), ("n_tokens", pa.int64()), *kinds])

    def encode(batches: Iterator) -> Iterator:
        bpe = segment_tree_bpe(tokenizer_file)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = bpe.encode_batch(part.column(1).to_pylist())
                counts = [len(x) // 4 for x in ids]
                texts = (bpe.decode(x) for x in ids)
                if digests_only:
                    out = [[hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(t.encode()).hexdigest() for t in texts]]
                else:
                    out = [ids, list(texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), *[pa.array(c, k) for c, (_, k) in zip(out, kinds, strict=True)]], schema=schema)

    ddl = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests_only else "key long, n_tokens long, ids binary, decoded string"
    return rows.mapInArrow(encode, ddl).withColumnRenamed("key", key)
