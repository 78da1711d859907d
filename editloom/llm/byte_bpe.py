"""Token ids of a byte-level BPE that a tokenizers JSON file describes.

The file's vocabulary, merges and added tokens are handed to tiktoken's encoder, which gives the same ids several times
faster; a file that it could not reproduce (a normalizer, another pre-tokenizer, ids not in merge order) is refused.
Its pattern backtracks over white space and gives up on runs of about a million, so long runs are cut out beforehand.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

#: Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The white space of Unicode.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = re.compile(f"[{SPACES}]*")
#: Runs of white space that hold a multiple of STEP and have at least twice as many characters are long.
STEP = 2048


def long_spaces(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of each run of at least 2 * STEP characters of white space."""
    upto = 0
    for at in range(STEP, len(text), STEP):
        if at >= upto and text[at] in SPACES:
            start = at
            while start > upto and text[start - 1] in SPACES:
                start -= 1
            upto = _RUN.match(text, at).end()
            if upto - start >= 2 * STEP:
                yield start, upto


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, then from 256 up."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


class ByteBpe:
    def __init__(self, tokenizer_file: str):
        import numpy as np
        import tiktoken

        with open(tokenizer_file, encoding="utf-8") as f:
            stated = json.load(f)
        pre, model = stated["pre_tokenizer"] or {}, stated["model"]
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        added = {t["content"]: t["id"] for t in stated["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        in_order = all(model["vocab"][a + b] == 256 + i for i, (a, b) in enumerate(pairs))
        if stated["normalizer"] or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space") or not in_order:
            raise ValueError(f"{tokenizer_file} is no plain byte-level BPE with ids in merge order")
        self._encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.byte_lengths = np.zeros(max([*ranks.values(), *added.values()]) + 1, dtype=np.int64)
        self.apostrophe = np.zeros(len(self.byte_lengths), bool)
        for token, i in [*ranks.items(), *((k.encode(), v) for k, v in added.items())]:
            self.byte_lengths[i] = len(token)
            self.apostrophe[i] = b"'" in token
        self.added = tuple(added)
        self.longest_added = max((len(k.encode()) for k in added), default=0)

    def encode(self, text: str):
        """numpy uint32 array of ids; added tokens inside the text count as themselves, none is added."""
        import numpy as np

        parts, at = [], 0
        for start, end in long_spaces(text):
            # Before other text the pattern leaves the last character of a run to what follows.
            end -= not (end == len(text) or text.startswith(self.added, end))
            parts.append(self._plain(text[at:start]))
            parts.append(np.array(self._encoding._encode_single_piece(text[start:end]), np.uint32))
            at = end
        return np.concatenate([*parts, self._plain(text[at:])]) if parts else self._plain(text)

    def _plain(self, text: str):
        return self._encoding.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=4)
def byte_bpe(tokenizer_file: str) -> ByteBpe:
    """One encoder for each Python worker and file."""
    return ByteBpe(tokenizer_file)
