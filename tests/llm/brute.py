"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
from xxhash import xxh64_intdigest

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def simhash(text: str | None) -> int:
    words = [w.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))) for w in WORD.findall((text or "").encode())]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(keys, fps, radius=3):
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    x = np.array(fps, np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[i + 1 :]) <= radius):
            root[find(i)] = find(i + 1 + int(j))
    least: dict[int, int] = {}
    for i, k in enumerate(keys):
        least[find(i)] = min(least.get(find(i), k), k)
    return [least[find(i)] for i in range(len(keys))]


def minimax(sizes, shards):
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        c, used, load = (low + high) // 2, 1, 0
        for s in sizes:
            used, load = (used + 1, s) if load + s > c else (used, load + s)
        low, high = (low, c) if used <= shards else (c + 1, high)
    return low


def _xx(values, seed=42):
    """Spark's xxhash64 of strings (None: skipped) or longs, one after the other."""
    for v in values:
        if v is None:
            continue
        raw = v.encode() if isinstance(v, str) else int(v).to_bytes(8, "little", signed=True)
        seed = xxh64_intdigest(raw, seed & (2**64 - 1))
    return seed - 2**64 if seed >= 2**63 else seed


TOKEN = re.compile("[^ \t\n\x0b\f\r]{1,24}+(?![^ \t\n\x0b\f\r])|[^ \t\n\x0b\f\r]")


def order_minhash(text, k=5, samples=64, tuple_length=2, rings=2):
    tokens = [_xx([t]) for t in TOKEN.findall(text or "")]
    found = [(_xx([tokens[i + j] if i + j < len(tokens) else None for j in range(k)]) >> 28, i) for i in range(max(1, len(tokens) - k + 1))]
    seen: dict[int, int] = {}
    numbered = []
    for h, i in found:
        o = seen.get(h, 0)
        seen[h] = o + 1
        numbered.append((_mix(h, o) if o else h, i))
    out = []
    for r in range(rings):
        ring = sorted((_mix(h, r) if r else h, i) for h, i in numbered)
        points = samples // rings
        for p in range(points):
            start = next((i for i, (h, _) in enumerate(ring) if (h + 2**35) * points >= p * 2**36), 0)
            chosen = sorted((ring[(start + o) % len(ring)][1] % 2**28, ring[(start + o) % len(ring)][0] % 2**36) for o in range(min(tuple_length, len(ring))))
            seed = 42
            for _, h in chosen:
                seed = xxh64_intdigest(h.to_bytes(8, "little"), seed)
            out.append(seed & 0xFFFF)
    return out


def _mix(h, o):
    """xxhash64(long h, int o) >> 28; Spark hashes an int as four bytes."""
    seed = xxh64_intdigest(int(h).to_bytes(8, "little", signed=True), 42)
    seed = xxh64_intdigest(int(o).to_bytes(4, "little", signed=True), seed)
    return (seed - 2**64 if seed >= 2**63 else seed) >> 28


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
