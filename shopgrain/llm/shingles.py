"""Words and word shingles of a text as 64-bit hashes, vectorised.

Words are what lies between ASCII white space (``\\x20``, ``\\x09`` to ``\\x0D``) after
lowering A-Z. A word's hash depends on its bytes alone, so it is the same in every task.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
#: Bytes that are hashed at a time.
CHUNK = 1 << 15
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_TABLES: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of the base, of its inverse modulo 2**64, and a value for every byte."""
    if not _TABLES:
        for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(CHUNK + 1, factor, dtype=np.uint64)
            row[0] = 1
            _TABLES.append(np.cumprod(row))
        _TABLES.append(mix(np.arange(1, 257, dtype=np.uint64)))
    return _TABLES


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []


def word_hashes(found: list[bytes]) -> np.ndarray:
    """One hash a word. Long texts are hashed in chunks of whole words."""
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    ends = np.cumsum(lengths)
    out, first, before = [], 0, 0
    while first < len(found):
        last = max(first + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
        out.append(_hash_chunk(found[first:last], lengths[first:last]))
        before, first = int(ends[last - 1]), last
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def _hash_chunk(found: list[bytes], lengths: np.ndarray) -> np.ndarray:
    data = b"".join(found)
    if len(data) > CHUNK:  # one word longer than a chunk
        parts = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
        total = np.zeros(1, dtype=np.uint64)
        for part in parts:
            total = mix(total + _hash_chunk([part], np.array([len(part)])))
        return total
    up, down, byte = _powers()
    raw = byte[np.frombuffer(data, dtype=np.uint8)] * up[: len(data)]
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(raw, dtype=np.uint64)])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths.astype(np.uint64))


def shingle_hashes(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """A hash for every run of ``width`` words in order; with fewer words, one for the
    whole sequence; none without words."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    total = hashes[: n - width + 1]
    for k in range(1, width):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : n - width + 1 + k]
    return mix(total + np.uint64(width))


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text, sorted by hash."""
    return np.unique(shingle_hashes(word_hashes(words(text)), width))
