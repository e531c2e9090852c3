"""Vectorised word and shingle hashes of many texts at once (numpy).

Texts are joined into one UTF-8 buffer. A word is a run of bytes other than
the six blanks; its 64-bit hash is a polynomial over its bytes, read off
prefix sums, so no word becomes a Python object.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOCK = threading.Lock()
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, grown on demand."""
    with _LOCK:
        if len(_powers[0]) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            for k, b in enumerate((_BASE, _INVERSE)):
                steps = np.full(size, b, dtype=np.uint64)
                steps[0] = 1
                _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of several texts: byte range and hash of each; ``offsets[d]`` to
    ``offsets[d + 1]`` are the words of text d; ``base[d]`` its first byte."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray
    base: np.ndarray


def words(texts: list[bytes]) -> Words:
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    base = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(sizes + 1, out=base[1:])
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8) if texts else np.zeros(0, dtype=np.uint8)
    blank = np.ones(len(buf) + 2, dtype=np.int8)
    blank[1:-1] = _BLANK[buf]
    edge = np.diff(blank)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power_tables(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], dtype=np.uint64, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return Words(starts, ends, hashes, np.searchsorted(starts, base), base)


_ROW = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` (at most 8) consecutive words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n] * _ROW[0]
    for j in range(1, k):
        out = out + hashes[j:j + n] * _ROW[j]
    return mix(out)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text and their offsets. A text
    of 1 to k - 1 words has one shingle: all its words."""
    every = windows(w.hashes, k)
    count = np.diff(w.offsets)
    have = np.maximum(count - k + 1, (count > 0).astype(np.int64))
    offsets = np.zeros(len(count) + 1, dtype=np.int64)
    np.cumsum(have, out=offsets[1:])
    inside = np.arange(offsets[-1]) - np.repeat(offsets[:-1], have) + np.repeat(w.offsets[:-1], have)
    out = np.zeros(offsets[-1], dtype=np.uint64)
    long = np.repeat(count >= k, have)
    out[long] = every[inside[long]]
    for d in np.flatnonzero((count > 0) & (count < k)):
        h = w.hashes[w.offsets[d]:w.offsets[d + 1]]
        out[offsets[d]] = windows(h, len(h))[0] ^ np.uint64(len(h))
    return out, offsets
