"""Hashes of word shingles, computed from the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers can be divided out again
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SEED = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class WordHashes:
    """64-bit hashes of the words of texts: A-Z in lower case, split at \\x20 and \\x09 to \\x0D."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and for each text the number of words before it (and at the end)."""
        if len(self.up) < len(data):
            n = max(1 << 16, len(data) + len(data) // 4)
            self.up, self.down = powers(BASE, n), powers(INVERSE, n)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        inside = ~space
        starts = np.flatnonzero(inside & (np.append(True, space[:-1]) | edge[:-1]))
        ends = np.flatnonzero(inside & (np.append(space[1:], True) | edge[1:])) + 1
        lower = data + np.uint8(32) * ((data >= 65) & (data <= 90))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        words = mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * SEED)
        return words, np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, words: WordHashes, size: int, most_bytes: int = 1 << 20) -> Iterator[np.ndarray]:
    """Per text its distinct shingles of ``size`` words, sorted; a shorter text is one shingle, one
    without words or null is empty. Some texts are hashed together, at most ``most_bytes`` or one."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, 8 * texts.offset) if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < n:
        k = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most_bytes, side="right")) - 1)
        part = data[offsets[i] : offsets[k]]
        hashes, at = words.of(part, offsets[i : k + 1] - offsets[i])
        rolled = hashes
        if len(hashes) >= size:
            rolled = hashes[: len(hashes) - size + 1].copy()
            for j in range(1, size):
                rolled = mix(rolled * BASE + hashes[j : len(hashes) - size + 1 + j])
        for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
            if z - a >= size:
                one = np.sort(rolled[a : z - size + 1])
                fresh = np.ones(len(one), bool)
                np.not_equal(one[1:], one[:-1], out=fresh[1:])
                yield one[fresh]
            elif z > a:
                few = hashes[a : a + 1].copy()
                for j in range(a + 1, z):
                    few = mix(few * BASE + hashes[j : j + 1])
                yield mix(few + np.array([z - a], np.uint64) * SEED)
            else:
                yield hashes[:0]
        i = k
