"""Hashes of byte ranges, very many at once."""

from __future__ import annotations

import numpy as np
import xxhash

#: Ranges beyond this many bytes are hashed by xxh3, one by one.
LONG = 128
#: The low 0 to 8 bytes of a number.
_LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def lanes(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on (zeros beyond the end), as numbers, without a copy for each place."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))


def mixed(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    """h with x mixed in; one-to-one in x."""
    h = (h ^ x) * np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of raw[s:e]; ranges of one length of up to 8 bytes never collide."""
    n = ends - starts
    at = lanes(raw)
    h = mixed(n.astype(np.uint64), np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
    todo, k = np.flatnonzero(n <= LONG), 0
    while len(todo):
        h[todo] = mixed(h[todo], at[starts[todo] + k] & _LOW[np.minimum(n[todo] - k, 8)])
        k += 8
        todo = todo[n[todo] > k]
    for i in np.flatnonzero(n > LONG):
        h[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]], seed)
    return h


def equal(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, n: np.ndarray) -> bool:
    """Whether all ranges of n bytes are the same in a and in b, byte by byte."""
    in_a, in_b = lanes(a), lanes(b) if b is not a else None
    in_b = in_a if in_b is None else in_b
    todo, k = np.flatnonzero(n <= LONG), 0
    while len(todo):
        low = _LOW[np.minimum(n[todo] - k, 8)]
        if ((in_a[a_starts[todo] + k] ^ in_b[b_starts[todo] + k]) & low).any():
            return False
        k += 8
        todo = todo[n[todo] > k]
    return all(np.array_equal(a[a_starts[i] : a_starts[i] + n[i]], b[b_starts[i] : b_starts[i] + n[i]]) for i in np.flatnonzero(n > LONG))
