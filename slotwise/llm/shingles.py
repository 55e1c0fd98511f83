"""Word shingles as 64-bit numbers, in bulk."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words a Python worker remembers.
WORDS = 300_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_known: dict[bytes, int] = {}


def words(raw: bytes | None) -> list[bytes]:
    """The words of a text: A-Z lower-cased, parted by the bytes 0x20 and 0x09-0x0D."""
    return (raw or b"").lower().split()


def numbers(of: list[bytes]) -> np.ndarray:
    """One 64-bit number per word."""
    if len(_known) > WORDS:
        _known.clear()
    found = list(map(_known.get, of))
    if None in found:
        for i, x in enumerate(found):
            if x is None:
                found[i] = _known[of[i]] = xxhash.xxh3_64_intdigest(of[i])
    return np.array(found, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M1
    return h ^ (h >> np.uint64(29))


def sequence(h: np.ndarray, width: int) -> np.ndarray:
    """The number of each run of ``width`` words, in order; of a shorter text, the number of
    the whole sequence; nothing without words."""
    if not len(h):
        return h
    width = min(width, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width))
    for j in range(width):
        out = mix(out * _M2 + h[j:len(h) - width + 1 + j])
    return out


def shingle_set(raw: bytes | None, width: int) -> np.ndarray:
    return np.unique(sequence(numbers(words(raw)), width))
