"""Word shingles of a text and their hashes."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash

BITS = 64
SEED = 42


def shingle_hashes(text: bytes | None, size: int) -> np.ndarray:
    """The XXH64 of each shingle of ``size`` words of a UTF-8 text, repeats included. Words are runs without ASCII
    white space, A-Z lower-cased, joined by one space; a shorter text is one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """The unsigned number whose bits are those that are set in over half the hashes; zero without any."""
    if not len(hashes):
        return 0
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """The different hashes as signed numbers, sorted."""
    return np.unique(hashes.view(np.int64))


def set_name(found: np.ndarray) -> int:
    """A signed 64-bit hash of a set; zero for the empty one."""
    return signed(xxhash.xxh64_intdigest(found.tobytes(), SEED)) if len(found) else 0


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value
