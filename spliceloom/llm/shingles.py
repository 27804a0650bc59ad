"""Word shingles of a text as hashes, and the fingerprint of a list of hashes."""

from __future__ import annotations

import numpy as np
import xxhash


def shingle_hashes(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of every shingle of A-Z-lower-cased words, repeats included; a shorter text is one shingle, one without words none."""
    words = text.lower().split()  # on bytes, lower() changes A-Z alone and split() splits at 0x20 and 0x09-0x0D
    if not words:
        return np.zeros(0, np.uint64)
    h = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([h(joined, seed)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    del words
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: 1 - shingle]
    return np.fromiter((h(joined[a:b], seed) for a, b in zip(start.tolist(), end[shingle - 1 :].tolist())), np.uint64, len(start))


def majority(lists: list[np.ndarray]) -> np.ndarray:
    """For each list of hashes, none of them empty, the bits that over half of its hashes have."""
    sizes = np.array([len(x) for x in lists])
    hashes = np.concatenate(lists)
    at = np.cumsum(sizes) - sizes
    fp = np.zeros(len(sizes), np.uint64)
    for low in range(0, 64, 8):
        byte = ((hashes >> np.uint64(low)) & np.uint64(255)).astype(np.uint8)
        ones = np.add.reduceat(np.unpackbits(byte[:, None], axis=1, bitorder="little"), at, axis=0, dtype=np.int32)
        bits = np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little")[:, 0]
        fp |= bits.astype(np.uint64) << np.uint64(low)
    return fp
