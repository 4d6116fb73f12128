"""Sets of word shingles as sorted arrays of 64-bit hashes, made a batch of texts at a time inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

#: Words whose hash a Python worker remembers.
CACHE_WORDS = 400_000
U64 = np.uint64


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_hashes = WordHashes()


def words(text: str) -> list[bytes]:
    """Words of a text in UTF-8, A-Z in lower case; bytes split at the six ASCII white space characters only."""
    return text.encode("utf-8").lower().split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, tokens), U64, len(tokens))


def scramble(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit numbers, so that their order is as good as random."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def sequence_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes, in order of position."""
    odd = scramble(np.arange(1, width + 1, dtype=U64)) | U64(1)
    n = len(h) - width + 1
    total = np.full(n, width, U64)
    for k in range(width):
        total += h[k : k + n] * odd[k]
    return scramble(total)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Distinct shingles, ascending; a text with fewer words has one, the whole of it; no words: none."""
    tokens = words(text) if text else []
    if not tokens:
        return np.empty(0, U64)
    return np.unique(sequence_hashes(word_hashes(tokens), min(width, len(tokens))))


def fingerprint(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
