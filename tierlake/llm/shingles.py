"""Sets of hashed word shingles, inside tasks."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import xxhash

# Fixed value: bytes with A-Z in lower case.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


#: Words whose hashes a Python worker remembers, about 25 MB that it holds as long as it lives.
REMEMBERED = 1 << 17


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(content: bytes) -> np.ndarray:
    """A hash per word; words end at ASCII white space, which is what bytes.split() takes."""
    words = content.split()
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash per window of so many words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return hashes[:0]
    rolled = hashes[:count].copy()
    for k in range(1, width):
        rolled *= MULTIPLIER
        rolled += hashes[k : k + count]
    return mixed(rolled)


def shingle_set(text: str, width: int) -> np.ndarray:
    """The ascending distinct shingle hashes of a text; shorter texts are one shingle, texts without words none."""
    hashes = word_hashes(text.encode("utf-8", "surrogatepass").translate(LOWER))
    return np.unique(windows(hashes, min(width, len(hashes)))) if len(hashes) else hashes


def set_name(shingles: np.ndarray) -> bytes:
    """96 bits that name a set."""
    return blake2b(shingles.tobytes(), digest_size=12).digest()
