"""Word and shingle hashes of whole texts, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words a worker remembers the hash of.
REMEMBERED = 1 << 18
MULTIPLIER, OTHER, MIX = np.uint64(0x9FB21C651E98DF25), np.uint64(0xA0761D6478BD642F), np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def window_hashes(h: np.ndarray, size: int, multiplier: np.uint64 = MULTIPLIER) -> np.ndarray:
    """A hash of each ``size`` neighbouring word hashes; none if there are fewer. Another multiplier gives an independent one."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for k in range(1, size):
        out *= multiplier
        out += h[k : n + k]
    return mixed(out)


def shingle_set(text: str | None, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text, A-Z in lower case; a shorter text is one shingle, one without words has none.

    ``bytes.lower`` and ``bytes.split`` touch ASCII letters and white space only, as the word pattern of the contracts has it.
    """
    h = known.array((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not len(h):
        return h
    return np.unique(window_hashes(h, size)) if len(h) >= size else window_hashes(h, len(h)) ^ np.uint64(len(h))
