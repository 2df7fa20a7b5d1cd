"""Words of whole texts as stable 64-bit hashes, for operators that work on word sequences."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from strataline.llm.caches import remembers

#: Distinct words a worker remembers; the memory starts anew beyond this.
KNOWN_WORDS = 300_000
WORD = re.compile(r"\w+")

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """Word to hash, computed once per distinct word."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_KNOWN = WordHashes()


def _forget() -> int:
    known = len(_KNOWN)
    _KNOWN.clear()
    return known


remembers("words", _forget)


def split_words(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores. Null has no words."""
    return WORD.findall(text.lower()) if text else []


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word of the whole text, in order."""
    words = split_words(text)
    return np.fromiter(map(_KNOWN.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """For each position, a hash of the words at these offsets from it, in order.

    Positions whose last offset lies beyond the end are left out.
    """
    n = len(words) - offsets[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(len(offsets)))
    for k in offsets:
        out = out * _ODD + words[k : k + n]
        out ^= out >> np.uint64(29)
    return mixed(out)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `size` words; a shorter text is one run."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(words, tuple(range(min(size, len(words))))))
