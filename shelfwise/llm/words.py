"""Words of whole texts as 64-bit hashes, for operators that compare sequences of words.

Runs of words are hashed with array arithmetic. Hashes are the same in every process. A word is hashed
each time it occurs: that takes less time than to look it up, and no memory.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: A worker forgets its words once they and their hashes take so many bytes.
MEMO = 64 << 20
#: Bytes of a remembered word besides its own.
ENTRY = 180

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Remembered words, for texts of few and long ones; the operators don't use it."""

    size = 0

    def __missing__(self, word: bytes) -> int:
        self.size += ENTRY + len(word)
        if self.size > MEMO:
            self.clear()
            self.size = 0
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_NAMES = bytes(range(256)).lower()
#: Bytes that end an alphanumeric word: ASCII other than digits and letters.
_ALNUM = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in _NAMES)


def blank_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased. Null has none."""
    return text.lower().split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all other characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_ALNUM).split() if text else []


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of a well-known hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def runs(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; none if there are fewer."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = word_hashes[:n].copy()
    for i in range(1, k):
        out = mix(out * _MULTIPLIER) + word_hashes[i : i + n]
    return mix(out)


def shingles(words: list[bytes], k: int) -> np.ndarray:
    """The set of ``k``-word shingles, sorted; with fewer words the whole sequence is the only one."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes(words)
    if len(h) >= k:
        return np.unique(runs(h, k))
    return runs(h, len(h)) ^ np.uint64(len(h))
