"""Words, hashes of words and hashes of word windows, shared by the operators."""

from __future__ import annotations

import numpy as np
import xxhash

#: A word, as a Java, RE2 or Python pattern.
WORD = r"[^\x20\x09-\x0D]+"
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def split_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; a null text has none.

    ``bytes.split`` divides at the six ASCII blanks, which are those of ``WORD``.
    """
    return text.encode("utf-8", "surrogatepass").split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def scramble(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words, in order of its first word.

    Polynomial hashes of 1, 2, 4, ... words are built by doubling; those of the
    binary digits of ``size`` put side by side give the window.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    whole, at, block, width = None, 0, hashes, 1
    while width <= size:
        shift = np.uint64(pow(_STEP, width, 1 << 64))
        if size & width:
            piece = block[at:at + n]
            whole = piece if whole is None else whole * shift + piece
            at += width
        if 2 * width <= size:
            block = block[:-width] * shift + block[width:]
        width *= 2
    return scramble(whole)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``size`` words that begins at one of
    ``starts``."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return np.cumsum(edges[:n]) > 0
