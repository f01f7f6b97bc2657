"""Words of a text and hashes of word runs, on NumPy arrays inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_CACHED_WORDS = 1 << 16  # about 10 MB of a worker


class WordHashes(dict):
    """64-bit hashes of words, remembered for the words met most lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def hashes_of(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


class Powers:
    """Powers of the base and of its inverse, computed as far as a text needs them."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the low bits over the whole word."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class RunHashes:
    """Karp-Rabin hashes of all runs of a length, any number of lengths from one sum."""

    def __init__(self, words: np.ndarray, powers: Powers):
        self.n = len(words)
        up, self.down = powers.upto(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(words * up[: self.n], out=self.sums[1:])

    def of(self, length: int) -> np.ndarray:
        """Hash of the run at every position that has one of this length."""
        if self.n < length:
            return np.empty(0, np.uint64)
        last = self.n - length + 1
        return mixed((self.sums[length:] - self.sums[:last]) * self.down[:last])


def _sliding(x: np.ndarray, width: int, better: np.ufunc, fill) -> np.ndarray:
    """Best of every ``width`` neighbours: running bests from both ends of blocks."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, fill, x.dtype)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = better.accumulate(grid, axis=1).ravel()
    back = better.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return better(back[:n], ahead[width - 1 : width - 1 + n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    return _sliding(x, width, np.minimum, np.iinfo(x.dtype).max)


def sliding_max(x: np.ndarray, width: int) -> np.ndarray:
    return _sliding(x, width, np.maximum, np.iinfo(x.dtype).min)


#: ASCII letters and digits stay, other ASCII bytes part words, bytes beyond ASCII stay.
_WORD_BYTES = bytes(
    b if b >= 128 or chr(b).isalnum() else 0x20 for b in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    """Words in lower case, without punctuation."""
    return (text or "").lower().encode().translate(_WORD_BYTES).split()
