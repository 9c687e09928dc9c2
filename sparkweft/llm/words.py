"""Words of a text as 64-bit hashes, and hashes of word windows, in numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

SPACE_RUN = re.compile(r"[ \t-\r]+")
#: White space of str.split() that is no white space here.
OTHER_SPACE = re.compile("[%s]" % "".join(map(chr, (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def lower_az(text: str) -> str:
    """Lower-case A-Z only: those bytes stand for nothing else in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")


def split_words(text: str) -> list[str]:
    """The runs of characters other than space and \\t to \\r."""
    if OTHER_SPACE.search(text):
        return [w for w in SPACE_RUN.split(text) if w]
    return text.split()


class WordHashes(dict):
    """word: its XXH64, remembered for up to `most` words, so memory is bounded."""

    def __init__(self, most: int = 400_000, seed: int = 0):
        super().__init__()
        self.most, self.seed = most, seed

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return h

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: An odd multiplier and its inverse modulo 2**64.
_P = 0x9E3779B97F4A7C15


class Windows:
    """Hashes of all windows of some length: sum of word hashes times powers, by differences of prefix sums."""

    def __init__(self, multiplier: int = _P):
        self.up, self.down, self.p = np.ones(1, np.uint64), np.ones(1, np.uint64), multiplier
        self.inverse = pow(multiplier, -1, 1 << 64)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up), 1024)
            for name, p in (("up", self.p), ("down", self.inverse)):
                x = np.full(n, p, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def sums(self, h: np.ndarray) -> np.ndarray:
        self._grow(len(h) + 1)
        out = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self.up[: len(h)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, length: int, starts: np.ndarray | None = None) -> np.ndarray:
        """Hash of the window at each start (all of them by default)."""
        if starts is None:
            n = max(len(sums) - length, 0)
            return mixed((sums[length:] - sums[:-length])[:n] * self.down[:n])
        return mixed((sums[starts + length] - sums[starts]) * self.down[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads a hash over all its bits (a bijection)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
