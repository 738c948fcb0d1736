"""Words of many texts at once, over their UTF-8 bytes: positions, owners and 64-bit hashes as numpy arrays."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from tidemark.llm.common import mix64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def byte_class(keep: Callable[[int], bool]) -> np.ndarray:
    return np.array([keep(b) for b in range(256)])


#: Digits, lower-case letters and everything outside ASCII (after lower-casing).
ALNUM = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: Everything but ASCII white space.
VISIBLE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


@dataclass(frozen=True)
class Words:
    data: np.ndarray  # lower-cased bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words

    @staticmethod
    def of(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
        data = LOWER[data]
        inside = kind[data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        texts = offsets[:-1][offsets[:-1] < len(data)]
        begin[texts] = inside[texts]
        starts = np.flatnonzero(begin)
        at = np.flatnonzero(begin[inside])
        lengths = np.diff(at, append=int(inside.sum()))
        return Words(data, starts, starts + lengths, np.searchsorted(starts, offsets))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def until_end(self) -> np.ndarray:
        """For each word, how many words its text has from it on."""
        return np.repeat(self.first[1:], self.counts()) - np.arange(len(self.starts))

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.empty(0, np.uint64)
        lengths = self.ends - self.starts
        first = np.cumsum(lengths) - lengths
        inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        powers = np.cumprod(np.full(int(lengths.max()), _STEP | np.uint64(1)))
        terms = (self.data[np.repeat(self.starts, lengths) + inside].astype(np.uint64) + np.uint64(1)) * powers[inside]
        return mix64(np.add.reduceat(terms, first))

    def text(self, word: int, count: int) -> bytes:
        return b" ".join(self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(word, word + count))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on (as many as fit)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total, factor = np.full(n, np.uint64(k)), np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(k):
            factor = factor * _STEP + np.uint64(2 * j)
            total = total + hashes[j : j + n] * (factor | np.uint64(1))
    return mix64(total)


def rolling(values: np.ndarray, width: int, join: np.ufunc) -> np.ndarray:
    """Minimum or maximum over each run of ``width`` values."""
    span = 1
    while span * 2 <= width:
        values, span = join(values[:-span], values[span:]), span * 2
    return join(values[: len(values) - (width - span)], values[width - span :]) if span < width else values
