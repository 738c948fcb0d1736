"""Blockwise suffix sorting with a difference cover, over a bounded text in memory.

Modulo 7 every difference is one between two residues of {0, 1, 3}. The suffixes at those residues are ranked
first, by doubling. Then one suffix bucket after the other (a range of seven-byte prefixes) is sorted on its
own: suffixes that tie on seven bytes are at most six bytes away from ranked ones that decide them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PERIOD, COVER = 7, (0, 1, 3)
#: SHIFT[r][s]: the distance after which positions of residues r and s are both in the cover.
SHIFT = [[next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER and (s + d) % PERIOD in COVER) for s in range(PERIOD)] for r in range(PERIOD)]


def prefixes(text: np.ndarray) -> np.ndarray:
    """Seven bytes from every position on as one number; zeros follow the text."""
    padded = np.concatenate([text, np.zeros(PERIOD, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for i in range(PERIOD):
        out |= padded[i : i + len(text)] << np.uint64(8 * (PERIOD - 1 - i))
    return out


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def cover_ranks(heads: np.ndarray) -> np.ndarray:
    """Ranks of the cover's suffixes among each other; -1 elsewhere.

    Doubles the compared length until all differ: a comparison cut short would order suffixes of different
    residues by different lengths, and their order would no longer be one.
    """
    n = len(heads)
    at = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    ranks = np.full(n, -1, np.int64)
    # of suffixes that end within these seven bytes the shorter one comes first
    ranks[at] = _dense(heads[at] * np.uint64(8) + np.minimum(n - at, PERIOD).astype(np.uint64))
    known = PERIOD
    while known < n and len(at) and ranks[at].max() < len(at) - 1:
        after = at + known  # the residue is the same, so it is in the cover too
        second = np.where(after < n, ranks[np.minimum(after, n - 1)] + 1, 0)
        ranks[at] = _dense(ranks[at] * (n + 1) + second)
        known *= 2
    return ranks


def sorted_bucket(starts: np.ndarray, heads: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """``starts`` in the order of their suffixes."""
    starts = starts[np.argsort(heads[starts], kind="stable")]
    keys = heads[starts]
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, bool)
    first = np.flatnonzero(new)
    sizes = np.diff(first, append=len(starts))
    tied = np.repeat(sizes > 1, sizes)
    if not tied.any():
        return starts
    where = np.flatnonzero(tied)
    position, group = starts[where], np.cumsum(new)[where]
    residue, width = position % PERIOD, np.int64(len(heads) + 1)
    less = np.zeros(len(where), np.int64)
    members = [np.flatnonzero(residue == r) for r in range(PERIOD)]
    for s in range(PERIOD):
        for d in sorted(set(SHIFT[s])):
            theirs = np.sort(group[members[s]] * width + ranks[position[members[s]] + d])
            for r in range(PERIOD):
                if SHIFT[r][s] != d or not len(members[r]) or not len(theirs):
                    continue
                own = group[members[r]] * width
                below = np.searchsorted(theirs, own)
                if r == s:
                    exact = own + ranks[position[members[r]] + d]
                    order = np.argsort(exact, kind="stable")
                    count = np.empty(len(order), np.int64)  # of smaller ones with its residue
                    count[order] = np.arange(len(order))
                    less[members[r]] += count - below
                else:
                    less[members[r]] += np.searchsorted(theirs, own + ranks[position[members[r]] + d]) - below
    starts[np.repeat(first, sizes)[where] + less] = position
    return starts


def suffix_buckets(starts: np.ndarray, heads: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """The starts cut into ranges of their seven-byte prefixes, of about ``limit`` each where prefixes differ."""
    if len(starts) <= limit:
        yield starts
        return
    keys = heads[starts]
    edges = np.unique(np.quantile(keys, np.linspace(0, 1, len(starts) // limit + 1)[1:], method="lower"))
    bucket = np.searchsorted(edges, keys)
    order = np.argsort(bucket, kind="stable")
    yield from (part for part in np.split(starts[order], np.flatnonzero(np.diff(bucket[order])) + 1) if len(part))


def equal_runs(text: np.ndarray, starts: np.ndarray, length: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts in suffix order, whether each begins a new string of ``length`` bytes), a suffix bucket at a time."""
    heads = prefixes(text)
    ranks = cover_ranks(heads)
    for bucket in suffix_buckets(starts, heads, limit):
        order = sorted_bucket(bucket, heads, ranks)
        new = np.ones(len(order), bool)
        if len(order) > 1:
            a, b = order[:-1], order[1:]
            differs = np.zeros(len(a), bool)
            for d in [*range(0, length - PERIOD, PERIOD), length - PERIOD]:
                differs |= heads[a + d] != heads[b + d]
            new[1:] = differs
        yield order, new
