"""Golomb-Rice coding of ascending 64-bit values, and the exchange that finds values held by two senders."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

BLOCK = 1 << 16


def encode(values: np.ndarray) -> bytes:
    """Ascending distinct unsigned values: gaps as quotients in unary and remainders of fixed width."""
    out, before = [struct.pack("<Q", len(values))], np.uint64(0)
    for start in range(0, len(values), BLOCK):
        block = values[start : start + BLOCK].astype(np.uint64)
        gaps = np.diff(block, prepend=before)
        width = max(0, (int(block[-1] - before) // len(block)).bit_length() - 1)
        before = block[-1]
        stops = np.cumsum((gaps >> np.uint64(width)) + np.uint64(1)).astype(np.int64)
        unary = np.zeros(int(stops[-1]), np.uint8)
        unary[stops - 1] = 1
        shifts = np.arange(width, dtype=np.uint64)
        rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        unary, rest = np.packbits(unary).tobytes(), np.packbits(rest).tobytes()
        out += [struct.pack("<IBII", len(block), width, len(unary), len(rest)), unary, rest]
    return b"".join(out)


def decode(blob: bytes) -> np.ndarray:
    (total,), at, before, out = struct.unpack_from("<Q", blob), 8, np.uint64(0), []
    while at < len(blob):
        n, width, unary_bytes, rest_bytes = struct.unpack_from("<IBII", blob, at)
        at += 13
        stops = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, unary_bytes, at)))[:n]
        at += unary_bytes
        gaps = np.diff(stops, prepend=-1).astype(np.uint64) - np.uint64(1) << np.uint64(width)
        if width:
            rest = np.unpackbits(np.frombuffer(blob, np.uint8, rest_bytes, at))[: n * width].reshape(n, width)
            for i in range(width):
                gaps |= rest[:, i].astype(np.uint64) << np.uint64(i)
        at += rest_bytes
        block = np.cumsum(gaps, dtype=np.uint64) + before
        before = block[-1]
        out.append(block)
    whole = np.concatenate(out) if out else np.empty(0, np.uint64)
    assert len(whole) == total
    return whole


def by_owner(values: np.ndarray, owners: int) -> Iterator[tuple[int, np.ndarray]]:
    """Ascending values cut into the equal ranges of the 64-bit space that the owners hold."""
    edges = np.array([(i << 64) // owners for i in range(1, owners)], np.uint64)
    cuts = [0, *np.searchsorted(values, edges).tolist(), len(values)]
    for owner in range(owners):
        if cuts[owner] < cuts[owner + 1]:
            yield owner, values[cuts[owner] : cuts[owner + 1]]


def shared_bitmaps(lists: DataFrame) -> DataFrame:
    """From rows (part, owner, blob), one list of a sender for an owner each: the same lists' bitmaps.

    Every owner gets one range of the hash space from all senders and answers each with a bit per value:
    set where another sender holds the value too. A sender's lists hold distinct values, so the work of an
    owner is its share of all distinct (sender, value) pairs, however often a value is repeated.
    """

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        held = [decode(blob) for blob in group["blob"]]
        values = np.sort(np.concatenate(held))
        shared = np.unique(values[1:][values[1:] == values[:-1]])
        found = []
        for own in held:
            at = np.searchsorted(shared, own)
            hit = np.zeros(len(own), bool)
            inside = at < len(shared)
            hit[inside] = shared[at[inside]] == own[inside]
            found.append(np.packbits(hit).tobytes())
        return pd.DataFrame({"part": group["part"], "owner": group["owner"], "bitmap": found})

    return lists.groupBy("owner").applyInPandas(answer, "part int, owner int, bitmap binary")
