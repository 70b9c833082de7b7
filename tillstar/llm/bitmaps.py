"""Compressed sets of 64-bit ids that answer rank queries.

An id's upper 48 bits name a chunk, its lower 16 a place in the chunk.  A
chunk is kept in whichever of three forms is smallest: its places, its runs
of places, or a bitmap.  Each has a directory of the members before a place,
word or run, so that a rank is one look-up and, in a bitmap, one popcount.
Ids that occur several times are listed beside the set.
"""

from __future__ import annotations

import numpy as np

PLACES = 1 << 16
ARRAY, RUNS, BITMAP = 0, 1, 2


def pack(places: np.ndarray) -> bytes:
    """The smallest form of sorted distinct places."""
    places = places.astype(np.int64)
    breaks = np.nonzero(np.diff(places) != 1)[0]
    firsts, lasts = places[np.concatenate([[0], breaks + 1])], places[np.concatenate([breaks, [len(places) - 1]])]
    if 4 * len(firsts) < min(2 * len(places), PLACES // 8):
        return bytes([RUNS]) + np.concatenate([firsts, lasts]).astype("<u2").tobytes()
    if 2 * len(places) <= PLACES // 8:
        return bytes([ARRAY]) + places.astype("<u2").tobytes()
    bits = np.zeros(PLACES, bool)
    bits[places] = True
    return bytes([BITMAP]) + np.packbits(bits, bitorder="little").tobytes()


def places_of(packed: bytes) -> np.ndarray:
    """The sorted places of a packed set."""
    body = packed[1:]
    if packed[0] == ARRAY:
        return np.frombuffer(body, "<u2").astype(np.int64)
    if packed[0] == RUNS:
        firsts, lasts = np.frombuffer(body, "<u2").astype(np.int64).reshape(2, -1)
        sizes = lasts - firsts + 1
        return np.repeat(firsts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    return np.nonzero(np.unpackbits(np.frombuffer(body, np.uint8), bitorder="little"))[0]


def merge(packed: list[bytes]) -> bytes:
    """The union of packed sets."""
    if len(packed) == 1:
        return packed[0]
    bits = np.zeros(PLACES, bool)
    for x in packed:
        bits[places_of(x)] = True
    return pack(np.nonzero(bits)[0])


def directory(packed: bytes) -> bytes:
    """Members before each word of a bitmap or each run; a list of places needs none."""
    if packed[0] == ARRAY:
        return b""
    if packed[0] == RUNS:
        firsts, lasts = np.frombuffer(packed[1:], "<u2").astype(np.int64).reshape(2, -1)
        counts = lasts - firsts + 1
    else:
        counts = np.bitwise_count(np.frombuffer(packed[1:], "<u8")).astype(np.int64)
    return (np.cumsum(counts) - counts).astype("<u2").tobytes()


def ranks(packed: bytes, before: bytes, places: np.ndarray) -> np.ndarray:
    """How many members are smaller than each of ``places``."""
    places = places.astype(np.int64)
    body = packed[1:]
    if packed[0] == ARRAY:
        return np.searchsorted(np.frombuffer(body, "<u2"), places).astype(np.int64)
    heads = np.frombuffer(before, "<u2").astype(np.int64)
    if packed[0] == RUNS:
        firsts, lasts = np.frombuffer(body, "<u2").astype(np.int64).reshape(2, -1)
        run = np.searchsorted(firsts, places, "right") - 1
        inside = np.minimum(places - firsts[run], lasts[run] - firsts[run] + 1)
        return np.where(run < 0, 0, heads[run] + inside)
    words = np.frombuffer(body, "<u8")
    below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
    return heads[places >> 6] + np.bitwise_count(words[places >> 6] & below).astype(np.int64)
