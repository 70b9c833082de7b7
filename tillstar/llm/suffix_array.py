"""Suffix arrays in numpy: Larsson-Sadakane refinement, Kasai prefixes, merging by binary search."""

from __future__ import annotations

import numpy as np

#: Ranks and positions of three to a 64-bit word: a slice must be shorter.
LIMIT = 1 << 21


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of a byte array in the order of the suffixes that start there.

    Suffixes are grouped by their first five bytes; then the groups are
    refined by the ranks of the suffixes ``h`` further on, ``h`` doubling, and
    groups of one, whose place is final, are left alone.
    """
    n = len(text)
    assert n < LIMIT, "text too long for packed ranks"
    if not n:
        return np.empty(0, np.int64)
    bits = np.uint64(n.bit_length())
    low = np.uint64((1 << int(bits)) - 1)
    padded = np.zeros(n + 5, np.uint64)
    padded[:n] = text
    key = np.zeros(n, np.uint64)
    for j in range(5):
        key = (key << np.uint64(8)) | padded[j:j + n]
    # A suffix that ends sorts before one that goes on with a zero byte.
    key = key << np.uint64(3)
    key += np.minimum(np.arange(n, 0, -1), 5).astype(np.uint64)
    assert int(bits) <= 21
    packed = (key << bits) | np.arange(n, dtype=np.uint64)
    packed.sort()
    sa = (packed & low).astype(np.int64)
    pair = packed >> bits
    rank = np.zeros(2 * n + 1, np.uint64)
    slots = np.arange(n)
    h = 5
    while True:
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        rank[sa[slots]] = (slots[start] + 1).astype(np.uint64)
        slots = slots[~(new & np.concatenate([new[1:], [True]]))]
        if not len(slots):
            return sa
        p = sa[slots]
        packed = (((rank[p] << bits) | rank[np.minimum(p + h, n)]) << bits) | p.astype(np.uint64)
        packed.sort()
        sa[slots] = (packed & low).astype(np.int64)
        pair = packed >> bits
        h *= 2


def kasai(text: np.ndarray, sa: np.ndarray, starts: np.ndarray, cap: int = 64) -> np.ndarray:
    """Common prefix, up to ``cap`` or a little more, of each suffix with the one before it in ``sa``.

    In text order a common prefix is at most one shorter than that of the
    position before, so each is extended from there.  ``starts``: positions,
    beginning with 0, from which the walk is done side by side.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    words = np.zeros(n + cap + 16, np.uint64)
    padded = np.zeros(n + cap + 24, np.uint64)
    padded[:n] = text
    for j in range(8):
        words = (words << np.uint64(8)) | padded[j:j + len(words)]
    common = np.zeros(n, np.int64)
    ends = np.append(starts[1:], n)
    at, length = starts.copy(), np.zeros(len(starts), np.int64)
    if not n:
        return common
    while len(at):
        length = np.maximum(length - 1, 0)
        other = before[at]
        go = np.nonzero((other >= 0) & (length < cap))[0]
        while len(go):
            i, j, l = at[go], other[go], length[go]
            x = words[i + l] ^ words[j + l]
            same = np.zeros(len(go), np.int64)
            for s in range(56, -8, -8):
                same += (x >> np.uint64(s)) == 0
            length[go] = np.minimum(l + same, n - np.maximum(i, j))
            go = go[(same == 8) & (length[go] == l + 8) & (length[go] < cap)]
        length[other < 0] = 0
        common[at] = length
        at = at + 1
        on = at < ends
        if not on.all():
            at, ends, length = at[on], ends[on], length[on]
    return common[sa]


def least_owner(strings: list[bytes], owners: np.ndarray, n: int, slice_bytes: int = 1 << 20) -> list[np.ndarray]:
    """For every window of ``n`` bytes of every string, the smallest owner of a string that holds it.

    The strings are taken in slices.  Each slice has its suffix array, whose
    runs of common prefixes of ``n`` or more are its distinct windows, in
    order; the slices' runs are then merged by binary search.
    """
    slices, at = [], 0
    while at < len(strings):
        end, size = at, 0
        while end < len(strings) and (end == at or size + len(strings[end]) <= slice_bytes):
            size += len(strings[end])
            end += 1
        slices.append((at, end))
        at = end
    runs = []
    for a, b in slices:
        sizes = np.fromiter(map(len, strings[a:b]), np.int64, b - a)
        text = np.frombuffer(b"".join(strings[a:b]), np.uint8)
        starts = np.cumsum(sizes) - sizes
        sa = suffix_array(text)
        cls = np.cumsum(kasai(text, sa, starts[sizes > 0], max(64, n)) < n)
        of = np.repeat(np.arange(b - a), sizes)
        whole = np.arange(len(text)) + n <= np.repeat(starts + sizes, sizes)
        slot = np.nonzero(whole[sa])[0]
        place, cls = sa[slot], cls[slot]
        first = np.nonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))[0] if len(cls) else np.empty(0, np.int64)
        least = np.minimum.reduceat(owners[a:b][of[place]], first) if len(first) else np.empty(0, np.int64)
        number = np.cumsum(np.concatenate([[0], (cls[1:] != cls[:-1]).astype(np.int64)])) if len(cls) else cls
        runs.append((text, starts, sizes, place, number, place[first], least))
    if len(runs) > 1:
        every = None
        keys = []
        for text, _, _, _, _, where, least in runs:
            raw = np.lib.stride_tricks.sliding_window_view(text, n)[where] if len(where) else np.empty((0, n), np.uint8)
            # A closing byte keeps trailing zero bytes significant.
            key = np.ascontiguousarray(np.column_stack([raw, np.ones(len(raw), np.uint8)])).view(f"S{n + 1}").ravel()
            keys.append(key)
            if every is None:
                every = (key, least.copy())
                continue
            known, low = every
            spot = np.searchsorted(known, key)
            hit = spot < len(known)
            hit[hit] = known[spot[hit]] == key[hit]
            np.minimum.at(low, spot[hit], least[hit])
            every = (np.insert(known, spot[~hit], key[~hit]), np.insert(low, spot[~hit], least[~hit]))
        runs = [(*r[:6], every[1][np.searchsorted(every[0], k)]) for r, k in zip(runs, keys, strict=True)]
    out = []
    for text, starts, sizes, place, number, _, least in runs:
        low = np.zeros(len(text), np.int64)
        low[place] = least[number]
        out += [low[s:s + max(0, z - n + 1)] for s, z in zip(starts, sizes, strict=True)]
    return out
