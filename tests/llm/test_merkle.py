"""Merkle manifest and bitmap ranks against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstar.llm import bitmaps, merkle
from tillstar.llm.queries import lower_az

from .helpers import DOCS


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tampered(row):
    if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 5:
        return row
    return (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))


def tree(level, fanout):
    levels = [level]
    while len(level) > 1:
        level = [digest(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        levels.append(level)
    return levels


def way(levels, i, fanout):
    for level in levels[:-1]:
        at = i - i % fanout
        yield level[at:i], level[i + 1:at + fanout]
        i //= fanout


def brute(data, fanout=16):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in data:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(groups[s], key=lambda x: x[:3]) for s in names}
    trees = {s: tree([x[2] for x in ordered[s]], fanout) for s in names}
    top = tree([trees[s][-1][0] for s in names], fanout)
    for k, s in enumerate(names):
        for i, (_, _, own, r) in enumerate(ordered[s]):
            steps = [*way(trees[s], i, fanout), *way(top, k, fanout)]
            found = leaf(tampered(r))
            for left, right in steps:
                found = digest(*left, found, *right)
            yield (r[0], own, trees[s][-1][0], top[-1][0], digest(*(h for a, b in steps for h in (*a, *b))),
                   found, i, found == top[-1][0])


def compare(spark, data, fanout=16):
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], "x", 0.5, 1) for r in data], DOCS)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.manifest(df, F.when(hit, lower_az(F.col("text"))), fanout=fanout)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "position", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(data, fanout), key=repr)
    return got


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_hold_and_rank(seed):
    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.integers(0, 65536, n)) for n in (1, 5, 900, 5000, 60_000)]
    sets += [np.arange(65536), np.arange(100, 40_000), np.array([0, 65535]), np.concatenate([np.arange(9), np.arange(50, 5000)])]
    for s in sets:
        packed = bitmaps.pack(s)
        assert np.array_equal(bitmaps.places_of(packed), s) and len(packed) <= 8193
        at = rng.integers(0, 65536, 500)
        assert np.array_equal(bitmaps.ranks(packed, bitmaps.directory(packed), at), np.searchsorted(s, at))
    assert np.array_equal(bitmaps.places_of(bitmaps.merge([bitmaps.pack(s) for s in sets[:4]])), np.unique(np.concatenate(sets[:4])))
    assert {bitmaps.pack(s)[0] for s in sets} == {0, 1, 2}


def test_groups_of_many_sizes(spark):
    rng = random.Random(4)
    ids = rng.sample(range(-10**6, 10**6), 700) + [2**62, -2**62, 65535, 65536]
    sizes = {"a": 1, "b": 2, "B": 16, "é": 17, "": 256, "c": 257, None: 33}
    data = []
    for s, n in sizes.items():
        data += [(ids.pop(), s, "en", n, f"Text {n} ÄÖ {rng.random()}") for _ in range(n)]
    compare(spark, data)


def test_edges(spark):
    data = [(5, "s", "en", 1, None), (5, "s", "en", 1, ""), (5, "s", "en", 1, ""), (5, "s", None, None, "A"), (None, "s", "en", 3, "x"),
            (None, "s", "en", 3, "x"), (None, None, None, None, None), (7, None, "de", 2, "Ü" * 200_000), (7, "t", "en", 0, "\x00Z"),
            (10, "one", "en", 0, "UPPER"), *((9, "s", "en", i, f"Row {i}") for i in range(40))]
    compare(spark, data)
    compare(spark, data, fanout=2)
    compare(spark, [(3, "only", "en", 1, "B")])


def test_no_rows(spark):
    assert compare(spark, []).count() == 0


def test_copies_of_an_id_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LOOK_UP", 20)
    compare(spark, [(8, "s", "en", 0, f"t{i % 150}") for i in range(300)] + [(i, "s", "en", 0, "u") for i in range(300)])
