"""MinHash near-duplicates and suffix-array dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tillstar.llm import minhash, suffix_array, suffix_dedup
from tillstar.llm.components import components

from .helpers import EDGE, docs, prose, rows


def brute_components(data, width, percent):
    sets = {}
    for d, t in data:
        if d is None:
            continue
        w = (t or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})).encode().split()
        s = {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
        sets.setdefault(d, s)
    label = {d: d for d in sets}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {d: (len(s), label[d]) for d, s in sets.items()}


def corpus(seed, families=12):
    rng, out = random.Random(seed), []
    for f in range(families):
        base = prose(seed * 100 + f, rng.choice([3, 8, 40, 120])).split()
        for _ in range(rng.choice([1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"z{rng.randrange(50)}"
            out.append(" ".join(w))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_components_match_all_pairs(spark, width, percent):
    data = corpus(3, 30) + [(900 + i, t) for i, (d, t) in enumerate(EDGE) if d is not None and d != 5]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs(spark, data), width, percent).collect()}
    assert got == brute_components(data, width, percent)


def test_chain_is_one_component(spark):
    words = prose(5, 100, 10_000).split()
    data = [(i, " ".join(words[2 * i:2 * i + 80])) for i in range(8)]
    got = minhash.near_duplicates(docs(spark, data)).collect()
    want = brute_components(data, 3, 85)
    assert {r.doc_id: r.component_id for r in got} == {d: c for d, (_, c) in want.items()}
    assert max(c for _, c in want.values()) == 0


def test_edges_of_near_duplicates(spark):
    got = minhash.near_duplicates(docs(spark, EDGE)).collect()
    assert len(got) == len(EDGE)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[5] == [(1, 5, True)] * 2 and by[7][0][1] == by[8][0][1] == 7
    assert all(c is None and kept for _, c, kept in by[None])
    left = minhash.drop_near_duplicates(docs(spark, EDGE))
    assert left.columns == docs(spark, []).columns
    assert sorted(r.doc_id for r in left.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_bins_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(0)
    sketch = minhash.Sketcher(50, 8)
    for size in (5, 40, 2000):
        agree = []
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
            b = np.unique(np.concatenate([a[:size - size // 5], rng.integers(0, 2**63, size // 5, dtype=np.uint64)]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agree.append((sketch.bins_of(a) == sketch.bins_of(b)).mean() - true)
        assert abs(np.mean(agree)) < 0.08


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (3, 4)]
    got = dict(rows(components(spark.createDataFrame(links, "a long, b long")), "node", "component"))
    assert got == {**{i: 0 for i in range(21)}, **{100 + i: 100 for i in range(50)}}


def brute_repeats(data, n):
    where = {}
    raw = [(d, (t or "").encode()) for d, t in data]
    for d, b in raw:
        if d is not None:
            for i in range(len(b) - n + 1):
                w = b[i:i + n]
                where[w] = min(d, where.get(w, d))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if d is not None and where[b[i:i + n]] < d:
                gone[i:i + n] = b"\1" * n
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("n", [50, 30])
def test_repeats_match_all_windows(spark, n):
    rng = random.Random(n)
    parts = [prose(i, 12) for i in range(6)] + ["é" * 60, "a" * 120, "ab" * 70, "\x00" * 55]
    data = []
    for d in range(60):
        data.append((d if d % 9 else d + 1, " ".join(rng.choice(parts) if rng.random() < 0.5 else prose(d * 10 + j, 9) for j in range(rng.randrange(1, 5)))))
    data += [(d if d is None else d + 500, t) for d, t in EDGE if t is None or len(t) < 1000]
    got = rows(suffix_dedup.remove_repeats(docs(spark, data), n, group_bytes=500, bucket_bytes=900, shard_bytes=700, slice_bytes=150), *COLUMNS)
    assert got == brute_repeats(data, n)


def test_very_long_text_loses_its_copy(spark):
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(docs(spark, EDGE)).collect()}
    assert got[7] == 0 and got[8] == len(prose(1, 30_000))
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_text_out_keeps_columns_and_whole_characters(spark):
    shared = "ü" * 40
    data = [(1, "x" + shared + "y"), (2, "éz" + shared + "ö"), (3, None)]
    out = suffix_dedup.remove_repeats(docs(spark, data), text_out=True, size_col="n_chars")
    assert out.columns == docs(spark, []).columns
    # The first byte of the last letter is part of a repeat too: the letter goes.
    assert rows(out, "doc_id", "text", "n_chars") == [(1, data[0][1], 42), (2, "éz", 2), (3, None, None)]


def test_suffix_array_and_kasai():
    rng = random.Random(2)
    for _ in range(60):
        text = bytes(rng.choice(rng.choice([b"a", b"ab", bytes(range(256))])) for _ in range(rng.randrange(1, 150)))
        sa = suffix_array.suffix_array(np.frombuffer(text, np.uint8))
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert sa.tolist() == want
        common = suffix_array.kasai(np.frombuffer(text, np.uint8), sa, np.array([0]))
        for a, b, c in zip(want, want[1:], common[1:], strict=False):
            k = 0
            while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
                k += 1
            assert min(k, 64) == min(c, 64)


def test_slices_are_merged_by_binary_search():
    rng = random.Random(4)
    for alphabet in (b"ab", b"\x00a", bytes(range(200, 256))):
        strings = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(30)]
        owners = np.array([rng.randrange(9) for _ in strings])
        for size in (20, 90, 1 << 20):
            for s, low in zip(strings, suffix_array.least_owner(strings, owners, 7, size), strict=True):
                assert low.tolist() == [min(o for t, o in zip(strings, owners, strict=True) if s[i:i + 7] in t) for i in range(len(s) - 6)]


def test_near_copies_inside_a_hot_passage(spark):
    """Many documents hold one passage amid their own words, a few hold little else: only those are near copies."""
    passage, rng = prose(78, 302, 100_000), random.Random(7)
    data = [(i, f"{passage} {prose(5000 + i, rng.randrange(90, 120), 100_000)}") for i in range(400)]
    data += [(1000 + i, f"{passage} {prose(9000 + i, 20, 100_000)}") for i in range(2)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs(spark, data)).collect()}
    assert got == brute_components(data, 3, 85)
    assert got[1000][1] == got[1001][1] == 1000


def test_texts_that_share_an_id_are_dropped_apart(spark):
    """Id 5 has a near copy of document 1, two texts of its own and one of them twice: only the near copy goes."""
    first, words = prose(1, 200), prose(1, 200).split()
    words[100] = "changed"
    data = [(1, first), (5, " ".join(words)), (5, prose(2, 200)), (5, prose(3, 200), "b"), (5, prose(3, 200), "a"), (None, None)]
    left = [rows(minhash.drop_near_duplicates(docs(spark, x)), "doc_id", "text", "source") for x in (data, data[::-1])]
    assert [r[:2] for r in left[0]] == sorted([(1, first), (5, prose(2, 200)), (5, prose(3, 200)), (None, None)], key=repr)
    assert left[0] == left[1]


def test_unlinked_texts_of_one_passage_make_few_pairs(spark, monkeypatch):
    """2,000 texts share a passage and nothing else; some of them have near copies."""
    passage, rng = prose(77, 40, 10_000), random.Random(9)
    data = [(i, passage + " " + prose(5_000 + i, rng.randrange(20, 90), 100_000)) for i in range(2000)]
    data += [(10_000 + i, data[i][1] + " more") for i in range(0, 2000, 100)]
    tested, write = [], minhash.stage_table

    def counted(df, name):
        table = write(df, name)
        if name == "pairs":
            tested.append(table.count())
        return table

    monkeypatch.setattr(minhash, "stage_table", counted)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(spark, data)).collect()}
    assert got == {d: d - 10_000 if d >= 10_000 else d for d, _ in data}
    assert sum(tested) < 20 * len(data)
