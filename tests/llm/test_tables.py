"""Sharding, url filter, chat, packing, nearest neighbours and decontamination on small fixtures."""

import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillstar.llm import ann, chat, decontam, packing, sharding, url_tree

from .helpers import EDGE, docs, prose, rows


def test_shards_are_even_and_mixed(spark):
    data = [(i, prose(i, 5), "big" if i % 3 == 0 else f"s{i % 40}") for i in range(1500)] + [(5000, "x", None), (None, None, None)] + [(7, "r", "s1")] * 3
    got = sharding.interleaved_shards(docs(spark, data)).collect()
    assert len(got) == len(data)
    slots, by = {}, {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        by.setdefault(r.source, Counter())[r.shard] += 1
    assert sorted(slots) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert max(by["big"][s] for s in range(16)) - min(by["big"][s] for s in range(16)) <= 4
    texts = {d: t for d, t, *_ in data}
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None) or r.doc_id == 7


def test_shards_of_edges(spark):
    assert sharding.interleaved_shards(docs(spark, EDGE)).count() == len(EDGE)
    assert sharding.interleaved_shards(docs(spark, [])).count() == 0
    alone = [(i, "t", f"only{i}") for i in range(64)]
    assert set(Counter(r.shard for r in sharding.interleaved_shards(docs(spark, alone)).collect()).values()) == {4}


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def test_urls_hosts_paths_and_rules(spark):
    urls = {1: ("http://A.Example.ORG/en/12?x#y", "a.example.org", "/en/12", "example.org/en/1", "block"),
            2: ("https://example.org/es/", "example.org", "/es/", "example.org/es/", "block"),
            3: ("x://notexample.org/es/a", "notexample.org", "/es/a", "org/", "allow"),
            4: ("http://b.com?/fr/", "b.com", "", None, "allow"), 5: (None, "", "", None, "allow"),
            6: ("no scheme.org/", "", "", None, "allow"), 7: ("http://É.org#/x", "É.org", "", None, "allow"),
            8: ("http://u.com/de/a://b", "u.com", "/de/a://b", "com/de/", "block"), 9: ("", "", "", None, "allow")}
    pages = spark.createDataFrame([(k, v[0], "c") for k, v in urls.items()], "page_id long, url string, rule string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = {r[0]: r[1:] for r in rows(url_tree.filter_urls(pages, none, RULES), "page_id", "host", "path", "rule", "verdict")}
    assert got == {k: v[1:] for k, v in urls.items()}
    assert url_tree.filter_urls(pages.limit(0), none, RULES).count() == 0


def test_bad_branch_is_rejected_and_others_merge(spark):
    pages, lab = [], []
    for i in range(600):
        kind = ["news", "wiki", "casino"][i % 3]
        pages.append((i, f"http://h.net/{kind}/{i}/p{i % 7}"))
        if i % 2:
            lab.append((i, kind == "casino"))
    pages += [(700, "http://h.net/" + "/".join("abcdefghijklm")), (None, "http://h.net/casino/9/p1"), (3, pages[3][1])]
    page = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame([*lab, (None, True), (4, None), (1, False)], "page_id long, bad boolean")
    got = url_tree.filter_urls(page, labels).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.verdict == ("block" if "/casino/" in r.path else "allow")
    assert {r.template for r in got if "/casino/" in r.path} == {"h.net/casino/*/*"}
    assert {r.template for r in got if "/news/" in r.path or "/wiki/" in r.path} <= {"h.net/*/*/*", "h.net/news/*/*", "h.net/wiki/*/*"}
    # Without labels nothing is known against any branch.
    assert {r.verdict for r in url_tree.filter_urls(page, labels.limit(0)).collect()} == {"allow"}


def test_snapshots_collapse(spark):
    def conv(c, *turns):
        return [(c, i, "user" if i % 2 == 0 else "assistant", t, "z") for i, t in enumerate(turns)]

    data = conv(1, "a") + conv(2, "a", "b") + conv(3, "a", "b", "c") + conv(4, "a", "x") + conv(5, "a", "x") + conv(9, "", None)
    data += [(6, 0, None, None, "z"), (None, 0, "user", "a", "z"), (7, None, "user", "n", "z"), (7, 1, "user", "m", "z"), (8, 0, "user", "d", "z"), (8, 0, "user", "d", "z")]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, place string")
    got = {r.conv_id: r for r in chat.maximal_conversations(turns).collect()}
    assert sorted(got) == [3, 4, 6, 7, 8, 9]
    assert got[3].rendered == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n"
    assert (got[4].n_snapshots, got[4].n_turns, got[8].n_turns) == (1, 2, 2)
    assert got[7].rendered.index("n<") < got[7].rendered.index("m<")
    assert got[6].rendered == "<|im_start|>\n<|im_end|>\n"
    assert chat.maximal_conversations(turns.limit(0)).count() == 0


def test_packing_round_trip(spark):
    data = [(i, prose(i, random.Random(i).choice([1, 50, 400, 3000]))) for i in range(60)]
    data += [(d if d is None else d + 1000, t) for d, t in EDGE if d not in (5, None)] + [(2000, "a<|endoftext|>b's  \n\n x")]
    got = packing.pack(docs(spark, data).repartition(3), hold=16, with_ids=True).collect()
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by, seqs = {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    for d, t in data:
        ids = [*encode.encode(t or "", add_special_tokens=False).ids, 0]
        parts = sorted(by.pop(d), key=lambda r: r.start)
        assert [x for r in parts for x in r.ids] == ids
        for r in parts:
            assert r.doc_tokens == len(ids) and r.length == len(r.ids) and ids[r.start:r.start + r.length] == r.ids
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert not by
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    used = sum(r.length for r in got)
    assert len(seqs) <= used / 1024 + 3 * (len(data) / 16 + 1)
    assert packing.pack(docs(spark, [])).count() == 0
    repeats = packing.pack(docs(spark, [(5, "one two"), (5, "one two"), (None, "q")])).collect()
    assert len({(r.sequence_id, r.offset) for r in repeats}) == 3


@pytest.mark.parametrize("filling", [" ", "\n", "a", "<|endoftext|>"])
def test_packing_of_runs_of_two_million(spark, filling):
    from tokenizers import Tokenizer
    import public_tokenizers

    text = filling * (2_000_000 // len(filling))
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    got = sorted(packing.pack(docs(spark, [(1, text)]), with_ids=True).collect(), key=lambda r: r.start)
    assert [i for r in got for i in r.ids] == [*ids, 0]


def brute_assignment(sizes, capacity, linear, quadratic):
    """Piece by piece, longest first, to the cheapest sequence with room, cut where none has."""
    total = sum(sizes)
    used, cost = [0] * -(-total // capacity), [0.0] * -(-total // capacity)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = 0
        while at < sizes[i]:
            left = sizes[i] - at
            fits = [s for s in range(len(used)) if capacity - used[s] >= left] or [s for s in range(len(used)) if used[s] < capacity]
            s = min(fits, key=lambda s: (cost[s], s))
            n = min(left, capacity - used[s])
            yield i, at, n, s, used[s]
            used[s] += n
            cost[s] += linear * n + quadratic * n * n
            at += n


@pytest.mark.parametrize("seed", range(6))
def test_assignment_matches_brute_force(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 5, 16, 30, 31, 32, rng.randrange(1, 33)]) for _ in range(rng.randrange(1, 80))]
    assert list(packing.sequences_for(sizes, 32, 1.0, 0.25)) == list(brute_assignment(sizes, 32, 1.0, 0.25))


def test_costs_are_balanced():
    sizes = [random.Random(i).randrange(1, 400) for i in range(500)]
    cost = Counter()
    for _, _, n, s, _ in packing.sequences_for(sizes, 1024, 1.0, 1 / 1024):
        cost[s] += n + n * n / 1024
    assert max(cost.values()) / (sum(cost.values()) / len(cost)) < 1.15


def brute_nearest(vectors, k):
    ids = np.array([i for i, _ in vectors])
    v = np.array([x for _, x in vectors], float)
    return {q: [(int(ids[j]), float(v[j] @ v[i])) for j in np.lexsort((ids, -(v @ v[i]))) if j != i][:k]
            for i, q in enumerate(ids.tolist()) if q % 20 == 0}


@pytest.mark.parametrize("unit", [True, False])
def test_neighbours_recall_and_scores(spark, unit):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 24))
    x = centres[rng.integers(0, 12, 3000)] + 0.4 * rng.standard_normal((3000, 24))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x
    data = [(i, [float(c) for c in row]) for i, row in enumerate(x)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0"), shard_rows=500, query_rows=64).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_nearest(data, 20)
    assert sorted(got) == sorted(want) and all(len(v) == 20 for v in got.values())
    hit = [len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hit) >= 0.9
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(s - float(x[i] @ x[q])) < 1e-12 for _, i, s in found)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)


def test_scan_keeps_the_nearest_and_gathers_few(monkeypatch):
    """Many pairs left: products of blocks, no columns gathered for each pair.  Few left: the same pairs as one by one."""
    rng, gathered = np.random.default_rng(4), []
    q, x = rng.standard_normal((40, 33)), rng.standard_normal((900, 33))
    plain = np.einsum
    monkeypatch.setattr(ann.np, "einsum", lambda what, *of: gathered.append(of[0].size) or plain(what, *of))
    far = ((q[:, None] - x[None]) ** 2)
    kth = np.sort(far.sum(2), 1)[:, 20]
    for best in (np.full(40, np.inf), kth.copy(), np.full(40, 1e-3)):
        want = np.ones((40, 900), bool)
        for j in (16, 32, 33):
            want &= far[:, :, :j].sum(2) <= (best * (1 if j == 33 else j / 33 * (1 + 2.1 / j ** 0.5) ** 2) + 1e-9)[:, None]
        gathered.clear()
        who, rows = ann.scan_block(q, x, best, 21, 16, 2.1)
        assert list(zip(who.tolist(), rows.tolist(), strict=True)) == list(zip(*(k.tolist() for k in np.nonzero(want)), strict=True))
        assert sum(gathered) < 40 * 900 * 4
    who, rows = ann.scan_block(q, x, near := np.full(40, np.inf), 21, 16, 2.1)
    assert len(who) == 40 * 900 and np.allclose(near, kth)


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (20, [-1.0, 0.5]), (40, None)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = rows(ann.nearest(df, df.where("vec_id % 20 = 0")), "query_id", "rank", "vec_id", "score")
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -1.0), (20, 3, 2, -1.0)]
    assert ann.nearest(df.limit(0), df).count() == 0 and ann.nearest(df, df.limit(0)).count() == 0


def test_no_pattern_of_changed_words_hides_an_item(spark):
    data, want = [], set()
    for n in range(9, 16):
        for changed in combinations(range(n), n // 5):
            words = [f"x{len(data)}" if i in changed else f"w{n}i{i}" for i in range(n)]
            want.add((len(data), n, (n - len(changed)) / n))
            data.append((len(data), f"a{len(data)} b{len(data)} " + " ".join(words) + f" c{len(data)}"))
    far = {n: [f"w{n}i{i}" if i > n // 5 else "other" for i in range(n)] for n in range(9, 16)}
    data += [(10_000 + n, " ".join(["start", *w, "end"])) for n, w in far.items()]
    bench = spark.createDataFrame([(n, " ".join(f"w{n}i{i}" for i in range(n))) for n in range(9, 16)], "item_id long, text string")
    assert set(rows(decontam.contaminated(docs(spark, data), bench), "doc_id", "item_id", "similarity")) == want


def test_items_under_nine_words_are_found_as_they_are(spark):
    items = [(n, " ".join(f"s{n}i{i}" for i in range(n))) for n in range(1, 9)] + [(20, "What is the capital of France?"), (21, "?!")]
    data = [(n, f"before {t.upper()} after") for n, t in items if n < 9]
    data += [(100 + n, " ".join(["x", *t.split()[:-1], "y"])) for n, t in items if n < 9]
    data += [(200, "Tell: what is the capital of France"), (201, "what is the capital of Spain"), (202, "what is the"), (203, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontam.contaminated(docs(spark, data), bench), "doc_id", "item_id", "similarity", "placed_words")
    assert set(got) == {(n, n, 1.0, n) for n in range(1, 9)} | {(200, 20, 1.0, 6)}


def test_leaks_are_found_with_changed_words(spark):
    items = [(i, prose(1000 + i, 30, 5000)) for i in range(20)]
    data, want = [], set()
    for d in range(120):
        words = prose(d, 200, 5000).split()
        if d % 4 == 0:
            leak = items[d % 20][1].split()
            for k in range(d % 3):
                leak[5 + 9 * k] = "changed"
            words[50:50] = leak
            want.add((d, d % 20))
        if d % 4 == 1:
            words[50:50] = items[d % 20][1].split()[:8]
        data.append((d, " ".join(words).upper().replace(" ", " - ") if d % 8 == 0 else " ".join(words)))
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "too short to tell"), (None, items[0][1]), items[0]], "item_id long, text string")
    frame = docs(spark, data + [(None if d is None else d + 1000, t) for d, t in EDGE])
    found = decontam.contaminated(frame, bench)
    assert set(rows(found, "doc_id", "item_id")) == want and found.count() == len(want)
    assert rows(decontam.contaminated(frame, bench, broadcast_rows=0), "doc_id", "item_id") == sorted(want, key=repr)
    left = decontam.drop_contaminated(frame, bench)
    assert left.columns == frame.columns and left.count() == frame.count() - len(want)
    assert decontam.contaminated(frame.limit(0), bench).count() == 0 and decontam.contaminated(frame, bench.limit(0)).count() == 0
