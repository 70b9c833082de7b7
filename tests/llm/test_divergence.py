"""Source divergence against a brute-force count, with colliding digests and odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillstar.llm import divergence

from .helpers import DOCS, prose


def brute(data, least_docs, top):
    """Rows of (text, lang, source)."""
    uses, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in data:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        uses[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
        langs[lang or ""].add(source or "")
    for lang, sources in langs.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        v, whole = len(kept), Counter()
        for s in sources:
            whole.update(uses[lang, s])

        def share(counter):
            n = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // (n + 5 * v) for t in kept}

        p, q = {s: share(uses[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [(b, sum(abs(p[s][t] - p[b][t]) for t in kept)) for b in sources if b != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if uses[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                yield from ((lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most]))


def compare(spark, data, least_docs=3, top=5, **options):
    rows = [(i // 2, text, lang, source, 1, "x", 0.5, 1) for i, (text, lang, source) in enumerate(data)]
    got = divergence.audit(spark.createDataFrame(rows, DOCS).repartition(3), least_docs, top, **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = sorted(map(tuple, got.collect()))
    assert got == sorted(brute(data, least_docs, top))
    return got


def corpus(seed, n=120):
    rng = random.Random(seed)
    return [(prose(rng.randrange(10**6), rng.randrange(0, 60), 80).replace("w", rng.choice(["", "W", "é", "x "])).replace("1", "a").replace("2", "B"),
             rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "S3", None, "é"])) for _ in range(n)]


@pytest.mark.parametrize("bits", [64, 3, 0])
def test_digests_that_collide_are_split(spark, bits):
    compare(spark, corpus(1), bits=bits)


def test_odd_rows(spark):
    data = [(None, None, None), ("", "en", "only"), ("\x00 12 _", "xx", "a"), ("12", "xx", "b"), ("Naïve ÉCOLE日本 a-b", "en", "s")] * 3
    data += [("É é E e" * 5, "fr", "s"), ("tie tie up up", "fr", "t"), ("tie up", "fr", "u")] * 4
    data += [(("ab " * 900_000) + "z" * 2_000_000 + " end", "en", "long")] * 3
    got = compare(spark, data)
    assert ("xx", "a", "pair", "b", 0, 1) in got


def test_small_blocks_pieces_and_counters(spark, monkeypatch):
    """Many blocks and stripes, texts cut in pieces, counters written out often."""
    want = compare(spark, corpus(2, 200))
    monkeypatch.setattr(divergence, "CELLS", 6)
    monkeypatch.setattr(divergence, "PIECE", 7)
    monkeypatch.setattr(divergence, "ENTRIES", 50)
    assert compare(spark, corpus(2, 200)) == want


def test_no_rows(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_many_sources_and_ties_at_the_last_rank(spark):
    data = [(f"all {chr(97 + i % 26)}{chr(97 + i // 26)} u{chr(97 + i % 7)}", "en", f"s{i % 60}") for i in range(400)]
    compare(spark, data, least_docs=1, top=2)


def test_strings_are_not_shuffled_for_counts(spark):
    df = spark.createDataFrame([(1, "a b", "en", "s", 3, "x", 0.5, 1)], DOCS)
    _, cells = divergence.kept_terms(df.select("lang", "source", "text"), 1)
    assert "term" not in cells.columns and cells.where(F.col("part") != "").count() == 0
