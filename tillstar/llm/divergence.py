"""How the sources of a language differ in their use of terms.

Terms travel as 64-bit digests.  A task counts the terms of its texts and
writes digest, counts and, once for each language and digest, the term
itself; the groupings read the columns of fixed width only.  Strings are read
back where a digest is frequent enough to be kept: the smallest and the
largest string of a digest tell whether it stands for one term, and those that
stand for several are counted anew by string.  After that only the rows of
the result get their text.

All arithmetic is in integers: a term's share in a group is
``1 + floor(SCALE * (count + 5) / (N + 5 * V))``, ``N`` the kept terms'
occurrences there and ``V`` their number in the language.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookups import sized_broadcast
from ..sources.sinks import stage_table

#: The bytes of terms (in UTF-8, A-Z lower-cased): letters, and all that is not ASCII.
TERM, OTHER = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")
#: Counters of a task are written out beyond this many entries.
ENTRIES = 600_000
#: Bytes of a text that are split at once.
PIECE = 1 << 20
#: Cells of a block, and of a matrix, of the comparison of sources.
CELLS = 1 << 21
SCALE = 1_000_000_000


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces that no term spans."""
    at = 0
    while len(text) - at > PIECE:
        cut = OTHER.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _counted(docs: DataFrame, bits: int, all_terms: bool) -> DataFrame:
    """``lang, source, digest, n, docs, term`` of each task's texts.

    ``term`` is given once for a language and digest, or always (``all_terms``).
    """
    mask = (1 << bits) - 1

    def run(batches):
        seen = defaultdict(lambda: (Counter(), Counter()))

        def rows():
            cols, named = [], defaultdict(set)
            for (lang, source), (uses, in_docs) in seen.items():
                if not uses:
                    continue
                new = list(uses) if all_terms else list(uses.keys() - named[lang])
                named[lang].update(new)
                terms = new + list(uses.keys() - set(new))
                k = len(terms)
                digest = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, k) & np.uint64(mask)
                cols.append([pa.repeat(pa.scalar(lang), k), pa.repeat(pa.scalar(source), k), pa.array(digest.view(np.int64)),
                             *(pa.array(np.fromiter(map(c.__getitem__, terms), np.int64, k)) for c in (uses, in_docs)),
                             pa.array(new + [None] * (k - len(new)), pa.binary()).cast(pa.string())])
            seen.clear()
            for arrays in cols:
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "source", "digest", "n", "docs", "term"])

        entries = 0
        for batch in batches:
            langs, sources = (batch.column(k).to_pylist() for k in (0, 1))
            texts = batch.column(2).cast(pa.binary())
            for a, b, text in zip(langs, sources, texts, strict=True):
                uses, in_docs = seen[a, b]
                before, own = len(uses), set()
                for piece in _pieces(text.as_py().lower()):
                    words = TERM.findall(piece)
                    uses.update(words)
                    own.update(words)
                in_docs.update(own)
                entries += len(uses) - before
                if entries > ENTRIES:
                    yield from rows()
                    entries = 0
        yield from rows()

    return docs.mapInArrow(run, "lang string, source string, digest long, n long, docs long, term string")


def share(count: str, n: str, v: str) -> Column:
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({count} + 5 as decimal(20, 0))) div cast({n} + 5 * {v} as decimal(20, 0))")


def kept_terms(docs: DataFrame, least_docs: int, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """Terms in ``least_docs`` or more documents of a language, and their counts by source.

    Gives ``lang, digest, part, term`` and ``lang, source, digest, part, n``;
    ``part`` is empty, or the term where a digest stands for several.
    """
    counted = stage_table(_counted(docs, bits, False), "counted")
    likely = counted.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).select("lang", "digest")
    likely = stage_table(likely, "likely")
    names = counted.where("term is not null").select("lang", "digest", "term").join(sized_broadcast(likely), ["lang", "digest"], "left_semi")
    names = stage_table(names.groupBy("lang", "digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "names")
    one = names.where("low = high").select("lang", "digest", F.lit("").alias("part"), F.col("low").alias("term"))
    cells = counted.select("lang", "source", "digest", "n").join(
        sized_broadcast(one.select("lang", "digest")), ["lang", "digest"], "left_semi").groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"))
    cells = cells.select("lang", "source", "digest", F.lit("").alias("part"), "n")
    several = names.where("low <> high").select("lang", "digest")
    if several.isEmpty():
        return one, cells
    again = _counted(docs, bits, True).join(sized_broadcast(several), ["lang", "digest"], "left_semi")
    again = stage_table(again.groupBy("lang", "source", "digest", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "split")
    split = stage_table(again.groupBy("lang", "digest", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).select(
        "lang", "digest", F.col("term").alias("part"), "term"), "split")
    more = again.withColumnRenamed("term", "part").join(split.select("lang", "digest", "part"), ["lang", "digest", "part"], "left_semi")
    return one.unionByName(split), cells.unionByName(more.select("lang", "source", "digest", "part", "n"))


def _distances(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, value``: the sum of the differences of two sources' shares, for numbers ``a < b`` of sources.

    The terms of a language are dealt to blocks.  A block's task has a row of
    shares for each source, which it compares source by source; with very
    many sources, several tasks have the same block and a stripe of the rows.
    """
    per_lang = cells.groupBy("lang").agg(F.count(F.lit(1)).alias("cells"))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s")).join(per_lang, "lang", "left").select(
        "lang", F.greatest(F.lit(1), F.ceil(F.coalesce("cells", F.lit(0)) * 8 / CELLS)).cast("int").alias("blocks"),
        F.ceil(F.col("s") * F.col("s") / CELLS).cast("int").alias("stripes"))
    sizes = sized_broadcast(stage_table(sizes, "sizes"))
    rows = groups.join(sizes, "lang").select(
        "lang", "k", "p0", "stripes", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    cells = cells.join(sizes, "lang").select("lang", "k", "digest", "part", "p", "stripes", F.pmod(F.xxhash64("digest", "part"), F.col("blocks")).cast("int").alias("block"))
    stripe = F.explode(F.sequence(F.lit(0), F.col("stripes") - 1)).alias("stripe")
    rows = rows.select("lang", "k", "p0", (F.col("stripes") + 0).alias("of"), "block", stripe)
    cells = cells.select("lang", "k", "digest", "part", "p", "block", stripe)
    keys = ["lang", "block", "stripe"]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        s, stripe, stripes = len(right), key[2].as_py(), right["of"][0].as_py()
        mine = range(stripe * s // stripes, (stripe + 1) * s // stripes)
        base = np.empty(s, np.int64)
        base[right["k"].to_numpy()] = right["p0"].to_numpy(zero_copy_only=False)
        total = np.zeros((len(mine), s), np.int64)
        if len(left):
            number: dict = {}
            term = np.fromiter((number.setdefault(x, len(number)) for x in zip(
                left["digest"].to_pylist(), left["part"].to_pylist(), strict=True)), np.int64, len(left))
            order = np.argsort(term, kind="stable")
            term, who, p = term[order], left["k"].to_numpy()[order], left["p"].to_numpy()[order]
            width = max(1, CELLS // s)
            for at in range(0, len(number), width):
                lo, hi = np.searchsorted(term, (at, at + width))
                full = np.repeat(base[:, None], min(width, len(number) - at), 1)
                full[who[lo:hi], term[lo:hi] - at] = p[lo:hi]
                for i, a in enumerate(mine):
                    total[i, a + 1:] += np.abs(full[a + 1:] - full[a]).sum(1)
        a = np.repeat(np.arange(mine.start, mine.stop), s)
        b = np.tile(np.arange(s), len(mine))
        own = b > a
        return pa.table({"lang": pa.array([key[0].as_py()] * int(own.sum()), pa.string()), "a": a[own], "b": b[own], "value": total.ravel()[own]})

    out = cells.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(run, "lang string, a long, b long, value long")
    return out.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _leading(found: DataFrame, most: int) -> DataFrame:
    """Rows whose value is one of the ``most`` largest of their group, with all that tie with the last."""
    tally = found.groupBy("lang", "source", "value").agg(F.count(F.lit(1)).alias("rows"))
    down = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    top = tally.withColumn("at", F.row_number().over(down)).where(F.col("at") <= most)
    cut = top.withColumn("before", F.sum("rows").over(down) - F.col("rows")).where(F.col("before") < most)
    cut = cut.groupBy("lang", "source").agg(F.min("value").alias("least"))
    return found.join(sized_broadcast(stage_table(cut, "cut")), ["lang", "source"]).where("value >= least").drop("least")


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, bits: int = 64, lang_col: str = "lang",
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (language, source) that occurs.

    ``part`` ``pair``: ``item`` is each other source of the language, ``value``
    the sum over the kept terms of the differences of the shares.  ``part``
    ``term``: the ``top`` kept terms that the source has and whose share in it
    exceeds that in the language by most; ``value`` is by how much.  Ranks
    are by value, largest first, then by item in UTF-8 order.

    Null languages, sources and texts are empty ones.  A source without terms
    has pairs; a language without kept terms has pairs of value 0; a language
    of one source has no pairs.  Repeated rows count as often as they occur.
    An empty table gives an empty result.
    """
    narrow = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                           for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    terms, cells = kept_terms(narrow, least_docs, bits)
    terms, cells = stage_table(terms, "terms"), stage_table(cells, "cells")
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    v = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = narrow.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(v, "lang", "left").select(
        "lang", "source", F.coalesce("n_all", F.lit(0)).alias("n_all"), F.coalesce("v", F.lit(0)).alias("v"),
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long").alias("k"))
    groups = stage_table(groups.withColumn("p0", F.when(F.col("v") > 0, share("0", "n_all", "v")).otherwise(F.lit(0))), "groups")
    known = sized_broadcast(groups)
    cells = stage_table(cells.join(known, ["lang", "source"]).withColumn("p", share("n", "n_all", "v")), "shares")

    pairs = stage_table(_distances(cells, groups), "pairs")
    both = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = sized_broadcast(groups.select("lang", "source", "k"))
    both = both.join(names.withColumnRenamed("k", "a"), ["lang", "a"]).join(
        names.select("lang", F.col("source").alias("item"), F.col("k").alias("b")), ["lang", "b"])
    both = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    whole = groups.groupBy("lang").agg(F.sum("n_all").alias("n_lang"))
    in_lang = cells.groupBy("lang", "digest", "part").agg(F.sum("n").alias("n_term"), F.first("v").alias("v")).join(
        sized_broadcast(whole), "lang").select("lang", "digest", "part", share("n_term", "n_lang", "v").alias("q"))
    found = cells.join(in_lang, ["lang", "digest", "part"]).where("p > q").select(
        "lang", "source", "digest", "part", (F.col("p") - F.col("q")).alias("value"))
    found = _leading(stage_table(found, "found"), top).join(terms, ["lang", "digest", "part"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return both.withColumn("rank", F.row_number().over(order)).unionByName(
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
