"""Benchmark decontamination by spaced seeds (DataFrame operations only).

A mask looks at some of the ``SPAN`` words from a position on and ignores
the others, so that a changed word spoils only the masks that look at it.
The hashes of all masks at all positions of a document are joined with those
of the benchmark; every hit places an item against the document, and the two
are compared word by word along that placement.  Hits are reduced to distinct
placements before any text is fetched again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stage_table

#: Word offsets that each mask looks at.  However a fifth of 9 to 15 words in a row is changed
#: (one of 9, two of 10 to 14, three of 15), some mask at some position sees none of the changes.
MASKS = ((0, 1, 2, 3, 7), (0, 2, 4, 5, 7), (0, 3, 4, 6, 7))
SPAN = 8
#: Items of fewer words are looked for as a whole.
SHORT = 9


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits of a whole text; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _seeded(df: DataFrame, text: str, *keep: str, whole: Sequence[int] = (), short: bool = False) -> DataFrame:
    """A row per mask and position: ``keep, n_words, pos`` (of the first word), ``seed``.

    ``whole``: numbers of words of which all runs are seeds too.  With
    ``short`` a text of fewer than ``SHORT`` words is one seed, its whole
    sequence.
    """
    df = df.select(*keep, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("_w"))
    df = df.withColumn("n_words", F.size("_w"))

    def seeds(span: int, seed) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.greatest(F.col("n_words") - span, F.lit(0))),
                            lambda i: F.struct(i.alias("pos"), seed(i).alias("seed")))
        return F.when(F.col("n_words") >= span, every).otherwise(F.array().cast("array<struct<pos:int,seed:bigint>>"))

    found = [seeds(SPAN, lambda i, k=k, m=m: F.xxhash64(F.lit(k), *(F.get("_w", i + o) for o in m))) for k, m in enumerate(MASKS)]
    found += [seeds(n, lambda i, n=n: F.xxhash64(F.lit(-n), F.slice("_w", i + 1, F.lit(n)))) for n in whole]
    found = F.concat(*found)
    if short:
        one = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(-F.col("n_words"), "_w").alias("seed")))
        found = F.when(F.col("n_words").between(1, SHORT - 1), one).otherwise(found)
    return df.select(*keep, "n_words", F.inline(found))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = 15,
                 similarity: float = 0.8, broadcast_rows: int = 2_000_000) -> DataFrame:
    """Documents that hold a passage of a benchmark item, a few words of it changed or not.

    Returns one row per document and item: ``doc_id, item_id, similarity``
    (the best share of equal words in a stretch of ``window`` words, or of the
    whole item if it is shorter, among all placements), ``equal_words,
    placed_words`` (along the whole of that placement), ``first_word`` (in the
    document, from 0).  A pair counts from ``similarity`` on.

    From nine words on, no pair that counts is missed, whichever words are
    changed (at 0.8 and 15).  Items of fewer words are found where their
    whole sequence of words occurs unchanged, however short, so a one-word
    item marks every document with that word; leave such items out if that
    is not wanted.  Texts without words, null and empty ones among them,
    match nothing.  Rows with a null id, in either table,
    are left out.  Repeated rows, and rows that share an id, are one document
    or item.  Empty tables give an empty result.

    The benchmark's seeds are broadcast if they are at most
    ``broadcast_rows``; beyond that both sides are shuffled by seed.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")).where("doc_id is not null")
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("_text")).where("item_id is not null")
    items = items.distinct()
    seeds = _seeded(items, "_text", "item_id", short=True)
    seeds = stage_table(seeds.withColumnsRenamed({"pos": "item_pos", "n_words": "item_words"}).distinct(), "seeds")
    # Eight numbers at most.
    whole = sorted(r[0] for r in seeds.where(F.col("item_words") < SHORT).select("item_words").distinct().collect())
    if seeds.count() <= broadcast_rows:
        seeds = F.broadcast(seeds)
    hits = _seeded(plain, "_text", "doc_id", whole=whole).join(seeds, "seed")
    shift = F.col("pos") - F.col("item_pos")
    # A placement's words in both texts, and those it needs: a document's end can leave it too few.
    fits = F.least("item_words", F.col("n_words") - shift) - F.greatest(-shift, F.lit(0)) >= F.least("item_words", F.lit(window))
    hits = hits.where(fits).select("doc_id", "item_id", "item_words", shift.alias("shift")).distinct()
    hits = stage_table(hits, "placements")
    # A document's placements are no more than its own words times the items they hit.
    per = hits.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "item_words", "shift")).alias("hits"))
    # Merged at every size: how many documents are hit follows the corpus, so
    # their list is not for a broadcast.
    found = plain.join(per.hint("merge"), "doc_id").select("doc_id", words(F.col("_text")).alias("w"), "hits")
    whole_items = stage_table(items.select("item_id", words(F.col("_text")).alias("iw")), "items")
    # Each placement takes its own item's number of words along.
    found = found.select("doc_id", F.explode(F.transform("hits", lambda h: F.struct(
        h["item_id"].alias("item_id"), h["item_words"].alias("item_words"), h["shift"].alias("shift"),
        F.greatest(h["shift"], F.lit(0)).alias("from"),
        F.slice("w", F.greatest(h["shift"], F.lit(0)) + 1,
                h["item_words"] + F.least(h["shift"], F.lit(0))).alias("dw")))).alias("h"))
    pair = found.select("doc_id", "h.*").join(whole_items, "item_id").where(F.size("iw") == F.col("item_words"))
    skip = F.greatest(-F.col("shift"), F.lit(0))
    pair = pair.withColumn("len", F.least(F.size("dw"), F.size("iw") - skip)).withColumn("need", F.least(F.size("iw"), F.lit(window)))
    pair = pair.where("len >= need")
    pair = pair.withColumn("eq", F.zip_with(F.slice("dw", F.lit(1), F.col("len")), F.slice("iw", skip + 1, F.col("len")),
                                            lambda a, b: (a == b).cast("int")))

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda a, b: a + b)

    best = F.array_max(F.transform(F.sequence(F.lit(1), F.col("len") - F.col("need") + 1),
                                   lambda s: total(F.slice("eq", s, F.col("need")))))
    pair = pair.withColumn("similarity", best / F.col("need")).withColumn("equal_words", total(F.col("eq")))
    pair = pair.where(F.col("similarity") >= similarity)
    top = pair.groupBy("doc_id", "item_id").agg(F.max(F.struct(
        "similarity", "equal_words", (-F.col("len")).alias("l"), (-F.col("from")).alias("f"))).alias("t"))
    return top.select("doc_id", "item_id", "t.similarity", F.col("t.equal_words").cast("long").alias("equal_words"),
                      (-F.col("t.l")).cast("long").alias("placed_words"), (-F.col("t.f")).cast("long").alias("first_word"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that hold no passage of the benchmark, with all their columns; null ids stay."""
    bad = contaminated(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(stage_table(bad, "contaminated"), id_col, "left_anti").select(*docs.columns)
