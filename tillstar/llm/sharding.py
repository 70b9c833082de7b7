"""Proportional stratified interleaving into shards (DataFrame operations only).

Rows are shuffled within their source by a seeded hash, ranked, and every
row gets the fractional rank ``(rank - phase) / rows of its source``; sorting
all rows by that fraction spreads every source evenly over the whole order,
so that cutting it into equal parts gives each part the corpus's mixture.

Neither ranking needs a whole source, or the whole table, in one task.  The
seeded hash is uniform, so its leading bits cut a source into even buckets:
a row's rank is the count of the buckets before its own plus its row number
within the bucket.  Fractions are uniform too, and the global position is
found in the same way from even slices of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import stage_table


def _unit(h: Column) -> Column:
    """A 64-bit hash as a double in [0, 1)."""
    return F.shiftrightunsigned(h, 11).cast("double") * F.lit(2.0 ** -53)


def interleaved_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id",
                       text_col: str = "text", stratum_col: str = "source",
                       seed: int = 7, buckets: int = 4096) -> DataFrame:
    """Deal all rows to ``n_shards`` shards, each with the corpus's mix of sources.

    Returns one row per input row: ``doc_id, size`` (UTF-8 bytes plus 1; a
    null text counts as empty), ``text_crc32, law`` (``rows``: the counts of
    two shards differ by at most one), ``shard, slot`` (0, 1, ... within the
    shard, in the interleaved order), ``grown_shard`` (null), ``source``.

    A source's rows differ by at most one from shard to shard plus what the
    cut points take; a null source is a stratum of its own, sources of one
    row are spread by their phase.  Null ids and repeated rows are rows like
    any other (repeats are interchangeable, so the result is the same
    whichever comes first).  An empty table gives an empty result.  Columns
    beside the three named ones are ignored, whatever their names.

    ``buckets`` bounds a task: at most about rows / ``buckets`` rows of a
    source, or of the whole table, are sorted together.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    src = F.col(stratum_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        src.alias("source"),
        F.when(src.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), src)).alias("stratum"),
    )
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "size", "text_crc32"))
    bits = buckets.bit_length() - 1
    rows = rows.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits).cast("int"))
    # The texts are read once; all that follows works on these narrow rows.
    rows = stage_table(rows, "strata")

    per = rows.groupBy("stratum", "bucket").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("stratum").orderBy("bucket")
    whole = Window.partitionBy("stratum")
    per = per.select(
        "stratum", "bucket",
        (F.sum("n").over(along) - F.col("n")).alias("before"),
        F.sum("n").over(whole).alias("total"))
    within = Window.partitionBy("stratum", "bucket").orderBy("h", "doc_id", "size", "text_crc32")
    ranked = rows.join(per, ["stratum", "bucket"])
    ranked = ranked.withColumn("rank", F.col("before") + F.row_number().over(within))
    phase = _unit(F.xxhash64(F.lit(seed + 1), F.col("stratum")))
    ranked = ranked.withColumn("frac", (F.col("rank") - phase) / F.col("total"))
    ranked = ranked.withColumn("slice", F.least(F.floor(F.col("frac") * buckets), F.lit(buckets - 1)).cast("int"))
    ranked = stage_table(ranked.drop("before", "total", "rank", "bucket"), "ranked")

    # At most ``buckets`` rows, so one task and a broadcast are bounded.
    cuts = ranked.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
    cuts = cuts.select(
        "slice",
        (F.sum("n").over(Window.orderBy("slice")) - F.col("n")).alias("before"),
        F.sum("n").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    order = Window.partitionBy("slice").orderBy("frac", "stratum", "h", "doc_id", "size", "text_crc32")
    placed = ranked.join(F.broadcast(cuts), "slice")
    placed = placed.withColumn("pos", F.col("before") + F.row_number().over(order) - 1)
    placed = placed.withColumn("shard", F.expr(f"pos * {n_shards}L div total").cast("int"))
    start = F.expr(f"(shard * total + {n_shards - 1}L) div {n_shards}L")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("pos") - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "source")
