"""Effective-dated lookups: the version or interval valid on a given day.

``lookup_scd2`` (J5) is the SQL point-in-time join: id equal and day inside
``[valid_from, valid_to]``; overlapping versions repeat the fact row, as SQL
does.  Rows without an id can never match; when the dimension is too large to
broadcast they bypass the join, so that they are not shuffled at all.

``first_effective`` (J10, J11) returns, per fact row, the *first listed*
interval that covers the day, optionally falling back to the last listed
row of the key.  It never needs a row id: it resolves the distinct
``(key, day)`` pairs of the facts first (a map-side reduced set, bounded by
keys x days), writes them, picks the winner per pair with ``min_by`` on the
load order in tasks of a bounded number of rows, writes the resolved pairs,
and then joins the facts to them with a plain equi-join that matches at most
once - broadcast when their measured count is under the bound.  A hot key is
spread over its days in both joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import col
from ..sources.sinks import stage_table
from .lookups import BROADCAST_MAX_ROWS


def lookup_scd2(facts: DataFrame, dim: DataFrame, fact_id: str, at, key_col: str,
                default=0, dim_id: str | None = None, valid_from: str = "valid_from",
                valid_to: str = "valid_to",
                max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """LEFT join on id + closed date range; unmatched -> ``default``."""
    dim_id = dim_id or fact_id
    at_c = col(at)
    d = dim.select(F.col(dim_id).alias("_vid"), F.col(valid_from).alias("_vf"),
                   F.col(valid_to).alias("_vt"), F.col(key_col).alias("_vkey"))
    kind = dim.schema[key_col].dataType
    small = dim.count() <= max_rows

    def joined(f: DataFrame, d: DataFrame) -> DataFrame:
        cond = (f[fact_id] == d["_vid"]) & at_c.between(d["_vf"], d["_vt"])
        key = F.coalesce(F.col("_vkey"), F.lit(default)).cast(kind)
        return f.join(d, cond, "left").withColumn(key_col, key).drop("_vid", "_vf", "_vt", "_vkey")

    if small:
        return joined(facts, F.broadcast(d))
    # Facts without an id match nothing: they take the default where they
    # are read, so that they are not shuffled into one partition.
    known = joined(facts.where(F.col(fact_id).isNotNull()), d)
    unknown = facts.where(F.col(fact_id).isNull()).withColumn(key_col, F.lit(default).cast(kind))
    return known.unionByName(unknown.select(*known.columns))


# Above this many intervals on one key, the range join is bucketed by time.
MAX_INTERVALS_PER_KEY = 64
BUCKET_DAYS = 30
# Probe days and intervals that a task of the range join sorts, about; the
# shuffled bytes, by which partitions are merged at run time, say little of
# the memory that the sorts of so many narrow rows take.
ROWS_PER_TASK = 250_000


def _sizes(probes: DataFrame, t: DataFrame, task_rows: int = ROWS_PER_TASK) -> tuple[int, int, int]:
    """The most intervals on one key, the rows of both sides, and how many of them a task is dealt."""
    worst, rows = t.groupBy("_tk").count().agg(F.max("count"), F.sum("count")).first()
    return worst or 0, probes.count() + (rows or 0), task_rows


def _tasks(rows: int, task_rows: int) -> int:
    return max(1, -(-rows // task_rows))


def _covering(probes: DataFrame, t: DataFrame, how: str, max_per_key: int,
              bucket_days: int, sizes: tuple[int, int, int] | None = None) -> DataFrame:
    """Join probe days ``(_k, _d)`` with the intervals ``[_s, _e]`` of their key.

    A plain equi-join on the key compares every probe day of a key with every
    interval of that key.  When some key holds more than ``max_per_key``
    intervals (measured: one aggregate over the interval table), intervals are
    exploded into the ``bucket_days``-wide buckets in which some probe day
    lies; the equi-key becomes ``(key, bucket)``, so a probe day meets only
    the intervals that touch its bucket.  A covering interval always contains
    the probe's bucket, so each matching pair is produced exactly once.  A
    stray day adds one bucket, not all between it and the others.  The list
    of buckets is one row, of at most 10,000 years / ``bucket_days`` numbers.

    Both sides are dealt so that a task has about ``ROWS_PER_TASK`` of them,
    whatever the input: by key, or by key and bucket (``_pb``, a column of
    the result then).  ``sizes`` is what ``_sizes`` gives.
    """
    worst, rows, task_rows = sizes or _sizes(probes, t)
    tasks = _tasks(rows, task_rows)
    if worst <= max_per_key:
        probes, t = probes.repartition(tasks, "_k"), t.repartition(tasks, "_tk")
        return probes.join(t, (probes["_k"] == t["_tk"]) & probes["_d"].between(t["_s"], t["_e"]), how)

    def bucket(d):
        return F.floor(F.unix_date(d) / bucket_days).cast("int")

    present = probes.select(bucket(F.col("_d")).alias("_b")).distinct().agg(F.collect_set("_b").alias("_all"))
    tb = (t.join(F.broadcast(present)).withColumn("_b", F.explode(
        F.filter("_all", lambda b: b.between(bucket(F.col("_s")), bucket(F.col("_e")))))).drop("_all"))
    tasks = _tasks(rows + tb.count(), task_rows)
    tb = tb.repartition(tasks, "_tk", "_b")
    pb = probes.withColumn("_pb", bucket(F.col("_d"))).repartition(tasks, "_k", "_pb")
    cond = (pb["_k"] == tb["_tk"]) & (pb["_pb"] == tb["_b"]) & pb["_d"].between(tb["_s"], tb["_e"])
    return pb.join(tb, cond, how).drop("_b")


def first_effective(facts: DataFrame, table: DataFrame, fact_key: str, at: Column | str,
                    values: list[str], table_key: str | None = None,
                    start: str = "start_date", end: str = "end_date", seq: str = "load_seq",
                    fallback_last: bool = False, prefix: str = "",
                    max_rows: int = BROADCAST_MAX_ROWS,
                    max_intervals_per_key: int = MAX_INTERVALS_PER_KEY,
                    bucket_days: int = BUCKET_DAYS, task_rows: int = ROWS_PER_TASK) -> DataFrame:
    """Per fact row, the values of the first listed row of ``table`` whose
    ``[start, end]`` covers ``at``; NULL when none does, or, with
    ``fallback_last``, the values of the key's last listed row.

    The distinct ``(key, day)`` pairs are written to the shared folder; their
    count sets the number of tasks that resolve them, about ``task_rows``
    pairs and intervals in each.  The resolved pairs are written too; their
    exact row count then decides between a broadcast join (no shuffle of the
    facts) and a shuffle join on ``(key, day)``.
    """
    table_key = table_key or fact_key
    at_c = col(at)
    probes = (facts.select(F.col(fact_key).alias("_k"), at_c.alias("_d"))
              .where(F.col("_k").isNotNull() & F.col("_d").isNotNull()).distinct())
    probes = stage_table(probes, "effective_probes")
    t = table.select(F.col(table_key).alias("_tk"), F.col(start).alias("_s"),
                     F.col(end).alias("_e"), F.col(seq).alias("_q"),
                     F.struct(*[F.col(v) for v in values]).alias("_v")).where(F.col("_tk").isNotNull())
    sizes = _sizes(probes, t, task_rows)
    pairs = _covering(probes, t, "left" if fallback_last else "inner",
                      max_intervals_per_key, bucket_days, sizes)
    # Grouped where the join left them.  min_by skips the NULL order of a
    # probe without a covering row.
    keys = [c for c in pairs.columns if c in ("_k", "_d", "_pb")]
    resolved = pairs.groupBy(*keys).agg(F.min_by("_v", "_q").alias("_v"))
    if fallback_last:
        tasks = _tasks(*sizes[1:])
        last = t.repartition(tasks, "_tk").groupBy("_tk").agg(F.max_by("_v", "_q").alias("_last"))
        if "_pb" in keys:
            resolved = resolved.repartition(tasks, "_k")
        resolved = (resolved.join(last, resolved["_k"] == last["_tk"], "left")
                    .select("_k", "_d", F.coalesce("_v", "_last").alias("_v")))
    resolved = stage_table(resolved.select("_k", "_d", "_v"), "effective_pairs")
    # Above the bound never by the files' size: sorted keys and days make
    # files that are a small part of the pairs in memory.
    resolved = F.broadcast(resolved) if resolved.count() <= max_rows else resolved.hint("merge")
    f = facts.withColumn("_at", at_c)
    out = f.join(resolved, (f[fact_key] == resolved["_k"]) & (f["_at"] == resolved["_d"]), "left")
    return out.select(*[F.col(c) for c in facts.columns],
                      *[F.col(f"_v.{v}").alias(prefix + v) for v in values])


def price_at(lines: DataFrame, pricing: DataFrame, at: Column | str,
             product: str = "product_id", seq: str = "load_seq", **kw) -> DataFrame:
    """List price of the product on the sale day (J10): the first listed
    price row covering the day, else the product's last listed price; a
    product without price rows gets NULL."""
    return first_effective(lines, pricing, product, at, ["price"], seq=seq,
                           fallback_last=True, prefix="list_", **kw)


def promo_at(lines: DataFrame, promo: DataFrame, at: Column | str,
             product: str = "product_id", seq: str = "load_seq", **kw) -> DataFrame:
    """Promotion of the product on the sale day (J11); overlapping promos ->
    the first listed wins; none -> NULL."""
    return first_effective(lines, promo, product, at, ["promo_type", "discount_pct"],
                           seq=seq, prefix="promo_", **kw)
