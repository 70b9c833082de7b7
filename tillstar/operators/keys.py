"""Surrogate keys and reserved members.

``assign_keys`` numbers rows 1..N (or from ``start``) in a total order.
A table whose counted size is under a fixed bound is numbered by
``row_number()`` in one task; a larger one without moving all rows into one
task: the rows are range-partitioned on
the order (copies of one row are spread by a tie-breaker), sorted inside
each partition, checkpointed so that every later read sees the same
partitions, and then numbered as

    key = start + (rows in earlier partitions) + (position in partition).

Only the per-partition row counts (one number per partition) travel to the
driver.  ``monotonically_increasing_id`` supplies both numbers: its upper
31 bits are the partition index and its lower 33 bits the position.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import stage_table

from ..session import shared_dir

_POS_BITS = 33
# Rows per range partition when a dimension is numbered or swept in ranges.
ROWS_PER_RANGE = 1_000_000


def _order(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c).asc_nulls_last()


def range_count(spark, rows: int, num_partitions: int | None = None) -> int:
    """Range partitions for ``rows`` rows: ~``ROWS_PER_RANGE`` each, at most
    the session's shuffle width, unless given explicitly.  Keeps the
    per-partition summaries that reach the driver small even when the
    shuffle width is sized for a 100 TB fact."""
    if num_partitions:
        return num_partitions
    cap = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(cap, -(-rows // ROWS_PER_RANGE)))


def stable_ranges(df: DataFrame, order: list[Column], num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort ``df`` on ``order`` with reliable checkpoints.

    Rows equal in every ``order`` column (copies) cannot be separated by
    range bounds, so a group of copies would land in one partition.  Each
    row is therefore first tagged with a tie-breaker id, fixed by a
    checkpoint, and the range partitioning uses ``order + [tie]``; copies
    then spread over partitions like any other rows.  The second checkpoint
    fixes the partitions themselves.  Returns the rows with column ``_tie``.
    """
    shared_dir(df.sparkSession)
    tagged = df.withColumn("_tie", F.monotonically_increasing_id()).checkpoint(eager=True)
    if num_partitions is None:
        num_partitions = range_count(df.sparkSession, tagged.count())
    full = order + [F.col("_tie")]
    return tagged.repartitionByRange(num_partitions, *full).sortWithinPartitions(*full) \
                 .checkpoint(eager=True)


# At or under this many rows a dimension is numbered in one task.
SINGLE_TASK_MAX_ROWS = 1_000_000


def assign_keys(df: DataFrame, key_col: str, order_by: list, start: int = 1,
                dtype: str = "bigint", num_partitions: int | None = None,
                single_task_rows: int = SINGLE_TASK_MAX_ROWS) -> DataFrame:
    """Dense keys ``start .. start+N-1`` following ``order_by``.

    ``order_by`` should be a total order of the rows (ties only between
    identical rows), otherwise which of the tied rows gets which key is
    arbitrary.  The key column is placed first.

    The rows are counted first.  Up to ``single_task_rows`` (a bound checked
    by that count) ``row_number()`` over the order numbers them in one task:
    one sort, deterministic on recomputation.  Above it, the distributed
    numbering below runs.  Either way the result is a plan: a caller that
    reads it several times should write it once (``sinks.stage_table``).
    """
    spark = df.sparkSession
    order = [_order(c) for c in order_by]
    # Written once: counting and numbering read the table, so that the plan
    # behind ``df`` does not run for each of them.
    df = stage_table(df, "unkeyed")
    rows = df.count()
    if rows <= single_task_rows:
        rn = F.row_number().over(Window.orderBy(*order))
        key = (F.lit(start - 1) + rn).cast(dtype)
        return df.select(key.alias(key_col), *[F.col(c) for c in df.columns])
    n = range_count(spark, rows, num_partitions)
    # The numbering reads the partitions twice (counts, then keys); both
    # reads see identical partitions, even after an executor loss.
    ranged = stable_ranges(df, order, n)
    mid = F.monotonically_increasing_id()
    counts = dict(ranged.select(F.shiftright(mid, _POS_BITS).alias("p"))
                  .groupBy("p").count().collect())
    parts = max(counts) + 1 if counts else 1
    offsets = [0] + list(accumulate(counts.get(p, 0) for p in range(parts)))[:-1]
    pos = mid.bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    base = F.element_at(F.lit(offsets), (F.shiftright(mid, _POS_BITS) + 1).cast("int"))
    key = (F.lit(start) + base + pos).cast(dtype)
    return ranged.select(key.alias(key_col), *[F.col(c) for c in df.columns])


def max_key(dim: DataFrame, key_col: str) -> int:
    """Largest key in use (one scalar to the driver); 0 for an empty table."""
    v = dim.agg(F.max(key_col)).first()[0]
    return int(v) if v is not None else 0


def seed_member(df: DataFrame, row: dict) -> DataFrame:
    """Add a reserved member (Unknown -1, Guest 0) with an explicit key.

    Columns missing from ``row`` are NULL.
    """
    member = df.sparkSession.range(1).select(
        *[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.unionByName(member)


def upsert(target: DataFrame, rows: DataFrame, key: str | list[str], order: str | None = None) -> DataFrame:
    """REPLACE INTO: rows whose key is in ``rows`` are replaced (D3).

    Of several rows with one key the last in ``order``, a column of ``rows``
    that ``target`` need not have, replaces the others; without ``order``,
    or at a tie in it, the greatest row.
    """
    keys = [key] if isinstance(key, str) else key
    whole = F.struct(*[F.col(c) for c in target.columns]).alias("row")
    place = (F.col(order) if order else F.lit(0)).alias("place")
    last = rows.select(F.struct(place, whole).alias("_r"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    rows = last.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.max("_r").alias("_r")).select("_r.row.*")
    return target.join(rows.select(*keys), keys, "left_anti").unionByName(rows)
