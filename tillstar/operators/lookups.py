"""Dimension lookups (J3, J4) and the size-checked broadcast.

A dimension is broadcast only after its row count has been measured and
found under a fixed bound; dimension rows have a fixed, narrow schema, so
a row bound is a byte bound.  Above the bound the join stays a shuffle
join, which AQE may still turn into a broadcast from the measured size of
the shuffled side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension broadcast without a shuffle (rows).  A key column plus a
# natural key is ~16-40 bytes per row in the hash relation.
BROADCAST_MAX_ROWS = 2_000_000


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df``.

    ``rows``: its number of rows where that is known (``catalog.table_stats``); else they are counted.
    """
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= max_rows else df


def lookup_key(facts: DataFrame, dim: DataFrame, fact_col: str, dim_col: str,
               key_col: str, default=None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """LEFT equi lookup of a surrogate key, unmatched -> ``default``.

    Duplicate natural keys in ``dim`` repeat fact rows, as SQL does.
    """
    d = dim.select(F.col(dim_col).alias("_lk"), F.col(key_col).alias("_lv"))
    d = sized_broadcast(d, max_rows)
    out = facts.join(d, facts[fact_col] == d["_lk"], "left").drop("_lk")
    val = F.col("_lv") if default is None else F.coalesce(F.col("_lv"), F.lit(default))
    return out.withColumn(key_col, val.cast(dim.schema[key_col].dataType)).drop("_lv")
