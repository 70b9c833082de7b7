"""Reproducible sampling (U4).

The source draws 30% of the customers at random; a hash of the id makes
the draw repeatable and identical across engines and reruns: a row is in
the sample when the first 60 bits of ``md5(salt || id)``, as a number, are
below ``fraction * 2**60``.  Each row is decided on its own, so the sample
is a filter (no shuffle, no driver round trip); its size is the fraction
in expectation, not exactly; ``exact_sample`` takes exactly so many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stage_table
from .keys import assign_keys

BITS = 60


def hash_number(id_col: str, salt: str = "") -> F.Column:
    """First 15 hex digits of md5(salt || id) as a number."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), F.col(id_col).cast("string"))), 1, BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def hash_sample(df: DataFrame, id_col: str, fraction: float, salt: str = "",
                method: str = "md5") -> DataFrame:
    """Rows whose id hashes below ``fraction`` (0 to 1) of the hash range.

    A fraction of 1 keeps every row with an id, 0 none.  ``method="md5"``
    gives the same sample in any engine with md5 (used by the cross-engine
    check); ``method="xxhash"`` uses Spark's cheaper ``xxhash64`` and is
    reproducible across Spark runs only.
    """
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction must be from 0 to 1, not {fraction}")
    if method == "xxhash":
        number = F.shiftrightunsigned(F.xxhash64(F.lit(salt), F.col(id_col)), 64 - BITS)
    else:
        number = hash_number(id_col, salt)
    return df.where(F.col(id_col).isNotNull() & (number < F.lit(int(fraction * 2**BITS))))


#: Buckets of a round of ``exact_sample``.
_STEP_BITS = 12


def exact_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """The ``round(fraction * n)`` rows with the smallest hashes of ``key``, of the ``n`` whose key is not NULL (U4).

    The same rows every time, and exactly so many.  The largest hash that is
    taken is found without a sort: a histogram of 4,096 buckets over all
    hashes tells which bucket it is in, one over that bucket narrows it down
    further, at most five times; only the histograms reach the driver.  Rows
    with that very hash (copies of a key) are taken in the order of the key
    and then of their other columns.
    """
    rows = stage_table(df.where(F.col(key).isNotNull()).withColumn("_hash", hash_number(key)), "hashed")
    n = rows.count()
    wanted = int(fraction * n + 0.5)
    if wanted >= n:
        return rows.drop("_hash")
    low, bits, taken = 0, BITS, 0  # of the bucket; ``taken`` rows lie below it
    while bits and taken < wanted:
        bits = max(0, bits - _STEP_BITS)
        inside = rows.where((F.col("_hash") >= low) & (F.col("_hash") < low + (1 << (bits + _STEP_BITS))))
        counts = inside.groupBy(F.shiftright(F.col("_hash") - low, bits).alias("b")).count().orderBy("b").collect()
        for row in counts:
            if taken + row["count"] > wanted:
                low += row["b"] << bits
                break
            taken += row["count"]
            if taken == wanted:
                low += (row["b"] + 1) << bits
                break
    below = rows.where(F.col("_hash") < low)
    if taken == wanted:
        return below.drop("_hash")
    order = [F.col(key), *(F.col(c).asc_nulls_first() for c in df.columns if c != key)]
    ties = assign_keys(rows.where(F.col("_hash") == low), "_k", order).where(F.col("_k") <= wanted - taken).drop("_k")
    return below.unionByName(ties).drop("_hash")
