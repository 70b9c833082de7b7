"""Running maximum over earlier rows of the same key, without one task per key.

A window ``PARTITION BY key`` puts every row of a key into one task; a key
holding a third of the table would then run in a single task.  Here the rows
are range-partitioned on ``(key, order...)`` instead, so a hot key is cut
into pieces across partitions:

1. range-partition + sort + reliable checkpoint (stable partitions; copies
   of one row are spread by a tie-breaker, see ``keys.stable_ranges``);
2. inside each partition, a window over ``(partition, key)`` gives the
   running maximum within the piece;
3. one aggregate per partition - first key, and last key with the maximum
   of its rows - is collected (one row per partition, a fixed bound) and
   turned into a carry: the maximum of the same key in earlier partitions;
4. the carry (at most one key per partition) is joined back by partition
   id with a broadcast of that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import stable_ranges


def running_max_before(df: DataFrame, key: str, order_cols: list[str], value: str,
                       out_col: str = "prev_max", num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = max(``value``) over rows of the same ``key`` that come
    earlier in ``order_cols`` order (NULL for the first row of a key)."""
    spark = df.sparkSession
    order = [F.col(key).asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in order_cols]
    ranged = stable_ranges(df, order, num_partitions)
    r = ranged.withColumn("_p", F.spark_partition_id())

    summary = (r.groupBy("_p").agg(
        F.min(key).alias("first_key"),
        F.max(F.struct(F.col(key).alias("k"), F.col(value).alias("v"))).alias("last"))
        .orderBy("_p").collect())
    carries = []
    run_key, run_max = None, None
    for row in summary:
        if run_key is not None and row.first_key == run_key and run_max is not None:
            carries.append((row._p, row.first_key, run_max))
        lk, lv = row["last"]["k"], row["last"]["v"]
        if lk == run_key:
            run_max = lv if run_max is None else (run_max if lv is None else max(run_max, lv))
        else:
            run_key, run_max = lk, lv

    w = (Window.partitionBy("_p", key)
         .orderBy(*[F.col(c).asc_nulls_last() for c in order_cols], F.col("_tie"))
         .rowsBetween(Window.unboundedPreceding, -1))
    local = r.withColumn("_local", F.max(value).over(w))
    if not carries:
        return local.withColumnRenamed("_local", out_col).drop("_p", "_tie")
    ktype = df.schema[key].dataType
    vtype = df.schema[value].dataType
    schema = T.StructType([T.StructField("_cp", T.IntegerType()), T.StructField("_ck", ktype),
                           T.StructField("_cv", vtype)])
    carry = F.broadcast(spark.createDataFrame(carries, schema))
    x = local.join(carry, (local["_p"] == carry["_cp"]) & (local[key] == carry["_ck"]), "left")
    return (x.withColumn(out_col, F.greatest(F.col("_local"), F.col("_cv")))
            .drop("_p", "_tie", "_local", "_cp", "_ck", "_cv"))
