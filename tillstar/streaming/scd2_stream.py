"""Customer feed as a stream: each micro-batch is an SCD2 delta run.

The source reruns its SCD2 script by hand whenever a new customer file is
staged.  Here a Structured Streaming query watches the landing folder; for
each micro-batch ``foreachBatch`` stages the new rows, applies them to the
newest customer dimension version and writes the next version.

Delivery is at least once: a batch retried after a failure is applied
again, which is harmless because ``scd2_apply`` with the same input on the
same ``as_of`` day changes nothing.  ``as_of`` therefore must be a function
of the batch, not of the wall clock at retry time: by default it is the day
on which the newest of the batch's files was written, which a retry sees again.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scd2 import scd2_apply
from ..operators.staging import stage_customers
from ..sources.csv_source import align_to_schema
from ..sources.schemas import RAW_LENGTHS
from ..sources.sinks import TableScope, latest_version, version_path, write_version


def scd2_batch_writer(base: str, as_of_fn: Callable[[int], _dt.date] | None = None,
                      tracked: tuple[str, ...] = ("city",),
                      collation: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function applying raw customer rows to the
    versioned dimension under ``base``.

    Without ``as_of_fn``, batches have a column ``_landed``, the time at which
    a row's file was written.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        v = latest_version(base, spark)
        if v is None:
            raise FileNotFoundError(f"no customer dimension under {base}")
        dim = spark.read.parquet(version_path(base, v))
        as_of = as_of_fn(batch_id) if as_of_fn else batch.agg(F.max("_landed")).first()[0].date()
        raw = align_to_schema(batch.drop("_landed"), list(RAW_LENGTHS["raw_customers"]))
        with TableScope(spark):
            write_version(scd2_apply(dim, stage_customers(raw), as_of, tracked, collation), base, v + 1)

    return apply


def start_customer_stream(spark: SparkSession, landing_dir: str, base: str,
                          checkpoint_location: str,
                          as_of_fn: Callable[[int], _dt.date] | None = None,
                          available_now: bool = True,
                          columns: tuple[str, ...] = ("customer_id", "name", "city", "birthday")):
    """Watch ``landing_dir`` for customer CSV files whose header is
    ``columns`` and apply each batch.  A streaming source needs its schema up
    front; the feed's own layout (e.g. without ``name``) is given here and
    each batch is bound to the table by column name, missing ones NULL."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    stream = (spark.readStream.schema(schema)
              .option("header", True).option("enforceSchema", False)
              .option("quote", '"').option("escape", '"').csv(landing_dir))
    stream = stream.select("*", F.col("_metadata.file_modification_time").alias("_landed"))
    w = (stream.writeStream.foreachBatch(scd2_batch_writer(base, as_of_fn))
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
