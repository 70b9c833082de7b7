"""Catalog tables: read by name, with statistics, bucketed.

A name is a view over the newest of its numbered tables.  A new table is
written whole, checked and analysed first; replacing the view then switches
every later reader at once, so there is no moment without a table, and a
reader that has started goes on with the files it planned on.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import MAX_RECORDS_PER_FILE, drop_table, watched

_TABLE = "tillstar.table"


@dataclass(frozen=True)
class TableStats:
    """What the catalog knows about a table, without a job."""

    rows: int
    bytes: int
    buckets: int
    location: str


def bucket_count(rows: int, rows_per_bucket: int = 1_000_000) -> int:
    """Buckets for a table of that many rows: 8 at least, so that small tables are read in parallel too."""
    return max(8, -(-rows // rows_per_bucket))


def publish_table(df: DataFrame, name: str, folder: str | None = None, bucket_by: str | None = None,
                  buckets: int = 0, stats_of: list[str] | None = None, contract: T.StructType | None = None,
                  lengths: dict[str, int] | None = None) -> DataFrame:
    """CREATE OR REPLACE TABLE ``name`` AS SELECT (S5): write, check, analyse, switch the name, read by name.

    The files go to a new folder under ``folder`` (default: the cluster's
    shared one).  ``stats_of`` names columns whose statistics are taken too.
    With ``bucket_by`` the table is stored in ``buckets`` buckets of that
    column, each sorted by it, so joins on it with a table of as many
    buckets move no rows.  Rows without that column's value can match
    nothing: they are dealt over all writing tasks, not sent to one.

    A broken ``contract`` leaves the table that the name stood for.
    """
    from ..session import shared_dir

    spark = df.sparkSession
    columns = df.columns if contract is None else contract.fieldNames()
    table = f"{name}__v{(_versions(spark, name) or [0])[-1] + 1:06d}"
    path = f"{(folder or shared_dir(spark)).rstrip('/')}/tillstar-catalog/{table}-{uuid.uuid4().hex}"
    df, keeps = watched(df, name, contract, lengths)
    if bucket_by:
        rest = [F.col(c) for c in columns if c != bucket_by]
        spread = F.coalesce(F.col(bucket_by), F.xxhash64(*rest).cast(df.schema[bucket_by].dataType))
        df = df.repartition(buckets, spread)
    writer = df.write.format("parquet").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("path", path)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    try:
        writer.saveAsTable(table)
        keeps(spark.table(table))
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        drop_table(spark, path)
        raise
    of = f" FOR COLUMNS {', '.join(f'`{c}`' for c in stats_of)}" if stats_of else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{of}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_TABLE}' = '{table}') AS SELECT * FROM {table}")
    return spark.table(name)


def _split(name: str) -> tuple[str | None, str]:
    db, _, table = name.rpartition(".")
    return db or None, table


def _versions(spark: SparkSession, name: str) -> list[int]:
    """Numbers of the tables written for a name, ascending, published or not."""
    db, table = _split(name)
    kept = re.compile(re.escape(table.lower()) + r"__v(\d+)")
    found = (kept.fullmatch(t.name.lower()) for t in spark.catalog.listTables(db, f"{table}__v*"))
    return sorted(int(m.group(1)) for m in found if m)


def table_of(spark: SparkSession, name: str) -> str:
    """The table that a published name stands for."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return found.get(_TABLE, name)


def table_stats(spark: SparkSession, name: str) -> TableStats:
    """Rows, bytes and buckets of a published table, from its statistics alone.

    They hold as long as the table does: a published table is never changed.
    """
    found = _described(spark, table_of(spark, name))
    size = re.fullmatch(r"(\d+) bytes, (\d+) rows", found.get("Statistics", ""))
    if size is None:
        raise LookupError(f"{name} has no statistics; it was not written by publish_table")
    return TableStats(int(size.group(2)), int(size.group(1)), int(found.get("Num Buckets") or 0), found["Location"])


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _drop(spark: SparkSession, table: str) -> None:
    location = _described(spark, table)["Location"]
    spark.sql(f"DROP TABLE {table}")
    drop_table(spark, location)


def drop_versions(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Drop a name's older tables with their files, all but the newest ``keep``.

    The table before the current one is kept by default, for readers that
    have started.  What the name stands for is never dropped.
    """
    current, dropped = table_of(spark, name), []
    for v in _versions(spark, name)[:-keep or None]:
        table = f"{name}__v{v:06d}"
        if table.lower() == current.lower():
            continue
        _drop(spark, table)
        dropped.append(table)
    return dropped


def drop_name(spark: SparkSession, name: str) -> None:
    """Drop a published name, its tables and their files."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for v in _versions(spark, name):
        _drop(spark, f"{name}__v{v:06d}")
