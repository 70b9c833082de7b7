"""Table sinks: full refresh, append, versioned tables, load metrics.

Parquet tables support neither UPDATE nor MERGE and Spark refuses to
overwrite a path it is reading, so tables that change in place (the SCD2
customer dimension) are written as numbered versions: a run reads version
``v`` and writes ``v + 1``; nothing is visible until the commit of the
output is complete.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Rows per output file at most: a large or skewed write task splits its
# output into several files instead of one giant file (no shuffle).
MAX_RECORDS_PER_FILE = 20_000_000


class ContractViolation(ValueError):
    """A table that was written does not keep its contract; it has not been published."""


# --- intermediate tables ----------------------------------------------------

TABLES = "tillstar-tables"
_scope: ContextVar[TableScope | None] = ContextVar("tillstar_tables", default=None)


class TableScope:
    """Intermediate tables made within a ``with`` block, dropped when it ends.

    The block must not end before the last reader of its tables has: write
    what outlives it (``materialize``).  Scopes nest; a table belongs to the
    innermost one.  Tables are dropped after a failure too.  Threads started
    inside the block join it by ``within_scope``.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folders, self._token = spark, [], None

    def __enter__(self) -> TableScope:
        self._token = _scope.set(self)
        return self

    def __exit__(self, *failure) -> None:
        _scope.reset(self._token)
        for folder in self.folders:
            drop_table(self.spark, folder)
        for base in {os.path.dirname(f) for f in self.folders}:
            fs, path = _file_system(self.spark, base)
            # Others may have tables there: only an empty folder goes.
            if fs.exists(path) and not fs.listStatus(path):
                fs.delete(path, False)


def within_scope(f):
    """``f`` for another thread, with the tables it makes in the caller's scope."""
    scope = _scope.get()

    def run(*args):
        token = _scope.set(scope)
        try:
            return f(*args)
        finally:
            _scope.reset(token)

    return run


def drop_table(spark: SparkSession, path: str) -> None:
    """DROP TABLE IF EXISTS."""
    fs, found = _file_system(spark, path)
    fs.delete(found, True)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table as parquet under the cluster's shared
    folder (``spark.checkpoint.dir``) and read it back.

    Used for tables that later steps read several times (staged lines, the
    fact).  The write cuts the lineage: a lost executor costs a re-read of
    the table, not a recomputation of the joins that built it.  A fresh
    folder is taken per call, so concurrent runs never collide.  Within a
    ``TableScope`` the table is dropped with the scope; a query that returns
    a plan over its tables has none, and its folder goes with the application's.
    """
    from ..session import shared_dir

    folder = f"{shared_dir(df.sparkSession).rstrip('/')}/{TABLES}/{uuid.uuid4().hex}"
    if (scope := _scope.get()) is not None:
        scope.folders.append(folder)
    df.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


# --- tables -------------------------------------------------------------------


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns, in its order and types; a missing column or a type that does not fit is an error."""
    return df.to(T.StructType([T.StructField(f.name, f.dataType, True) for f in contract.fields]))


def _checks(contract: T.StructType, lengths: dict[str, int]) -> dict[str, Column]:
    """Rows that break each rule of a contract."""
    nulls = {f"{f.name} is NULL": F.col(f.name).isNull() for f in contract.fields if not f.nullable}
    return nulls | {f"{c} is longer than {n}": F.length(F.col(c)) > n for c, n in lengths.items()}


def watched(df: DataFrame, name: str, contract: T.StructType | None = None,
            lengths: dict[str, int] | None = None) -> tuple[DataFrame, Callable[[DataFrame], int]]:
    """``df`` made to conform, with its rows and what breaks the contract counted by the write itself.

    The second result, called with the written table, returns its rows or
    raises ``ContractViolation``.
    """
    if contract is not None:
        df = conform(df, contract)
    checks = _checks(contract, lengths or {}) if contract is not None else {}
    observed = Observation(f"write {name}")
    counts = [F.count(F.lit(1)).alias("rows"), *(F.count(F.when(bad, 1)).alias(what) for what, bad in checks.items())]
    df = df.observe(observed, *counts)

    def keeps(written: DataFrame) -> int:
        try:
            found = observed.get
        except Py4JJavaError:
            # Nothing is observed where the optimizer sees that there are no rows.
            found = written.agg(*counts).first().asDict()
        broken = {what: found[what] for what in checks if found[what]}
        if broken:
            raise ContractViolation(f"{name}: " + ", ".join(f"{what} in {n} rows" for what, n in broken.items()))
        return found["rows"]

    return df, keeps


@dataclass
class Prepared:
    """A table that is written and checked, and not yet in its place."""

    path: str
    written: str
    table: DataFrame
    rows: int


def prepare(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_within: list[str] | None = None,
            contract: T.StructType | None = None, lengths: dict[str, int] | None = None) -> Prepared:
    """Write a table beside its place, counting its rows and what breaks its contract on the way.

    With a ``contract``, columns and types are made to conform before the
    write, and NULLs in its NOT NULL columns and texts over ``lengths`` are
    counted by the write itself, without another pass.  If there are any,
    what was written is dropped and ``ContractViolation`` raised: the table
    in place stays as it is.
    """
    spark = df.sparkSession
    df, keeps = watched(df, path, contract, lengths)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    target = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    writer = df.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(target)
        table = spark.read.parquet(target)
        rows = keeps(table)
    except BaseException:
        drop_table(spark, target)
        raise
    return Prepared(path, target, table, rows)


def publish(spark: SparkSession, ready: Prepared) -> DataFrame:
    """Put a prepared table in its place.

    The old table is moved aside, the new one moved in, and then the old one
    dropped.  A crash in between leaves a complete table under the name of
    the old one with ``.previous`` added, which ``recover`` moves back.
    """
    recover(spark, ready.path)
    fs, place = _file_system(spark, ready.path)
    aside = _file_system(spark, f"{ready.path.rstrip('/')}.previous")[1]
    if fs.exists(place) and not fs.rename(place, aside):
        raise OSError(f"{ready.path} could not be moved aside")
    if not fs.rename(_file_system(spark, ready.written)[1], place):
        fs.rename(aside, place)
        raise OSError(f"{ready.written} could not be renamed to {ready.path}")
    fs.delete(aside, True)
    return spark.read.parquet(ready.path)


def recover(spark: SparkSession, path: str) -> None:
    """Undo what a crash within ``publish`` left: the old table goes back if there is none, else it is dropped."""
    fs, place = _file_system(spark, path)
    aside = _file_system(spark, f"{path.rstrip('/')}.previous")[1]
    if fs.exists(aside):
        if fs.exists(place):
            fs.delete(aside, True)
        else:
            fs.rename(aside, place)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None,
                sort_within: list[str] | None = None, contract: T.StructType | None = None,
                lengths: dict[str, int] | None = None) -> DataFrame:
    """DROP + CREATE TABLE AS SELECT (S4, S5, S9): write, check, put in place, read back.

    Reading the written table back cuts the lineage, so later stages do not
    recompute the plan after an executor loss.  A table that is there already
    is replaced only when the new one is complete and keeps its contract: a
    failed run leaves it.
    """
    return publish(df.sparkSession, prepare(df, path, partition_by, sort_within, contract, lengths))


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions of a table that ``df`` has rows of, and no others.

    Dynamic partition overwrite: files of other partitions are not touched,
    and a partition is replaced when the whole job commits, so a retry gives
    the same table.  A partition of which ``df`` has no rows stays.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(*by).parquet(path)


def append_batch(df: DataFrame, path: str, batch: str, column: str = "batch") -> DataFrame:
    """INSERT rows into a table as one batch, once.

    The batch's name is a partition of the table.  Inserting a batch again,
    as a retry does, replaces its own rows, so it adds nothing; batches with
    other names are appended.  Returns the table.
    """
    replace_partitions(df.withColumn(column, F.lit(batch)), path, [column])
    schema = T.StructType([*df.schema.fields, T.StructField(column, T.StringType())])
    return df.sparkSession.read.schema(schema).parquet(path)


_VERSION = re.compile(r"^v(\d+)$")


def version_path(base: str, version: int) -> str:
    """Folder of version ``version`` under ``base`` (``v000001``, ...)."""
    return os.path.join(base, f"v{version:06d}")


def _file_system(spark: SparkSession, path: str):
    """The file system that Spark resolves ``path`` to, and its path there."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system Spark resolves ``path`` to."""
    fs, found = _file_system(spark, path)
    return fs.exists(found)


def latest_version(base: str, spark: SparkSession | None = None) -> int | None:
    """Highest committed version folder (``v000001``, ...) under ``base``.

    A version counts as committed when its ``_SUCCESS`` file is there, which
    the writer leaves last, whatever the commit protocol.  With a session the
    folder is listed through Spark's file system, so it works on any that
    Spark reads (HDFS, object stores, ``file:``); without one, ``base`` must
    be a local path.
    """
    if spark is None:
        if not os.path.isdir(base):
            return None
        names = [d for d in os.listdir(base) if os.path.exists(os.path.join(base, d, "_SUCCESS"))]
    else:
        if not path_exists(spark, base):
            return None
        fs, root = _file_system(spark, base)
        found = fs.listStatus(root)
        names = [x.getPath().getName() for x in found]
        names = [d for d in names if _VERSION.match(d) and path_exists(spark, f"{base.rstrip('/')}/{d}/_SUCCESS")]
    vs = [int(m.group(1)) for d in names if (m := _VERSION.match(d))]
    return max(vs, default=None)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was written completely at ``path``."""
    recover(spark, path)
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def write_version(df: DataFrame, base: str, version: int) -> str:
    """Write ``df`` as version ``version`` under ``base``.

    Callers take ``version`` as one past the newest *committed* version, so
    the folder is either new or the leftover of an aborted attempt (a lost
    executor, a retried micro-batch); overwriting it makes the retry
    succeed.  Committed versions are never rewritten.
    """
    p = version_path(base, version)
    df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(p)
    return p


def with_metrics(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they flow through, without a second pass.

    ``obs.get["rows"]`` is available after the first action on the result.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def const_rows(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """VALUES (...) scan."""
    return spark.createDataFrame(rows, schema)
