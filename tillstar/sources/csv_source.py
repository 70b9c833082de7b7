"""CSV sources and sink.

Raw feeds are UTF-8 CSV with a header row, ``"`` quoting and ``""`` as an
escaped quote.  Columns are bound to the landing table **by header name**:
a table column missing from the file becomes NULL, a file column unknown to
the table is an error.  A missing file is reported and skipped.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scan import spread
from .schemas import RAW_LENGTHS, SOURCE_FILES
from .sinks import path_exists

LOAD_SEQ = "load_seq"


def read_csv(spark: SparkSession, path: str, multiline: bool = False,
             with_load_seq: bool = False, spread_scan: bool = True) -> DataFrame:
    """Read one CSV source as all-text columns.

    ``multiline`` is needed only when quoted fields contain line breaks; it
    makes each file a single split, so it is off by default to keep large
    files splittable.  ``with_load_seq`` adds a sortable ``load_seq`` column
    that follows line order in the file, used where the first listed row
    wins (price and promo lookups).
    """
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("encoding", "UTF-8").option("quote", '"').option("escape", '"')
              .option("multiLine", multiline).option("mode", "FAILFAST"))
    df = reader.csv(path)
    if with_load_seq:
        # File order: (file, split start, position within the split).  One
        # task reads its splits in order, so the id increases along a split.
        df = df.withColumn(LOAD_SEQ, F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos")))
    # After load_seq is fixed: spreading reorders rows across tasks.
    return spread(df) if spread_scan else df


def align_to_schema(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Bind file columns to table columns by name.

    Present columns keep '' for empty fields (Spark's reader gives NULL for
    an unquoted empty field); absent columns are NULL.
    """
    file_cols = [c for c in df.columns if c not in keep]
    unknown = [c for c in file_cols if c not in columns]
    if unknown:
        raise ValueError(f"file columns not in table: {unknown}")
    out = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in file_cols
           else F.lit(None).cast("string").alias(c) for c in columns]
    return df.select(*out, *keep)


@dataclass
class LoadReport:
    """Feeds loaded (table name -> DataFrame) and feeds whose file was missing."""

    loaded: dict[str, DataFrame] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)


def load_all(spark: SparkSession, directory: str, catalog: dict[str, str] | None = None,
             ordered: tuple[str, ...] = ("raw_pricing", "raw_promo")) -> LoadReport:
    """Load every catalogued source that exists; report the missing ones (S3)."""
    catalog = catalog or SOURCE_FILES
    rep = LoadReport()
    for table, fname in catalog.items():
        path = os.path.join(directory, fname)
        if not path_exists(spark, path):
            rep.skipped.append(table)
            continue
        seq = table in ordered
        df = read_csv(spark, path, with_load_seq=seq)
        rep.loaded[table] = align_to_schema(df, list(RAW_LENGTHS[table]),
                                            keep=[LOAD_SEQ] if seq else [])
    return rep


def to_raw_format(df: DataFrame) -> DataFrame:
    """Columns as the raw files write them: dates dd-mm-yyyy, datetimes
    dd-mm-yyyy hh:mm, decimals with two places, booleans as 1/0 (T22, T29)."""
    from pyspark.sql import types as T

    from ..functions.clean import fmt2
    from ..functions.dates import fmt_dmy, fmt_dmy_hm

    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = fmt_dmy(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = fmt_dmy_hm(c)
        elif isinstance(f.dataType, T.DecimalType):
            c = fmt2(c)
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c.cast("string").alias(f.name))
    return df.select(*out)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", raw_format: bool = False) -> None:
    """Write a DataFrame as CSV with a header.

    ``raw_format`` formats dates, datetimes, decimals and flags the way the
    raw feeds carry them (``to_raw_format``).
    """
    if raw_format:
        df = to_raw_format(df)
    (df.write.mode(mode).option("header", True).option("quote", '"')
     .option("escape", '"').option("encoding", "UTF-8")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
