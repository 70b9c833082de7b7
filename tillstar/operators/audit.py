"""Data-quality audits (Q1-Q11): each returns ``(rule, n_bad)`` rows.

The source declares these rules as table constraints or documents them in
prose; here each is a table job.  Per-column rules scan the table once for
all columns.  Rules that compare a fact with a dimension first aggregate
the fact to one row per key value (partial aggregation before the
shuffle), so a hot key is counted, not shipped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import amounts as A
from ..functions import dates as D
from ..functions.clean import blank_to_null
from .lookups import BROADCAST_MAX_ROWS, sized_broadcast
from .sweep import running_max_before
from .temporal import promo_at

RULE_SCHEMA = "rule string, n_bad bigint"


def _one(df: DataFrame, rule: str, n: Column) -> DataFrame:
    return df.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("n_bad")) \
             .select(F.lit(rule).alias("rule"), "n_bad")


def _per_column(df: DataFrame, prefix: str, tests: dict[str, Column]) -> DataFrame:
    """One aggregate pass counting rows where each column's test holds."""
    sums = [F.coalesce(F.sum(F.when(t, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(c)
            for c, t in tests.items()]
    wide = df.agg(*sums)
    long = wide.unpivot([], list(tests), "column", "n_bad")
    return long.select(F.concat(F.lit(prefix), F.col("column")).alias("rule"), "n_bad")


def audit_unique(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Rows whose key value occurs more than once (Q1)."""
    g = df.groupBy(*keys).count().where(F.col("count") > 1)
    return _one(g, rule, F.sum("count"))


def audit_not_null(df: DataFrame, cols: list[str], table: str) -> DataFrame:
    """NULLs in NOT NULL columns (Q2)."""
    return _per_column(df, f"{table}.not_null:", {c: F.col(c).isNull() for c in cols})


def audit_fk(fact: DataFrame, fk: str, dim: DataFrame, pk: str, rule: str,
             max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Fact rows whose non-NULL foreign key has no dimension row (Q3).

    With the dimension's keys broadcast (after a row-count check) the anti
    join runs in the scan stage and only a count is shuffled; otherwise the
    fact is first reduced to one row per key value.
    """
    per_key = fact.where(F.col(fk).isNotNull()).groupBy(fk).count()
    keys = sized_broadcast(dim.select(F.col(pk).alias("_pk")), max_rows)
    dangling = per_key.join(keys, per_key[fk] == keys["_pk"], "left_anti")
    return _one(dangling, rule, F.sum("count"))


def audit_fks(fact: DataFrame, refs: dict[str, tuple[DataFrame, str]], table: str,
              max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``audit_fk`` of several keys in one pass over the fact (Q3).

    ``refs`` maps a fact column to ``(dimension, its key)``.  Each dimension
    whose counted keys are under the bound is broadcast, and one aggregate
    counts all of them; a larger one is audited by itself, on the fact
    reduced to one row per key.
    """
    x, tests, apart = fact.select(*refs), {}, []
    for fk, (dim, pk) in refs.items():
        keys = dim.select(F.col(pk).alias(f"_{fk}")).distinct()
        if keys.count() > max_rows:
            apart.append(audit_fk(fact, fk, dim, pk, f"{table}.fk:{fk}", 0))
            continue
        x = x.join(F.broadcast(keys), F.col(fk) == F.col(f"_{fk}"), "left")
        tests[fk] = F.col(fk).isNotNull() & F.col(f"_{fk}").isNull()
    return union_all(([_per_column(x, f"{table}.fk:", tests)] if tests else []) + apart)


def audit_negative(raw: DataFrame, cols: list[str], table: str) -> DataFrame:
    """Negative numbers in raw text columns, before staging clamps them (Q4, Q5)."""
    tests = {c: blank_to_null(c).try_cast("decimal(38,10)") < 0 for c in cols}
    return _per_column(raw, f"{table}.negative:", tests)


def audit_length(raw: DataFrame, lengths: dict[str, int], table: str) -> DataFrame:
    """Text longer than the declared column length (Q7)."""
    tests = {c: F.length(F.col(c)) > n for c, n in lengths.items() if c in raw.columns}
    return _per_column(raw, f"{table}.too_long:", tests)


#: The typed columns of each raw table, by type.
TYPED = {
    "raw_stores": {"int": ["store_id"]},
    "raw_customers": {"bigint": ["customer_id"], "date": ["birthday"]},
    "raw_products": {"int": ["product_id"]},
    "raw_pricing": {"int": ["product_id", "is_active"], "decimal(10,2)": ["price"], "date": ["start_date", "end_date"]},
    "raw_promo": {"int": ["promo_type", "product_id", "discount_pct", "is_active"], "date": ["start_date", "end_date"]},
    "raw_check_summary": {"bigint": ["check_id", "customer_id"], "int": ["store_id", "cashier_id"], "datetime": ["datetime"]},
    "raw_check_details": {"bigint": ["check_id"], "int": ["product_id", "discount_pct", "discount_type"],
                          "decimal(18,4)": ["unit_price", "quantity", "total_amount", "discount_abs"]},
}


def typed(table: str) -> dict[str, Column]:
    """A raw table's columns as typed by staging, but *before* bad text is
    defaulted to 0, so that ``audit_rejects`` sees what the default hides (Q8)."""
    special = {"date": D.to_date_dmy, "datetime": D.to_datetime_dmy}
    return {c: special[kind](c) if kind in special else blank_to_null(c).try_cast(kind)
            for kind, cols in TYPED[table].items() for c in cols}


def audit_rejects(raw: DataFrame, types: dict[str, Column], table: str) -> DataFrame:
    """Non-blank text that the lenient cast turned into NULL (Q8).

    ``types`` maps a raw column to the expression that types it.
    """
    tests = {c: blank_to_null(c).isNotNull() & e.isNull() for c, e in types.items()}
    return _per_column(raw, f"{table}.rejected:", tests)


def audit_overlap(df: DataFrame, key: str, start: str, end: str, order: str,
                  rule: str, num_partitions: int | None = None) -> DataFrame:
    """Intervals that start on or before the end of an earlier interval of
    the same key (Q6), in (start, end, order) order.

    Contained intervals are caught because the running maximum of earlier
    ends is compared, not only the previous end.  The running maximum is a
    range-partitioned sweep, so a key with many intervals is spread over
    many tasks instead of one.
    """
    x = running_max_before(df.where(F.col(key).isNotNull()).select(key, start, end, order),
                           key, [start, end, order], end, "_prev_end", num_partitions)
    return _one(x, rule, F.sum(F.when(F.col("_prev_end") >= F.col(start), 1).otherwise(0)))


def audit_promo(txn: DataFrame, promo: DataFrame, rule: str = "stg_transactions.promo_mismatch",
                seq: str = "load_seq") -> DataFrame:
    """Promo-coded lines whose discount disagrees with the promo valid that
    day, or that have no such promo (Q9).  Manual discounts (type 99) and
    lines without discount (type 0) are not checked."""
    lines = txn.where(~F.col("discount_type").isin(0, 99)).select(
        "product_id", "discount_pct", "discount_type",
        F.col("transaction_datetime").cast("date").alias("_day"))
    x = promo_at(lines, promo, "_day", seq=seq)
    bad = (F.col("promo_promo_type").isNull()
           | (F.col("promo_promo_type") != F.col("discount_type"))
           | (F.col("promo_discount_pct") != F.col("discount_pct")))
    return _one(x, rule, F.sum(F.when(bad, 1).otherwise(0)))


def audit_total(txn: DataFrame, rule: str = "stg_transactions.total_mismatch") -> DataFrame:
    """Lines where total != max(0, price * qty - discount) by more than 0.01 (Q10)."""
    expect = A.line_total("unit_price", "quantity", "discount_abs")
    bad = F.abs(F.col("total_amount") - expect) > F.lit(0.01)
    return _one(txn, rule, F.sum(F.when(bad, 1).otherwise(0)))


def unique_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Primary keys and natural keys of the mart's dimensions (Q1)."""
    keys = [("dim_date", "date_key"), ("dim_products", "product_key"), ("dim_products", "product_id"),
            ("dim_stores", "store_key"), ("dim_stores", "store_id"), ("dim_customers", "customer_key")]
    current = tables["dim_customers"].where(F.col("is_current") & F.col("customer_id").isNotNull())
    return union_all([
        *[audit_unique(tables[t], [k], f"{t}.unique:{k}") for t, k in keys],
        audit_unique(current, ["customer_id"], "dim_customers.one_current:customer_id"),
        audit_unique(tables["stg_pricing"].where(F.col("is_active")), ["product_id"], "stg_pricing.multi_active:product_id"),
    ])


def fact_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """The fact's four foreign keys (Q3)."""
    refs = {"date_key": "dim_date", "product_key": "dim_products", "store_key": "dim_stores", "customer_key": "dim_customers"}
    return audit_fks(tables["fct_sales"], {k: (tables[t], k) for k, t in refs.items()}, "fct_sales")


def audit_orphans(headers: DataFrame, lines: DataFrame, id_col: str = "check_id") -> DataFrame:
    """Receipt lines without a header and headers without lines (Q11).

    Ids are matched as ``stage_transactions`` does, past spaces at the end.
    Both sides are reduced to one row per id and meet in one outer join, so
    each input is read and shuffled once.
    """
    per_line = lines.groupBy(F.rtrim(id_col).alias("_lid")).agg(F.count(F.lit(1)).alias("_lines"))
    per_head = headers.groupBy(F.rtrim(id_col).alias("_hid")).agg(F.lit(1).alias("_head"))
    both = per_line.join(per_head, per_line["_lid"] == per_head["_hid"], "full")
    sums = both.agg(
        F.coalesce(F.sum(F.when(F.col("_head").isNull(), F.col("_lines"))), F.lit(0)).cast("bigint").alias("a"),
        F.coalesce(F.sum(F.when(F.col("_lines").isNull(), F.lit(1))), F.lit(0)).cast("bigint").alias("b"))
    rules = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(c).alias("n_bad"))
                      for rule, c in (("raw_check_details.no_header", "a"), ("raw_check_summary.no_lines", "b"))])
    return sums.select(F.inline(rules))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of rule tables."""
    return reduce(DataFrame.unionByName, frames)


def warehouse_report(tables: dict[str, DataFrame], raw: dict[str, DataFrame] | None = None) -> DataFrame:
    """All audits over a built warehouse as one ``(rule, n_bad)`` table.

    ``tables`` maps staging and mart table names to DataFrames (e.g. read
    from the folders a pipeline run wrote); ``raw`` optionally adds the
    rules that look at the raw text (negatives, lengths, rejects, orphans).
    Each rule is its own small job; the union is one result.
    """
    from ..sources.schemas import NOT_NULL, RAW_LENGTHS

    t = tables
    parts = [
        unique_keys(t),
        *[audit_not_null(t[name], cols, name) for name, cols in NOT_NULL.items() if cols and name in t],
        fact_keys(t),
        *[audit_overlap(t[name], "product_id", "start_date", "end_date",
                        "load_seq" if "load_seq" in t[name].columns else "end_date", f"{name}.overlap")
          for name in ("stg_pricing", "stg_promo")],
        audit_total(t["stg_transactions"]),
    ]
    if "load_seq" in t["stg_promo"].columns:
        parts.append(audit_promo(t["stg_transactions"], t["stg_promo"]))
    if raw:
        parts += [
            audit_negative(raw["raw_check_details"], ["unit_price", "quantity", "total_amount", "discount_abs"],
                           "raw_check_details"),
            audit_negative(raw["raw_promo"], ["discount_pct"], "raw_promo"),
            *[audit_length(raw[name], RAW_LENGTHS[name], name) for name in RAW_LENGTHS if name in raw],
            *[audit_rejects(raw[name], typed(name), name) for name in TYPED if name in raw],
            audit_orphans(raw["raw_check_summary"], raw["raw_check_details"]),
        ]
    return union_all(parts)
