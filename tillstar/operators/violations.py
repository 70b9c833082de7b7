"""The rows behind the audits (Q1-Q11): which row breaks which rule, and by what value.

Every rule is a test of one row of its table.  A table is read once: all its
tests make an array of the rules that a row breaks, and the rows with any are
exploded to ``(rule, table, row_id, value)``.  Rules that look beyond the row
(a key that occurs twice, a missing parent, an overlapping interval, another
promotion) first add a marker column to it, by a join with the reduced other
side, so that they too are tests of one row and share its pass.

``rule_counts`` counts these rows by rule; the result agrees with the counts
of ``audit``, which need no row ids and stay the cheaper way to a report.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import amounts as A
from ..functions.clean import blank_to_null
from ..sources.schemas import NOT_NULL, RAW_LENGTHS
from .audit import TYPED, typed
from .lookups import BROADCAST_MAX_ROWS, sized_broadcast
from .sweep import running_max_before
from .temporal import promo_at

#: What names a row of each table.  Raw rows have no key of their own: a row
#: may stand under the same name as another, and each is listed.
ROW_ID: dict[str, list[str]] = {
    "raw_stores": ["store_id"],
    "raw_customers": ["customer_id"],
    "raw_products": ["product_id"],
    "raw_pricing": ["product_id", "start_date", "end_date"],
    "raw_promo": ["product_id", "promo_type", "start_date", "end_date"],
    "raw_check_summary": ["check_id"],
    "raw_check_details": ["check_id", "product_id"],
    "stg_pricing": ["product_id", "start_date", "end_date"],
    "stg_promo": ["product_id", "promo_type", "start_date", "end_date"],
    "stg_transactions": ["check_id", "product_id"],
    "dim_date": ["date_key"],
    "dim_products": ["product_key"],
    "dim_stores": ["store_key"],
    "dim_customers": ["customer_key"],
    "fct_sales": ["check_id", "product_key"],
}
#: Fact columns that a star query joins on, and the dimension each points to.
REFERENCES = {"date_key": "dim_date", "product_key": "dim_products", "store_key": "dim_stores", "customer_key": "dim_customers"}
#: Raw amounts that must not be negative.
AMOUNTS = {"raw_check_details": ["unit_price", "quantity", "total_amount", "discount_abs"], "raw_promo": ["discount_pct"]}
#: Keys that must be unique: table, column, and the rows that count (SQL condition).
UNIQUE = [("dim_date", "date_key", None), ("dim_products", "product_key", None), ("dim_products", "product_id", None),
          ("dim_stores", "store_key", None), ("dim_stores", "store_id", None), ("dim_customers", "customer_key", None),
          ("dim_customers", "customer_id", "is_current AND customer_id IS NOT NULL"), ("stg_pricing", "product_id", "is_active")]


@dataclass(frozen=True)
class Rule:
    """A test of one row, true (not null) where the row is bad, and the value to show."""

    name: str
    bad: Column
    value: Column


def row_id(columns: list[str]) -> Column:
    """The columns as one text, parted by ``|``; a NULL is an empty part."""
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def bad_rows(df: DataFrame, table: str, rules: list[Rule], id_columns: list[str] | None = None) -> DataFrame:
    """``rule, table, row_id, value`` of every rule that a row breaks, in one pass without a shuffle."""
    broken = F.array(*(F.when(r.bad, F.struct(F.lit(r.name).alias("rule"), r.value.cast("string").alias("value"))) for r in rules))
    out = df.select(row_id(id_columns or ROW_ID[table]).alias("row_id"), F.inline(F.filter(broken, lambda x: x.isNotNull())))
    return out.select("rule", F.lit(table).alias("table"), "row_id", "value")


# --- rules of a row by itself ---------------------------------------------


def not_null_rules(table: str, columns: list[str]) -> list[Rule]:
    """Q2; the value is the column's name, as there is none."""
    return [Rule(f"{table}.not_null:{c}", F.col(c).isNull(), F.lit(c)) for c in columns]


def negative_rules(table: str, columns: list[str]) -> list[Rule]:
    """Q4, Q5."""
    return [Rule(f"{table}.negative:{c}", blank_to_null(c).try_cast("decimal(38,10)") < 0, F.col(c)) for c in columns]


def length_rules(table: str, columns: list[str] | None = None) -> list[Rule]:
    """Q7; the value is the whole text."""
    return [Rule(f"{table}.too_long:{c}", F.length(F.col(c)) > n, F.col(c)) for c, n in RAW_LENGTHS[table].items()
            if columns is None or c in columns]


def reject_rules(table: str) -> list[Rule]:
    """Q8."""
    return [Rule(f"{table}.rejected:{c}", blank_to_null(c).isNotNull() & e.isNull(), F.col(c)) for c, e in typed(table).items()]


def total_rule(table: str = "stg_transactions") -> Rule:
    """Q10; the value is the total as it stands."""
    expect = A.line_total("unit_price", "quantity", "discount_abs")
    return Rule(f"{table}.total_mismatch", F.abs(F.col("total_amount") - expect) > F.lit(0.01), F.col("total_amount"))


# --- rules that need a marker ---------------------------------------------


def with_repeated(df: DataFrame, table: str, max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, list[Rule]]:
    """Q1: the table with a marker for each unique key, and the rules.

    The keys that occur twice are found by a count that is added up before it
    is shuffled; they are few, and are broadcast behind a count.
    """
    rules = []
    for i, (_, key, where) in enumerate(u for u in UNIQUE if u[0] == table):
        counted = df.where(where) if where else df
        twice = counted.groupBy(key).count().where(F.col("count") > 1).select(F.col(key).alias(f"_twice{i}"), F.lit(True).alias(f"_is{i}"))
        df = df.join(sized_broadcast(twice, max_rows), F.col(key).eqNullSafe(F.col(f"_twice{i}")), "left")
        bad = F.coalesce(F.col(f"_is{i}"), F.lit(False))
        if where:
            bad = bad & F.expr(where)
        name = {"dim_customers.customer_id": "one_current", "stg_pricing.product_id": "multi_active"}.get(f"{table}.{key}", "unique")
        rules.append(Rule(f"{table}.{name}:{key}", bad, F.col(key)))
    return df, rules


def with_parents(fact: DataFrame, dims: dict[str, DataFrame], table: str = "fct_sales",
                 max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, list[Rule]]:
    """Q3: the fact with a marker for each parent found, and the rules.

    A dimension under the counted bound is broadcast.  For a larger one the
    fact's distinct keys are reduced first; the keys without a parent, which
    should be few, come back to the fact the same way.
    """
    rules = []
    for fk, dim in REFERENCES.items():
        keys = fact.select(F.col(fk).alias("k")).where("k is not null").distinct()
        lost = keys.join(sized_broadcast(dims[dim].select(F.col(fk).alias("k")).distinct(), max_rows), "k", "left_anti")
        lost = lost.select(F.col("k").alias(f"_lost_{fk}"))
        fact = fact.join(sized_broadcast(lost, max_rows), F.col(fk) == F.col(f"_lost_{fk}"), "left")
        rules.append(Rule(f"{table}.fk:{fk}", F.col(f"_lost_{fk}").isNotNull(), F.col(fk)))
    return fact, rules


def with_earlier_end(df: DataFrame, table: str) -> tuple[DataFrame, list[Rule]]:
    """Q6: the intervals with the latest end of the earlier ones of their product; the value is that end."""
    swept = running_max_before(df.where(F.col("product_id").isNotNull()), "product_id",
                               ["start_date", "end_date", "load_seq"], "end_date", "_prev_end")
    rest = df.where(F.col("product_id").isNull()).withColumn("_prev_end", F.lit(None).cast("date"))
    return swept.unionByName(rest), [Rule(f"{table}.overlap", F.col("_prev_end") >= F.col("start_date"), F.col("_prev_end"))]


def with_promo(lines: DataFrame, promo: DataFrame, table: str = "stg_transactions") -> tuple[DataFrame, list[Rule]]:
    """Q9: the lines with the promotion valid on their day; the value is type and per cent as sold."""
    lines = promo_at(lines.withColumn("_day", F.col("transaction_datetime").cast("date")), promo, "_day", seq="load_seq")
    wrong = (F.col("promo_promo_type").isNull() | (F.col("promo_promo_type") != F.col("discount_type"))
             | (F.col("promo_discount_pct") != F.col("discount_pct")))
    value = F.concat_ws("/", F.col("discount_type").cast("string"), F.col("discount_pct").cast("string"))
    return lines, [Rule(f"{table}.promo_mismatch", ~F.col("discount_type").isin(0, 99) & wrong, value)]


def orphans(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Q11: each line without a header, and each receipt id without lines, once.

    The ids that one side lacks are found on one row per id, and only lines
    under such an id are shuffled again.
    """
    head = headers.select(F.rtrim("check_id").alias("id")).distinct()
    line = lines.select(F.rtrim("check_id").alias("id")).distinct()
    alone = head.join(line, "id", "left_anti").select(
        F.lit("raw_check_summary.no_lines").alias("rule"), F.lit("raw_check_summary").alias("table"),
        F.coalesce("id", F.lit("")).alias("row_id"), F.col("id").alias("value"))
    # Null ids match nothing.
    lost = sized_broadcast(line.join(head, "id", "left_anti").select(F.col("id").alias("_lost"), F.lit(True).alias("_is_lost")))
    marked = lines.join(lost, F.rtrim("check_id").eqNullSafe(F.col("_lost")), "left")
    rule = Rule("raw_check_details.no_header", F.coalesce("_is_lost", F.lit(False)), F.rtrim("check_id"))
    return bad_rows(marked, "raw_check_details", [rule]).unionByName(alone)


# --- by layer ---------------------------------------------------------------


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def raw_rules(table: str) -> list[Rule]:
    """All rules of a raw table that look at one row (Q4, Q5, Q7, Q8)."""
    return negative_rules(table, AMOUNTS.get(table, [])) + length_rules(table) + reject_rules(table)


def raw_bad_rows(raw: dict[str, DataFrame]) -> DataFrame:
    """Q4, Q5, Q7, Q8 and Q11: each raw table is read once for its own rules, receipts once more for their ids."""
    parts = [bad_rows(raw[t], t, raw_rules(t)) for t in RAW_LENGTHS if t in raw]
    if "raw_check_summary" in raw and "raw_check_details" in raw:
        parts.append(orphans(raw["raw_check_summary"], raw["raw_check_details"]))
    return union_all(parts)


def staging_bad_rows(stg: dict[str, DataFrame]) -> DataFrame:
    """Q1 (active prices), Q6, Q9 and Q10."""
    pricing, rules = with_repeated(stg["stg_pricing"], "stg_pricing")
    pricing, more = with_earlier_end(pricing, "stg_pricing")
    promo, overlap = with_earlier_end(stg["stg_promo"], "stg_promo")
    lines, sold = with_promo(stg["stg_transactions"], stg["stg_promo"])
    return union_all([bad_rows(pricing, "stg_pricing", rules + more), bad_rows(promo, "stg_promo", overlap),
                      bad_rows(lines, "stg_transactions", [*sold, total_rule()])])


def mart_bad_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Q1, Q2 and Q3: each mart table is read once for all its rules."""
    parts = []
    for t in ("dim_date", "dim_products", "dim_stores", "dim_customers"):
        marked, rules = with_repeated(tables[t], t)
        parts.append(bad_rows(marked, t, rules + not_null_rules(t, NOT_NULL[t])))
    fact, rules = with_parents(tables["fct_sales"], tables)
    return union_all([*parts, bad_rows(fact, "fct_sales", rules + not_null_rules("fct_sales", list(REFERENCES)))])


def rule_names() -> list[str]:
    """Every rule, by layer."""
    kinds = {"dim_customers.customer_id": "one_current", "stg_pricing.product_id": "multi_active"}
    return [*(f"{t}.negative:{c}" for t, cols in AMOUNTS.items() for c in cols),
            *(f"{t}.too_long:{c}" for t, cols in RAW_LENGTHS.items() for c in cols),
            *(f"{t}.rejected:{c}" for t, kinds_ in TYPED.items() for cols in kinds_.values() for c in cols),
            "raw_check_details.no_header", "raw_check_summary.no_lines",
            "stg_pricing.overlap", "stg_promo.overlap", "stg_transactions.promo_mismatch", "stg_transactions.total_mismatch",
            *(f"{t}.{kinds.get(f'{t}.{c}', 'unique')}:{c}" for t, c, _ in UNIQUE),
            *(f"{t}.not_null:{c}" for t, cols in (NOT_NULL | {"fct_sales": list(REFERENCES)}).items() for c in cols),
            *(f"fct_sales.fk:{c}" for c in REFERENCES)]


def rule_counts(found: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """``(rule, n_bad)`` of bad rows, with the rules that nothing breaks."""
    spark = found.sparkSession
    every = spark.createDataFrame([(r,) for r in (rules or rule_names())], "rule string")
    counts = found.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    return every.join(counts, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_bad"))


def examples(found: DataFrame, per_rule: int = 20) -> DataFrame:
    """At most ``per_rule`` bad rows of each rule, for a report to people: the smallest row ids."""
    order = Window.partitionBy("rule").orderBy("row_id", "value")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_rule).drop("n")
