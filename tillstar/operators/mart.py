"""Star schema: product and store dimensions, the sales fact, mart queries.

``build_fct_sales`` (D14) translates natural keys into surrogate keys with
four LEFT lookups.  Calendar, product and store dimensions are broadcast
after a row-count check (the calendar is bounded by days in the range), so
those three lookups run in the same stage as the scan; only a customer
dimension above the broadcast bound adds a shuffle, keyed on the customer
id past which NULL ids go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from .keys import assign_keys, seed_member
from .lookups import BROADCAST_MAX_ROWS, lookup_key, sized_broadcast
from .temporal import lookup_scd2

# Reserved "Unknown" members.
UNKNOWN_PRODUCT = {"product_key": -1, "product_id": -1, "name": "Unknown"}
UNKNOWN_STORE = {"store_key": -1, "store_id": -1, "format": "Unknown", "city": "Unknown",
                 "region": "Unknown"}

PRODUCT_COLS = ["product_key", "product_id", "name", "unit_of_measure", "category",
                "current_retail_price"]
STORE_COLS = ["store_key", "store_id", "format", "city", "region"]
FACT_COLS = ["date_key", "product_key", "store_key", "customer_key", "check_id",
             "quantity", "unit_price", "total_amount", "discount_abs"]


def build_dim_products(stg_products: DataFrame) -> DataFrame:
    """Products keyed 1..N by product id, plus Unknown -1.

    Rows are kept as staged (no DISTINCT), as the source does; duplicates
    are reported by ``audit_unique``.
    """
    p = stg_products.select("product_id", "name", F.col("unit").alias("unit_of_measure"),
                            "category", "current_retail_price")
    order = [F.col(c).asc_nulls_last() for c in
             ["product_id", "name", "unit_of_measure", "category", "current_retail_price"]]
    keyed = assign_keys(p, "product_key", order, dtype="int")
    return seed_member(keyed, UNKNOWN_PRODUCT).select(*PRODUCT_COLS)


def build_dim_stores(stg_stores: DataFrame) -> DataFrame:
    """Stores (with Online 9999) keyed 1..N by store id, plus Unknown -1."""
    s = stg_stores.select("store_id", F.col("store_format").alias("format"), "city", "region")
    order = [F.col(c).asc_nulls_last() for c in ["store_id", "format", "city", "region"]]
    keyed = assign_keys(s, "store_key", order, dtype="int")
    return seed_member(keyed, UNKNOWN_STORE).select(*STORE_COLS)


def build_fct_sales(txn: DataFrame, dim_date: DataFrame, dim_products: DataFrame,
                    dim_stores: DataFrame, dim_customers: DataFrame,
                    max_rows: int = BROADCAST_MAX_ROWS,
                    customer_max_rows: int | None = None) -> DataFrame:
    """One row per receipt line with surrogate keys.

    Unknown product/store -> -1; no customer, an unknown one, or a sale
    outside every version -> Guest 0; an unparsable sale time -> NULL date.
    ``customer_max_rows`` (default ``max_rows``) bounds the customer
    dimension separately: it is the one that grows with the business.
    """
    cmax = max_rows if customer_max_rows is None else customer_max_rows
    t = txn.withColumn("_day", D.to_day("transaction_datetime"))
    t = lookup_key(t, dim_date, "_day", "full_date", "date_key", max_rows=max_rows)
    t = lookup_key(t, dim_products, "product_id", "product_id", "product_key", -1, max_rows)
    t = lookup_key(t, dim_stores, "store_id", "store_id", "store_key", -1, max_rows)
    t = lookup_scd2(t, dim_customers, "customer_id", "_day", "customer_key", 0,
                    max_rows=cmax)
    return t.select(*FACT_COLS)


def fact_layout(fct: DataFrame, clustered: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Physical layout of the fact before it is written.

    Default: each file sorted by ``date_key`` (row-group min/max let date
    filters skip row groups; no shuffle).  ``clustered``: range-partitioned
    on ``(date_key, check_id)`` first, so each file covers a narrow date
    range and date filters skip whole files.  ``check_id`` in the range key
    splits a day holding a large share of the sales over many files instead
    of one task.  Costs one shuffle of the fact at write time.
    """
    order = [F.col("date_key").asc_nulls_last(), F.col("check_id").asc_nulls_last()]
    if clustered:
        n = num_partitions or int(fct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        fct = fct.repartitionByRange(n, *order)
    return fct.sortWithinPartitions(*order)


def with_year(fct: DataFrame) -> DataFrame:
    """The fact with its ``year``, to be written in folders by it; unparsed days have none.

    Sorted so that a task writes one folder after another, each by date.
    """
    year = F.expr("cast(date_key div 10000 as int)")
    return fct.withColumn("year", year).sortWithinPartitions("year", "date_key", "check_id")


def sales_by_city_at_sale(fct: DataFrame, dim_date: DataFrame, dim_products: DataFrame,
                          dim_customers: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                          customer_max_rows: int | None = None, rows: dict[str, int] | None = None) -> DataFrame:
    """Mart query (D17): lines, quantity and revenue by year, product
    category and the customer's city *at the time of the sale*.

    Dimensions join on their unique surrogate keys.  Calendar and products
    are broadcast.  A customer dimension under the bound is broadcast too
    and one partial aggregate finishes the job; above it, the fact is
    first aggregated per (year, category, customer_key) - partial per task,
    then shuffled as aggregates - so the customer join shuffles sums, not
    sales lines.  ``rows``: rows of the dimensions by name, where they are
    known (``catalog.table_stats``); then nothing is counted.
    """
    rows = rows or {}
    dd = sized_broadcast(dim_date.select("date_key", "year"), max_rows, rows.get("dim_date"))
    dp = sized_broadcast(dim_products.select("product_key", "category"), max_rows, rows.get("dim_products"))
    dc = dim_customers.select("customer_key", "city")
    n_customers = rows["dim_customers"] if "dim_customers" in rows else dc.count()
    small = n_customers <= (max_rows if customer_max_rows is None else customer_max_rows)
    x = fct.join(dd, "date_key", "left").join(dp, "product_key", "left")
    aggs = [F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("total_qty"),
            F.sum("total_amount").alias("total_amount")]
    if small:
        y = x.join(F.broadcast(dc), "customer_key", "left").groupBy("year", "category", "city").agg(*aggs)
    else:
        pre = x.groupBy("year", "category", "customer_key").agg(*aggs)
        y = (pre.join(dc, "customer_key", "left").groupBy("year", "category", "city")
             .agg(F.sum("n_lines").alias("n_lines"), F.sum("total_qty").alias("total_qty"),
                  F.sum("total_amount").alias("total_amount")))
    return y.select("year", "category", "city", F.col("n_lines").cast("bigint").alias("n_lines"),
                    F.col("total_qty").cast("decimal(38,4)").alias("total_qty"),
                    F.col("total_amount").cast("decimal(38,4)").alias("total_amount"))
