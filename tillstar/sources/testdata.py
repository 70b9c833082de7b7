"""Raw-shaped feeds derived from the driver's parquet tables.

The seven raw feeds do not exist as files in the test data, so each one is
derived from the TPC-H-like tables with text formatting, blanks, negatives,
orphans and overlapping intervals placed by key arithmetic.  No row of a
table is left out: rows that should match nothing get another id, and
intervals that should cover no sale lie after the last one.  The same
derivations are written in DuckDB SQL in ``plans/oracle.py``; the two must
stay in step.  Every derivation is a projection or a small-dimension join
over whole tables, so its work grows with the data.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import OUT_DATE_FMT
from .scan import read_parquet

# Fixed values of the fixture derivation (mirrored in plans/oracle.py).
ONLINE_STORE_SLOT = 110          # o_orderkey % 120 == 110 -> store '9999'
BAD_DATETIME = "31-02-1997 10:00"
TOO_LARGE = "123456789012345678"  # 18 digits before the point; decimal(18,4) holds 14
PRICE_PERIODS = [                # (seq, start, end) of the four price rows
    (1, "01-01-1995", "30-06-1996"),
    (2, "01-07-1996", "31-12-1997"),
    (3, "01-01-1998", "30-06-1999"),
    (4, "01-07-1999", "31-12-2000"),
]
OVERLAP_PERIOD = (5, "01-06-2000", "31-12-2001")
AFTER_SALES = ("01-01-2005", "31-12-2005")
NO_MATCH = 1_000_000_000         # added to an id that should match nothing
NEW_CUSTOMER = 2_000_000_000     # added to the ids that only the later customer feed has
PROMO_ROWS = [                   # (seq, type, start, end, description)
    (1, "10", "01-01-1996", "01-01-1998", " Weekly deal "),
    (2, "11", "01-01-1997", "01-01-1999", " Clearance "),
]
STORE_FORMATS = ["hyper", "super", "to go"]
CHANGE_DATE = _dt.date(1998, 1, 1)   # day of the simulated past city change
EARLY_CHANGE = _dt.date(1980, 1, 1)  # a change before any purchase splits nothing
INIT_AS_OF = _dt.date(2002, 1, 1)    # load day of the initial customer dimension
DELTA_AS_OF = _dt.date(2024, 6, 1)   # day of the SCD2 delta run
PROMO_AS_OF = _dt.date(1997, 6, 1)   # day for the "promo active now" flag


# Tables large enough that an unsplit file would serialise the derivation.
_FACT_TABLES = {"lineitem", "orders"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, os.path.join(sf_dir, f"{name}.parquet"),
                        spread_scan=name in _FACT_TABLES)


def _s(c: Column) -> Column:
    return c.cast("string")


def raw_check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    online = (k % 120) == ONLINE_STORE_SLOT
    when = F.concat(F.date_format("o_orderdate", OUT_DATE_FMT), F.lit(" "),
                    F.lpad(_s(8 + k % 15), 2, "0"), F.lit(":"), F.lpad(_s(k % 60), 2, "0"))
    return o.select(
        F.when(k % 30 == 4, F.concat(_s(k), F.lit("  "))).otherwise(_s(k)).alias("check_id"),
        F.when(online, F.lit("9999")).otherwise(_s(k % 120)).alias("store_id"),
        F.when(online, F.lit("")).otherwise(_s(1 + k % 10)).alias("cashier_id"),
        F.when(k % 1000 == 7, F.lit(BAD_DATETIME)).otherwise(when).alias("datetime"),
        F.when(k % 5 < 2, F.lit(""))
         .when(k % 50 == 2, _s(F.col("o_custkey") + 1000000))
         .otherwise(_s(F.col("o_custkey"))).alias("customer_id"),
    )


def raw_check_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    # part is a dimension (one row per product); the planner broadcasts it
    # when its measured size allows, else shuffles on the part key.
    d = li.join(p, li.l_partkey == p.p_partkey, "inner")
    up = F.col("p_retailprice").cast("decimal(10,2)")
    q = F.col("l_quantity").cast("decimal(10,2)")
    pct = F.round(F.col("l_discount") * 100).cast("int")
    dabs = (up * q * pct * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")
    tot = _s(F.greatest(up * q - dabs, F.lit(0)).cast("decimal(18,2)"))
    n = F.col("l_linenumber")
    ok = F.col("l_orderkey")
    return d.select(
        F.when(ok % 400 == 399, _s(ok + 100000000)).otherwise(_s(ok)).alias("check_id"),
        _s(F.col("l_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when((ok % 500 == 13) & (n == 1), F.lit("12,50"))
         .otherwise(F.concat(F.lit(" "), _s(up))).alias("unit_price"),
        F.when((ok % 500 == 14) & (n == 1), F.lit("abc"))
         .when(pct == 0, F.lit("")).otherwise(_s(pct)).alias("discount_pct"),
        F.when(pct == 0, F.lit("")).otherwise(_s(dabs)).alias("discount_abs"),
        F.when(pct == 0, F.lit("")).when(n % 2 == 0, F.lit("99"))
         .otherwise(F.concat(F.lit("1"), _s(n))).alias("discount_type"),
        F.when(n == 3, F.lit("")).when(n == 4, F.lit("-1")).otherwise(_s(q)).alias("quantity"),
        F.when((ok % 500 == 15) & (n == 1), F.lit(TOO_LARGE))
         .when(n == 7, F.concat(F.lit("-"), tot)).otherwise(tot).alias("total_amount"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        _s(F.when(k % 97 == 96, k + NO_MATCH).otherwise(k)).alias("product_id"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("name"),
        F.col("p_brand").alias("unit"),
        F.col("p_type").alias("category"),
    )


def raw_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four contiguous price rows per part and a fifth, which overlaps the
    fourth for every 11th part and lies after the sales for the others.  The
    prices of parts with key % 50 == 0 belong to ids that no line has.
    ``load_seq`` is the row's position among the part's rows."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    periods = F.array(*[F.struct(F.lit(s).alias("seq"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                        for s, a, b in PRICE_PERIODS + [OVERLAP_PERIOD]])
    x = p.select(k, "p_retailprice", F.explode(periods).alias("r"))
    seq = F.col("r.seq")
    later = (seq == 5) & (k % 11 != 0)
    price = F.when(seq == 5, F.col("p_retailprice") + 55) \
             .otherwise(F.col("p_retailprice") + (seq - 1) * 10)
    active = ((seq == 4) & (k % 7 != 0)) | ((seq == 5) & ~later)
    return x.select(
        _s(F.when(k % 50 == 0, k + NO_MATCH).otherwise(k)).alias("product_id"),
        _s(price.cast("decimal(10,2)")).alias("price"),
        F.when(later, F.lit(AFTER_SALES[0])).otherwise(F.col("r.a")).alias("start_date"),
        F.when(later, F.lit(AFTER_SALES[1])).otherwise(F.col("r.b")).alias("end_date"),
        F.when(active, F.lit("1")).otherwise(F.lit("0")).alias("is_active"),
        seq.alias("load_seq"),
    )


def raw_promo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping promos for every part, after the sales but for every
    5th part; one negative percentage for every 45th."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rows = F.array(*[F.struct(F.lit(s).alias("seq"), F.lit(t).alias("t"), F.lit(a).alias("a"),
                              F.lit(b).alias("b"), F.lit(d).alias("d"))
                     for s, t, a, b, d in PROMO_ROWS])
    x = p.select(k, F.explode(rows).alias("r"))
    seq = F.col("r.seq")
    base = 10 + k % 41
    pct = F.when(seq == 1, _s(base)) \
           .when(k % 45 == 0, F.lit("-5")).otherwise(_s(base + 5))
    active = (seq == 2) & (k % 2 == 0)
    return x.select(
        F.col("r.t").alias("promo_type"),
        _s(k).alias("product_id"),
        pct.alias("discount_pct"),
        F.when(k % 5 == 0, F.col("r.a")).otherwise(F.lit(AFTER_SALES[0])).alias("start_date"),
        F.when(k % 5 == 0, F.col("r.b")).otherwise(F.lit(AFTER_SALES[1])).alias("end_date"),
        F.when(active, F.lit("1")).otherwise(F.lit("0")).alias("is_active"),
        F.col("r.d").alias("description"),
        seq.alias("load_seq"),
    )


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    x = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    k = F.col("s_suppkey")
    fmt = F.when(k % 3 == 0, F.lit(STORE_FORMATS[0])).when(k % 3 == 1, F.lit(STORE_FORMATS[1])) \
           .otherwise(F.lit(STORE_FORMATS[2]))
    return x.select(
        _s(k).alias("store_id"),
        fmt.alias("format"),
        F.concat(F.lit(" "), F.col("n_name")).alias("city"),
        F.concat(F.col("r_name"), F.lit(" region")).alias("region"),
    )


def _customer_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _customer_city(spark, sf_dir)
    k = F.col("c_custkey")
    bday = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), k.cast("int")), OUT_DATE_FMT)
    return x.select(
        _s(k).alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(k % 10 == 0, F.lit("9999")).otherwise(F.col("n_name")).alias("city"),
        F.when(k % 5 == 0, F.lit("")).otherwise(bday).alias("birthday"),
    )


def raw_customers_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer feed of a later day: all ids restaged, some with a new or
    blank city or one that differs in case only, and as many ids never seen
    before."""
    base = raw_customers(spark, sf_dir)
    k = F.col("customer_id").cast("bigint")
    again = base.withColumn(
        "city", F.when(k % 7 == 0, F.lit("NEW")).when(k % 11 == 0, F.lit(""))
                 .when(k % 17 == 0, F.lower("city")).otherwise(F.col("city")))
    fresh = base.withColumn("customer_id", _s(k + NEW_CUSTOMER))
    return again.unionByName(fresh)


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past city changes: (customer_id, change_date, old_city); for seven in
    ten customers on a day before their first purchase."""
    x = _customer_city(spark, sf_dir)
    k = F.col("c_custkey")
    return x.select(
        k.alias("customer_id"),
        F.when(k % 10 < 3, F.lit(CHANGE_DATE)).otherwise(F.lit(EARLY_CHANGE)).alias("change_date"),
        F.concat(F.lit("OLD "), F.col("n_name")).alias("old_city"),
    )


#: Derivation of each raw feed.
FEEDS = {f.__name__: f for f in (raw_stores, raw_customers, raw_products, raw_pricing, raw_promo,
                                 raw_check_summary, raw_check_details)}


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: f(spark, sf_dir) for name, f in FEEDS.items()}
