"""Registered queries: one per operator group, each over the whole test tables.

Every query takes ``(spark, sf_dir)``, derives the raw feeds from the
parquet tables (``sources.testdata``) and runs the library's operators on
them.  ``plans/oracle.py`` holds the same computation in DuckDB SQL.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import amounts as A
from ..functions import clean as C
from ..functions import dates as D
from ..operators import audit as Q
from ..operators import calendar, mart, scd2, staging, temporal, violations
from ..operators.keys import upsert
from ..operators.sampling import exact_sample, hash_sample
from ..session import shared_dir
from ..sources import testdata as TD
from ..sources.catalog import bucket_count, publish_table, table_stats
from ..sources.csv_source import align_to_schema, export_csv, read_csv
from ..sources.schemas import MART, NOT_NULL, RAW_LENGTHS, SOURCE_FILES, STG
from ..sources.sinks import append_batch, const_rows, materialize, replace_partitions, stage_table
from .pipeline import RunResult, land_feeds, run_pipeline


class Lazy(dict):
    """Tables made when they are first asked for."""

    def __init__(self, makers):
        super().__init__()
        self.makers = makers

    def __missing__(self, name):
        self[name] = self.makers[name]()
        return self[name]


class Warehouse:
    """Lazily built layers of the pipeline over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, reuse_txn: bool = True):
        self.spark, self.sf_dir = spark, sf_dir
        self.reuse_txn = reuse_txn

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return Lazy({name: partial(f, self.spark, self.sf_dir) for name, f in TD.FEEDS.items()})

    @cached_property
    def stg(self) -> dict[str, DataFrame]:
        raw = self.raw
        return Lazy({
            "stg_stores": lambda: staging.stage_stores(raw["raw_stores"]),
            "stg_customers": lambda: staging.stage_customers(raw["raw_customers"]),
            "stg_pricing": lambda: staging.stage_pricing(raw["raw_pricing"]),
            "stg_promo": lambda: staging.stage_promo(raw["raw_promo"]),
            "stg_products": lambda: staging.stage_products(raw["raw_products"], self.stg["stg_pricing"]),
            "stg_transactions": lambda: staging.stage_transactions(raw["raw_check_summary"], raw["raw_check_details"]),
        })

    @cached_property
    def txn(self) -> DataFrame:
        """Staged lines.  Written once (as the source's CREATE TABLE AS does)
        when the query reads them several times - calendar, first purchases,
        fact, lookups - so the receipt join is not recomputed; a query that
        reads them once uses the plan directly."""
        if not self.reuse_txn:
            return self.stg["stg_transactions"]
        return stage_table(self.stg["stg_transactions"], "stg_transactions")

    @cached_property
    def dim_date(self) -> DataFrame:
        return stage_table(calendar.build_dim_date(self.txn), "dim_date")

    # Dimensions are tables read by several steps (lookups, counts, audits):
    # each is written once to the shared folder, as the pipeline does.
    @cached_property
    def dim_products(self) -> DataFrame:
        return stage_table(mart.build_dim_products(self.stg["stg_products"]), "dim_products")

    @cached_property
    def dim_stores(self) -> DataFrame:
        return stage_table(mart.build_dim_stores(self.stg["stg_stores"]), "dim_stores")

    @cached_property
    def changes(self) -> DataFrame:
        return TD.customer_changes(self.spark, self.sf_dir)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return stage_table(scd2.build_dim_customers(self.stg["stg_customers"], self.txn,
                                                    TD.INIT_AS_OF, self.changes), "dim_customers")

    @cached_property
    def stg_delta(self) -> DataFrame:
        return staging.stage_customers(TD.raw_customers_delta(self.spark, self.sf_dir))

    def build_dims(self) -> None:
        """Build the four dimensions as concurrent Spark jobs.

        They are independent and each is a chain of small jobs (checkpoints,
        counts); submitting them from a thread pool lets the scheduler run
        them side by side instead of one after another.
        """
        _ = self.stg["stg_products"], self.txn, self.changes          # built once, before the threads
        names = ["dim_date", "dim_products", "dim_stores", "dim_customers"]
        with ThreadPoolExecutor(len(names)) as pool:
            for f in [pool.submit(getattr, self, n) for n in names]:
                f.result()

    def mart(self) -> dict[str, DataFrame]:
        """The four dimensions."""
        self.build_dims()
        return {"dim_date": self.dim_date, "dim_products": self.dim_products,
                "dim_stores": self.dim_stores, "dim_customers": self.dim_customers}

    @cached_property
    def fct_sales(self) -> DataFrame:
        self.build_dims()
        return mart.build_fct_sales(self.txn, self.dim_date, self.dim_products,
                                    self.dim_stores, self.dim_customers)

    @cached_property
    def fct_table(self) -> DataFrame:
        """The fact written once, for jobs that read it several times."""
        return stage_table(self.fct_sales, "fct_sales")

    def lines_with_day(self) -> DataFrame:
        t = self.txn
        return t.select("check_id", "product_id", D.to_day("transaction_datetime").alias("sale_date"))


def _stg(name: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Warehouse(spark, sf_dir).stg[name].select(*STG[name].fieldNames())
    q.__name__ = name
    return q


def _csv_feeds(spark: SparkSession, sf_dir: str, names) -> str:
    """The derived raw feeds written as the source's CSV files (S8) to a new
    folder under the shared one."""
    w = Warehouse(spark, sf_dir)
    base = f"{shared_dir(spark).rstrip('/')}/tillstar-csv/{uuid.uuid4().hex}"
    with ThreadPoolExecutor(len(names)) as pool:
        list(pool.map(lambda name: export_csv(w.raw[name].select(*RAW_LENGTHS[name]),
                                              os.path.join(base, SOURCE_FILES[name])), names))
    return base


def q_warehouse_pipeline(spark, sf_dir):
    """The fact table of a whole run (D16): CSV files, landing, staging,
    dimensions, fact."""
    base = _csv_feeds(spark, sf_dir, SOURCE_FILES)
    res = run_pipeline(spark, base, f"{base}/warehouse", TD.INIT_AS_OF, TD.customer_changes(spark, sf_dir))
    return spark.read.parquet(res.tables["fct_sales"])


def q_load_report(spark, sf_dir):
    """Rows that a load wrote to each landing table."""
    base = _csv_feeds(spark, sf_dir, SOURCE_FILES)
    res = RunResult()
    land_feeds(spark, base, f"{base}/warehouse", res)
    return const_rows(spark, sorted(res.rows.items()), "feed string, n_rows long")


def q_stg_transactions_csv(spark, sf_dir):
    """Receipts through the CSV connector: the derived raw feeds are written
    as CSV files (S8) in the shared folder, read back bound by header name
    (S1, S2) and staged (J1).  Same result as staging the feeds directly."""
    base = _csv_feeds(spark, sf_dir, ("raw_check_summary", "raw_check_details"))
    feeds = {}
    for name in ("raw_check_summary", "raw_check_details"):
        path = os.path.join(base, SOURCE_FILES[name])
        feeds[name] = align_to_schema(read_csv(spark, path), list(RAW_LENGTHS[name]))
    return staging.stage_transactions(feeds["raw_check_summary"], feeds["raw_check_details"])


def q_dim_date(spark, sf_dir):
    return Warehouse(spark, sf_dir, reuse_txn=False).dim_date


def q_dim_products(spark, sf_dir):
    return Warehouse(spark, sf_dir).dim_products


def q_dim_stores(spark, sf_dir):
    return Warehouse(spark, sf_dir).dim_stores


def q_upsert_members(spark, sf_dir):
    """REPLACE INTO the store dimension: every 10th store gets a new city and
    the Unknown member is re-seeded (D3)."""
    dim = Warehouse(spark, sf_dir).dim_stores
    rows = (dim.where((F.col("store_key") % 10 == 0) | (F.col("store_key") == -1))
            .withColumn("city", F.upper(F.col("city"))))
    return upsert(dim, rows, "store_key")


def q_first_purchase(spark, sf_dir):
    return scd2.first_purchase(Warehouse(spark, sf_dir, reuse_txn=False).txn)


def q_scd2_init(spark, sf_dir):
    w = Warehouse(spark, sf_dir, reuse_txn=False)
    return scd2.scd2_init(w.stg["stg_customers"], scd2.first_purchase(w.txn),
                          TD.INIT_AS_OF)


def q_scd2_split(spark, sf_dir):
    w = Warehouse(spark, sf_dir, reuse_txn=False)
    init = scd2.scd2_init(w.stg["stg_customers"], scd2.first_purchase(w.txn),
                          TD.INIT_AS_OF)
    return scd2.scd2_split(init, w.changes)


def q_dim_customers(spark, sf_dir):
    return Warehouse(spark, sf_dir, reuse_txn=False).dim_customers


def q_hash_sample(spark, sf_dir):
    return hash_sample(Warehouse(spark, sf_dir).stg["stg_customers"], "customer_id", 0.3)


def q_hash_sample_all(spark, sf_dir):
    return hash_sample(Warehouse(spark, sf_dir).stg["stg_customers"], "customer_id", 1.0)


def q_exact_sample(spark, sf_dir):
    return exact_sample(Warehouse(spark, sf_dir).stg["stg_customers"], "customer_id", 0.3)


def _new_folder(spark, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tillstar-out/{uuid.uuid4().hex}/{name}"


def q_fact_by_year(spark, sf_dir):
    """The fact written in folders by year, with a wrong year that is then
    built again by itself (S9)."""
    fct = Warehouse(spark, sf_dir).fct_table
    path = _new_folder(spark, "fct_sales")
    spoilt = fct.withColumn("quantity", F.when(F.expr("date_key div 10000 = 1995"), F.lit(0)).otherwise(F.col("quantity")).cast("decimal(18,4)"))
    materialize(mart.with_year(spoilt), path, partition_by=["year"])
    replace_partitions(mart.with_year(fct).where("year = 1995"), path, ["year"])
    return spark.read.parquet(path).select(*MART["fct_sales"].fieldNames())


def q_append_batches(spark, sf_dir):
    """Customers inserted in three batches, the second of them twice."""
    staged = stage_table(Warehouse(spark, sf_dir).stg["stg_customers"].select(*STG["stg_customers"].fieldNames()), "stg_customers")
    path = _new_folder(spark, "customers")
    for i in (0, 1, 1, 2):
        batch = staged.where(F.coalesce(F.pmod("customer_id", F.lit(3)), F.lit(0)) == i)
        table = append_batch(batch, path, f"load{i}")
    return table


def q_contract_write(spark, sf_dir):
    """The customer dimension written under its contract: columns, types, NOT NULL."""
    w = Warehouse(spark, sf_dir, reuse_txn=False)
    return materialize(w.dim_customers, _new_folder(spark, "dim_customers"), contract=MART["dim_customers"])


def q_scd2_changed(spark, sf_dir):
    w = Warehouse(spark, sf_dir, reuse_txn=False)
    return scd2.scd2_changed(w.stg_delta, w.dim_customers)


def q_scd2_changed_ci(spark, sf_dir):
    """Changed ids under the source's collation: case alone is no change."""
    w = Warehouse(spark, sf_dir, reuse_txn=False)
    return scd2.scd2_changed(w.stg_delta, w.dim_customers, collation="UNICODE_CI_AI_RTRIM")


def q_scd2_close(spark, sf_dir):
    w = Warehouse(spark, sf_dir, reuse_txn=False)
    return scd2.scd2_close(w.dim_customers, scd2.scd2_changed(w.stg_delta, w.dim_customers),
                           TD.DELTA_AS_OF)


def q_scd2_new(spark, sf_dir):
    w = Warehouse(spark, sf_dir, reuse_txn=False)
    return scd2.scd2_new(w.stg_delta, w.dim_customers, TD.DELTA_AS_OF)


def q_scd2_apply(spark, sf_dir):
    w = Warehouse(spark, sf_dir, reuse_txn=False)
    return scd2.scd2_apply(w.dim_customers, w.stg_delta, TD.DELTA_AS_OF)


def q_scd2_apply_bucketed(spark, sf_dir):
    """The same delta as a full restage of a dimension stored in buckets."""
    w = Warehouse(spark, sf_dir, reuse_txn=False)
    name = f"dim_customers_{uuid.uuid4().hex}"
    publish_table(w.dim_customers, name, bucket_by="customer_id", buckets=bucket_count(w.dim_customers.count()),
                  contract=MART["dim_customers"])
    return scd2.scd2_apply_bucketed(name, w.stg_delta, TD.DELTA_AS_OF, max_rows=0)


def q_catalog_sales(spark, sf_dir):
    """The mart query over catalog tables, read by name, sized by their statistics."""
    w = Warehouse(spark, sf_dir)
    tables = w.mart() | {"fct_sales": w.fct_sales}
    names = {t: f"{t}_{uuid.uuid4().hex}" for t in ("fct_sales", "dim_date", "dim_products", "dim_customers")}
    for t, name in names.items():
        publish_table(tables[t], name, contract=MART[t])
    rows = {t: table_stats(spark, name).rows for t, name in names.items()}
    return mart.sales_by_city_at_sale(*(spark.table(name) for name in names.values()), rows=rows)


def q_line_checks(spark, sf_dir):
    """Days from shipment to a fixed day (T20) and the tax per discount of every line, undefined quotients as NULL."""
    lines = TD.table(spark, sf_dir, "lineitem")
    ratio = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.try_divide("l_tax", "l_discount"))
    return lines.select("l_orderkey", "l_linenumber", D.days_between(D.to_day("l_shipdate"), D.as_date(TD.PROMO_AS_OF)).alias("days"),
                        C.nan_to_null(ratio).alias("tax_ratio"))


def q_fct_sales(spark, sf_dir):
    return Warehouse(spark, sf_dir).fct_sales


def q_lookup_scd2(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    t = w.txn.select(
        "check_id", "customer_id", D.to_day("transaction_datetime").alias("sale_date"))
    return temporal.lookup_scd2(t, w.dim_customers, "customer_id", "sale_date", "customer_key", 0)


def q_price_at(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return temporal.price_at(w.lines_with_day(), w.stg["stg_pricing"], "sale_date")


def q_promo_at(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return temporal.promo_at(w.lines_with_day(), w.stg["stg_promo"], "sale_date")


def q_line_amounts(spark, sf_dir):
    t = Warehouse(spark, sf_dir, reuse_txn=False).txn
    dabs = A.discount_amount("unit_price", "quantity", "discount_pct")
    return t.select("check_id", "product_id", dabs.alias("calc_discount_abs"),
                    A.line_total("unit_price", "quantity", dabs).alias("calc_total"))


def q_active_promo(spark, sf_dir):
    p = Warehouse(spark, sf_dir).stg["stg_promo"]
    return p.select("product_id", "promo_type", "start_date", "end_date",
                    D.active_on("start_date", "end_date", TD.PROMO_AS_OF).alias("active_on_day"))


def q_fmt_dates(spark, sf_dir):
    t = Warehouse(spark, sf_dir, reuse_txn=False).txn
    return t.select("check_id", D.fmt_dmy_hm("transaction_datetime").alias("sale_text"),
                    D.fmt_dmy(D.to_day("transaction_datetime")).alias("day_text"),
                    C.fmt2("total_amount").alias("amount_text"))


# --- audits ---------------------------------------------------------------


def q_audit_unique(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return Q.unique_keys(w.mart() | {"stg_pricing": w.stg["stg_pricing"]})


def q_audit_not_null(spark, sf_dir):
    """The NOT NULL columns of the dimensions, and the fact's keys."""
    w = Warehouse(spark, sf_dir)
    declared = NOT_NULL | {"fct_sales": ["date_key", "product_key", "store_key", "customer_key"]}
    tables = w.mart() | {"fct_sales": w.fct_table}
    return Q.union_all([Q.audit_not_null(tables[name], cols, name) for name, cols in declared.items()])


def q_audit_fk(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return Q.fact_keys(w.mart() | {"fct_sales": w.fct_table})


def q_audit_negative(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return Q.union_all([
        Q.audit_negative(w.raw["raw_check_details"],
                         ["unit_price", "quantity", "total_amount", "discount_abs"],
                         "raw_check_details"),
        Q.audit_negative(w.raw["raw_promo"], ["discount_pct"], "raw_promo"),
    ])


def q_audit_overlap(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return Q.union_all([
        Q.audit_overlap(w.stg["stg_pricing"], "product_id", "start_date", "end_date", "load_seq",
                        "stg_pricing.overlap"),
        Q.audit_overlap(w.stg["stg_promo"], "product_id", "start_date", "end_date", "load_seq",
                        "stg_promo.overlap"),
    ])


def q_audit_length(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return Q.union_all([Q.audit_length(w.raw[t], RAW_LENGTHS[t], t) for t in RAW_LENGTHS])


def q_audit_rejects(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return Q.union_all([Q.audit_rejects(w.raw[t], Q.typed(t), t) for t in Q.TYPED])


def q_audit_promo(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return Q.audit_promo(w.txn, w.stg["stg_promo"])


def q_audit_total(spark, sf_dir):
    return Q.audit_total(Warehouse(spark, sf_dir, reuse_txn=False).txn)


def q_audit_orphans(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return Q.audit_orphans(w.raw["raw_check_summary"], w.raw["raw_check_details"])


# --- the rows behind the audits ---------------------------------------------


def _raw_feeds(w: Warehouse) -> dict[str, DataFrame]:
    return {t: w.raw[t] for t in RAW_LENGTHS}


def _staging(w: Warehouse) -> dict[str, DataFrame]:
    return {"stg_pricing": w.stg["stg_pricing"], "stg_promo": w.stg["stg_promo"], "stg_transactions": w.txn}


def q_bad_rows_raw(spark, sf_dir):
    """Rows of the raw feeds that break a rule (Q4, Q5, Q7, Q8, Q11)."""
    return violations.raw_bad_rows(_raw_feeds(Warehouse(spark, sf_dir)))


def q_bad_rows_staging(spark, sf_dir):
    """Staged rows that break a rule (Q1 of prices, Q6, Q9, Q10)."""
    return violations.staging_bad_rows(_staging(Warehouse(spark, sf_dir)))


def q_bad_rows_mart(spark, sf_dir):
    """Rows of the dimensions and the fact that break a rule (Q1, Q2, Q3)."""
    w = Warehouse(spark, sf_dir)
    return violations.mart_bad_rows(w.mart() | {"fct_sales": w.fct_table})


def q_bad_row_counts(spark, sf_dir):
    """All rules' counts, derived from the bad rows; equal to the audits' own."""
    w = Warehouse(spark, sf_dir)
    found = [violations.raw_bad_rows(_raw_feeds(w)), violations.staging_bad_rows(_staging(w)),
             violations.mart_bad_rows(w.mart() | {"fct_sales": w.fct_table})]
    return violations.rule_counts(violations.union_all(found))


def q_flagship_sales(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return mart.sales_by_city_at_sale(w.fct_sales, w.dim_date, w.dim_products, w.dim_customers)


QUERIES = {
    "stg_transactions": _stg("stg_transactions"),
    "stg_transactions_csv": q_stg_transactions_csv,
    "load_report": q_load_report,
    "warehouse_pipeline": q_warehouse_pipeline,
    "stg_products": _stg("stg_products"),
    "stg_stores": _stg("stg_stores"),
    "stg_customers": _stg("stg_customers"),
    "stg_pricing": _stg("stg_pricing"),
    "stg_promo": _stg("stg_promo"),
    "dim_date": q_dim_date,
    "dim_products": q_dim_products,
    "dim_stores": q_dim_stores,
    "upsert_members": q_upsert_members,
    "first_purchase": q_first_purchase,
    "scd2_init": q_scd2_init,
    "scd2_split": q_scd2_split,
    "dim_customers": q_dim_customers,
    "hash_sample": q_hash_sample,
    "hash_sample_all": q_hash_sample_all,
    "exact_sample": q_exact_sample,
    "fact_by_year": q_fact_by_year,
    "append_batches": q_append_batches,
    "contract_write": q_contract_write,
    "scd2_changed": q_scd2_changed,
    "scd2_changed_ci": q_scd2_changed_ci,
    "scd2_close": q_scd2_close,
    "scd2_new": q_scd2_new,
    "scd2_apply": q_scd2_apply,
    "scd2_apply_bucketed": q_scd2_apply_bucketed,
    "catalog_sales": q_catalog_sales,
    "line_checks": q_line_checks,
    "fct_sales": q_fct_sales,
    "lookup_scd2": q_lookup_scd2,
    "price_at": q_price_at,
    "promo_at": q_promo_at,
    "line_amounts": q_line_amounts,
    "active_promo": q_active_promo,
    "fmt_dates": q_fmt_dates,
    "audit_unique": q_audit_unique,
    "audit_not_null": q_audit_not_null,
    "audit_fk": q_audit_fk,
    "audit_negative": q_audit_negative,
    "audit_overlap": q_audit_overlap,
    "audit_length": q_audit_length,
    "audit_rejects": q_audit_rejects,
    "audit_promo": q_audit_promo,
    "audit_total": q_audit_total,
    "audit_orphans": q_audit_orphans,
    "bad_rows_raw": q_bad_rows_raw,
    "bad_rows_staging": q_bad_rows_staging,
    "bad_rows_mart": q_bad_rows_mart,
    "bad_row_counts": q_bad_row_counts,
    "flagship_sales": q_flagship_sales,
}
