"""Staging builders (D15): raw text feeds -> typed, cleaned tables.

``stage_transactions`` flattens receipt headers and lines (J1) once, so
that later analysis does not repeat the join.  It is the only staging step
that shuffles fact-sized data: both sides are hash-partitioned on the raw
``check_id``; a receipt id holding a large share of the lines is split by
AQE's skew-join handling (an inner join can split either side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import dates as D
from ..sources.csv_source import LOAD_SEQ
from ..sources.schemas import STG


def _keep_seq(df: DataFrame) -> list:
    return [F.col(LOAD_SEQ)] if LOAD_SEQ in df.columns else []


def stage_stores(raw: DataFrame) -> DataFrame:
    """Typed stores plus the online store 9999."""
    typed = raw.select(
        C.to_int("store_id").alias("store_id"),
        F.trim("format").alias("store_format"),
        F.trim("city").alias("city"),
        F.trim("region").alias("region"),
    )
    online = raw.sparkSession.createDataFrame(
        [(9999, "Online", "Online", "Online")], STG["stg_stores"])
    return typed.unionByName(online)


def stage_customers(raw: DataFrame) -> DataFrame:
    """Typed customers: id, trimmed name, city with 9999 -> Online, birthday."""
    return raw.select(
        C.to_int("customer_id", "bigint").alias("customer_id"),
        F.trim("name").alias("name"),
        C.online_city("city").alias("city"),
        D.to_date_dmy("birthday").alias("birthday"),
    )


def stage_pricing(raw: DataFrame) -> DataFrame:
    """Typed price intervals: DECIMAL(10,2) price, dates, active flag; keeps load order."""
    return raw.select(
        C.to_int("product_id").alias("product_id"),
        C.to_decimal("price", 10, 2).alias("price"),
        D.to_date_dmy("start_date").alias("start_date"),
        D.to_date_dmy("end_date").alias("end_date"),
        C.to_flag("is_active").alias("is_active"),
        *_keep_seq(raw),
    )


def stage_promo(raw: DataFrame) -> DataFrame:
    """Typed promotions: percentage clamped to >= 0, dates, flag, trimmed text."""
    return raw.select(
        C.opt_int("promo_type").alias("promo_type"),
        C.to_int("product_id").alias("product_id"),
        C.nonneg_int("discount_pct").alias("discount_pct"),
        D.to_date_dmy("start_date").alias("start_date"),
        D.to_date_dmy("end_date").alias("end_date"),
        C.to_flag("is_active").alias("is_active"),
        F.trim("description").alias("description"),
        *_keep_seq(raw),
    )


def with_current_price(products: DataFrame, pricing: DataFrame) -> DataFrame:
    """Product + its active price (J2, F1).  No active price -> NULL; two
    active prices -> the product row repeats (reported by the overlap audit).
    """
    active = pricing.where(F.col("is_active")).select(
        F.col("product_id").alias("_pid"), F.col("price").alias("current_retail_price"))
    return (products.join(active, products.product_id == active._pid, "left")
            .drop("_pid"))


def stage_products(raw: DataFrame, stg_pricing: DataFrame) -> DataFrame:
    """Typed, trimmed products with their current (active) price."""
    typed = raw.select(
        C.to_int("product_id").alias("product_id"),
        F.trim("name").alias("name"),
        F.trim("unit").alias("unit"),
        F.trim("category").alias("category"),
    )
    return with_current_price(typed, stg_pricing)


def stage_transactions(raw_summary: DataFrame, raw_details: DataFrame) -> DataFrame:
    """Typed receipt lines with their header (J1 + T1-T12).

    Each side is parsed to typed columns *before* the join, so the shuffle
    carries decimals, dates and integers instead of their text; only the
    join key stays raw text, because the source matches receipts on the
    text as loaded, under a collation that ignores spaces at the end.  Parsing is row-local, so the result is the same as
    typing after the join.
    """
    h = raw_summary.select(
        F.rtrim("check_id").alias("_hid"),
        C.to_int("store_id").alias("store_id"),
        C.opt_int("cashier_id").alias("cashier_id"),
        C.opt_int("customer_id", "bigint").alias("customer_id"),
        D.to_datetime_dmy("datetime").alias("transaction_datetime"),
    )
    d = raw_details.select(
        F.rtrim("check_id").alias("_lid"),
        C.to_int("product_id").alias("product_id"),
        C.nonneg_decimal("unit_price").alias("unit_price"),
        C.nonneg_decimal("quantity").alias("quantity"),
        C.nonneg_decimal("total_amount").alias("total_amount"),
        C.nonneg_decimal("discount_abs").alias("discount_abs"),
        C.nonneg_int("discount_pct").alias("discount_pct"),
        C.int_or_zero("discount_type").alias("discount_type"),
    )
    j = d.join(h, d["_lid"] == h["_hid"], "inner")
    return j.select(
        C.to_int(F.col("_hid"), "bigint").alias("check_id"),
        "store_id", "cashier_id", "customer_id", "transaction_datetime", "product_id",
        "unit_price", "quantity", "total_amount", "discount_abs", "discount_pct", "discount_type",
    )


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All six staging tables in dependency order (pricing before products)."""
    out = {
        "stg_stores": stage_stores(raw["raw_stores"]),
        "stg_customers": stage_customers(raw["raw_customers"]),
        "stg_pricing": stage_pricing(raw["raw_pricing"]),
        "stg_promo": stage_promo(raw["raw_promo"]),
    }
    out["stg_products"] = stage_products(raw["raw_products"], out["stg_pricing"])
    out["stg_transactions"] = stage_transactions(raw["raw_check_summary"],
                                                 raw["raw_check_details"])
    return out
