"""Table contracts (S12): raw landing, staging and mart schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw landing tables, every column text, with the declared
# maximum lengths of the source system.
RAW_LENGTHS: dict[str, dict[str, int]] = {
    "raw_stores": {"store_id": 10, "format": 50, "city": 100, "region": 100},
    "raw_customers": {"customer_id": 10, "name": 255, "city": 100, "birthday": 20},
    "raw_products": {"product_id": 10, "name": 255, "unit": 10, "category": 100},
    "raw_pricing": {"product_id": 10, "price": 20, "start_date": 20, "end_date": 20,
                    "is_active": 5},
    "raw_promo": {"promo_type": 10, "product_id": 10, "discount_pct": 10,
                  "start_date": 20, "end_date": 20, "is_active": 5, "description": 255},
    "raw_check_summary": {"check_id": 20, "store_id": 10, "cashier_id": 10,
                          "datetime": 30, "customer_id": 10},
    "raw_check_details": {"check_id": 20, "product_id": 10, "product_name": 255,
                          "unit_price": 20, "discount_pct": 20, "discount_abs": 20,
                          "discount_type": 10, "quantity": 20, "total_amount": 20},
}

# Source name -> CSV file name.
SOURCE_FILES: dict[str, str] = {
    "raw_stores": "stores.csv",
    "raw_customers": "customers.csv",
    "raw_products": "products.csv",
    "raw_pricing": "pricing.csv",
    "raw_promo": "promo.csv",
    "raw_check_summary": "check_summary.csv",
    "raw_check_details": "check_details.csv",
}


def raw_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_LENGTHS[name]])


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


INT, BIG, STR, DATE, BOOL = T.IntegerType(), T.LongType(), T.StringType(), T.DateType(), T.BooleanType()
PRICE = T.DecimalType(10, 2)
MEASURE = T.DecimalType(18, 4)

STG: dict[str, T.StructType] = {
    "stg_stores": _s(("store_id", INT, True), ("store_format", STR, True),
                     ("city", STR, True), ("region", STR, True)),
    "stg_customers": _s(("customer_id", BIG, True), ("name", STR, True),
                        ("city", STR, True), ("birthday", DATE, True)),
    "stg_pricing": _s(("product_id", INT, True), ("price", PRICE, True),
                      ("start_date", DATE, True), ("end_date", DATE, True),
                      ("is_active", BOOL, True)),
    "stg_promo": _s(("promo_type", INT, True), ("product_id", INT, True),
                    ("discount_pct", INT, True), ("start_date", DATE, True),
                    ("end_date", DATE, True), ("is_active", BOOL, True),
                    ("description", STR, True)),
    "stg_products": _s(("product_id", INT, True), ("name", STR, True), ("unit", STR, True),
                       ("category", STR, True), ("current_retail_price", PRICE, True)),
    "stg_transactions": _s(("check_id", BIG, True), ("store_id", INT, True),
                           ("cashier_id", INT, True), ("customer_id", BIG, True),
                           ("transaction_datetime", T.TimestampNTZType(), True),
                           ("product_id", INT, True), ("unit_price", MEASURE, True),
                           ("quantity", MEASURE, True), ("total_amount", MEASURE, True),
                           ("discount_abs", MEASURE, True), ("discount_pct", INT, True),
                           ("discount_type", INT, True)),
}

MART: dict[str, T.StructType] = {
    "dim_date": _s(("date_key", INT, False), ("full_date", DATE, False),
                   ("day_of_week_num", INT, False), ("day_of_week_name", STR, True),
                   ("month_number", INT, False), ("month_name", STR, True),
                   ("quarter", INT, False), ("year", INT, False)),
    "dim_products": _s(("product_key", INT, False), ("product_id", INT, False),
                       ("name", STR, True), ("unit_of_measure", STR, True),
                       ("category", STR, True), ("current_retail_price", PRICE, True)),
    "dim_stores": _s(("store_key", INT, False), ("store_id", INT, False),
                     ("format", STR, True), ("city", STR, True), ("region", STR, True)),
    "dim_customers": _s(("customer_key", BIG, False), ("customer_id", BIG, True),
                        ("name", STR, True), ("city", STR, True), ("birthday", DATE, True),
                        ("valid_from", DATE, False), ("valid_to", DATE, False),
                        ("is_current", BOOL, False)),
    "fct_sales": _s(("date_key", INT, True), ("product_key", INT, True),
                    ("store_key", INT, True), ("customer_key", BIG, True),
                    ("check_id", BIG, True), ("quantity", MEASURE, True),
                    ("unit_price", MEASURE, True), ("total_amount", MEASURE, True),
                    ("discount_abs", MEASURE, True)),
}

# Columns declared NOT NULL (audited by audit_not_null rather than enforced).
NOT_NULL: dict[str, list[str]] = {
    name: [f.name for f in schema.fields if not f.nullable] for name, schema in MART.items()
}
