"""The rows behind each audit, against planted violations and the audits' own counts."""

import datetime as dt

from pyspark.sql import functions as F

from tillstar.operators import audit, violations
from tillstar.sources.schemas import RAW_LENGTHS

from .conftest import text_df


def listed(df):
    return sorted(((r.rule, r.row_id, r.value) for r in df.collect()), key=repr)


def counts(df):
    return {r.rule: r.n_bad for r in df.collect() if r.n_bad}


def raw_tables(spark):
    rows = {
        "raw_stores": [("1", "f" * 51, "c", "r"), ("x", "f", "c", "r")],
        "raw_customers": [("1", "n", "c", "31-02-2020"), ("12345678901", "n", "c", "")],
        "raw_products": [("1", "p", "u", "c")],
        "raw_pricing": [("1", "9,5", "01-01-2020", "02-01-2020", "1")],
        "raw_promo": [("10", "1", "-5", "01-01-2020", "02-01-2020", "1", None)],
        "raw_check_summary": [("1", "1", "1", "01-01-2020 10:00", ""), ("2  ", "1", "1", "bad", "7"), ("3", "1", "1", None, ""), ("3", "1", "1", None, "")],
        "raw_check_details": [("1", "1", "p", "-1", "", "", "", "2", "-3"), ("9", "1", "p", "1", "", "", "", "1", "1"),
                              ("9 ", "2", "p", "1", "", "", "", "1", "1"), ("2", "2", "p", "1", "", "", "", "1", "1"), (None, "3", "p", "1", "", "", "", "1", "1")],
    }
    return {t: text_df(spark, list(RAW_LENGTHS[t]), r) for t, r in rows.items()}


def test_raw_rows(spark):
    raw = raw_tables(spark)
    found = violations.raw_bad_rows(raw)
    assert {(r.rule, r.row_id, r.value) for r in found.collect()} == {
        ("raw_stores.too_long:format", "1", "f" * 51), ("raw_stores.rejected:store_id", "x", "x"),
        ("raw_customers.rejected:birthday", "1", "31-02-2020"), ("raw_customers.too_long:customer_id", "12345678901", "12345678901"),
        ("raw_pricing.rejected:price", "1|01-01-2020|02-01-2020", "9,5"), ("raw_promo.negative:discount_pct", "1|10|01-01-2020|02-01-2020", "-5"),
        ("raw_check_summary.rejected:datetime", "2  ", "bad"), ("raw_check_summary.no_lines", "3", "3"),
        ("raw_check_details.negative:unit_price", "1|1", "-1"), ("raw_check_details.negative:total_amount", "1|1", "-3"),
        ("raw_check_details.no_header", "9|1", "9"), ("raw_check_details.no_header", "9 |2", "9"),
        ("raw_check_details.no_header", "|3", None)}
    own = audit.union_all([
        *[audit.audit_negative(raw[t], c, t) for t, c in violations.AMOUNTS.items()],
        *[audit.audit_length(raw[t], RAW_LENGTHS[t], t) for t in RAW_LENGTHS],
        *[audit.audit_rejects(raw[t], audit.typed(t), t) for t in audit.TYPED],
        audit.audit_orphans(raw["raw_check_summary"], raw["raw_check_details"])])
    assert counts(violations.rule_counts(found)) == counts(own)


def test_each_table_is_read_once_for_its_own_rules(spark, tmp_dir):
    t = raw_tables(spark)["raw_check_details"]
    t.write.parquet(f"{tmp_dir}/t")
    df = violations.bad_rows(spark.read.parquet(f"{tmp_dir}/t"), "raw_check_details", violations.raw_rules("raw_check_details"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan


def day(n):
    return dt.date(2020, 1, n)


def staged(spark):
    pricing = spark.createDataFrame(
        [(1, "1.00", day(1), day(9), True, 1), (1, "2.00", day(5), day(6), True, 2), (1, "2.00", day(7), day(8), False, 3),
         (None, "3.00", day(1), day(9), True, 4), (None, "3.00", day(1), day(9), True, 5), (2, "3.00", day(1), None, True, 6)],
        "product_id int, price string, start_date date, end_date date, is_active boolean, load_seq long")
    promo = spark.createDataFrame([(11, 1, 10, day(1), day(3), True, "d", 1), (12, 1, 20, day(3), day(4), True, "d", 2)],
                                  "promo_type int, product_id int, discount_pct int, start_date date, end_date date, is_active boolean, description string, load_seq long")
    at = dt.datetime(2020, 1, 3, 10)
    rows = [(1, 1, at, "2", "2", "4", "0", 10, 11), (2, 1, at, "2", "2", "4", "0", 20, 12), (3, 2, at, "2", "2", "5", None, 5, 11),
            (4, 1, None, "2", "2", "4", "0", 10, 11), (5, 1, at, None, "2", "9", "0", 0, 0), (6, 7, at, "1", "1", "1", "0", 9, 99)]
    lines = spark.createDataFrame(rows, "check_id long, product_id int, transaction_datetime timestamp_ntz, unit_price string, quantity string, "
                                        "total_amount string, discount_abs string, discount_pct int, discount_type int")
    for c in ("unit_price", "quantity", "total_amount", "discount_abs"):
        lines = lines.withColumn(c, F.col(c).cast("decimal(18,4)"))
    return {"stg_pricing": pricing, "stg_promo": promo, "stg_transactions": lines}


def test_staged_rows(spark):
    t = staged(spark)
    found = violations.staging_bad_rows(t)
    got = listed(found)
    assert [x for x in got if "stg_transactions" in x[0]] == [
        ("stg_transactions.promo_mismatch", "2|1", "12/20"), ("stg_transactions.promo_mismatch", "3|2", "11/5"),
        ("stg_transactions.promo_mismatch", "4|1", "11/10"), ("stg_transactions.total_mismatch", "3|2", "5.0000"),
        ("stg_transactions.total_mismatch", "5|1", "9.0000")]  # a missing price makes an expected total of 0
    assert [x for x in got if "overlap" in x[0]] == [
        ("stg_pricing.overlap", "1|2020-01-05|2020-01-06", "2020-01-09"), ("stg_pricing.overlap", "1|2020-01-07|2020-01-08", "2020-01-09"),
        ("stg_promo.overlap", "1|12|2020-01-03|2020-01-04", "2020-01-03")]
    # NULL keys count as equal ones, as the audit's grouping has them.
    assert sum("multi_active" in x[0] for x in got) == 4
    own = audit.union_all([
        audit.audit_unique(t["stg_pricing"].where("is_active"), ["product_id"], "stg_pricing.multi_active:product_id"),
        *[audit.audit_overlap(t[n], "product_id", "start_date", "end_date", "load_seq", f"{n}.overlap") for n in ("stg_pricing", "stg_promo")],
        audit.audit_promo(t["stg_transactions"], t["stg_promo"]), audit.audit_total(t["stg_transactions"])])
    assert counts(violations.rule_counts(found)) == counts(own)


def mart(spark):
    return {
        "dim_date": spark.sql("SELECT * FROM VALUES (20200101, DATE'2020-01-01', 3, 1, 1, 2020), (20200101, NULL, 3, 1, 1, 2020) "
                              "AS t(date_key, full_date, day_of_week_num, month_number, quarter, year)"),
        "dim_products": spark.sql("SELECT * FROM VALUES (1, 7), (2, 7), (3, NULL) AS t(product_key, product_id)"),
        "dim_stores": spark.sql("SELECT * FROM VALUES (1, 1) AS t(store_key, store_id)"),
        "dim_customers": spark.sql("SELECT * FROM VALUES (1L, 5L, DATE'2020-01-01', DATE'2020-01-02', true), (2L, 5L, DATE'2020-01-01', DATE'2020-01-02', true), "
                                   "(3L, 5L, DATE'2020-01-01', NULL, false), (4L, NULL, DATE'2020-01-01', DATE'2020-01-02', true) "
                                   "AS t(customer_key, customer_id, valid_from, valid_to, is_current)"),
        "fct_sales": spark.sql("SELECT 20200101 AS date_key, if(id = 0, 99, 1) AS product_key, 1 AS store_key, "
                               "if(id < 400, 77L, if(id = 999, NULL, 1L)) AS customer_key, id AS check_id FROM range(1000)"),
    }


def test_mart_rows_with_a_hot_lost_key(spark):
    t = mart(spark)
    found = violations.mart_bad_rows(t)
    n = counts(violations.rule_counts(found))
    assert n == {"dim_date.unique:date_key": 2, "dim_date.not_null:full_date": 1, "dim_products.unique:product_id": 2,
                 "dim_products.not_null:product_id": 1, "dim_customers.one_current:customer_id": 2, "dim_customers.not_null:valid_to": 1,
                 "fct_sales.fk:product_key": 1, "fct_sales.fk:customer_key": 400, "fct_sales.not_null:customer_key": 1}
    assert ("fct_sales.fk:product_key", "0|99", "99") in listed(found)
    assert violations.examples(found, 3).where("rule = 'fct_sales.fk:customer_key'").count() == 3


def test_markers_beyond_the_broadcast_bound(spark):
    t = mart(spark)
    want = listed(violations.mart_bad_rows(t))
    fact, rules = violations.with_parents(t["fct_sales"], t, max_rows=0)
    got = listed(violations.bad_rows(fact, "fct_sales", rules))
    assert got == [x for x in want if ".fk:" in x[0]]
    dim, rules = violations.with_repeated(t["dim_customers"], "dim_customers", max_rows=0)
    assert listed(violations.bad_rows(dim, "dim_customers", rules)) == [x for x in want if "one_current" in x[0]]


def test_empty_tables(spark):
    raw = {t: text_df(spark, list(c), []) for t, c in RAW_LENGTHS.items()}
    found = violations.raw_bad_rows(raw)
    assert found.count() == 0 and violations.rule_counts(found).count() == len(violations.rule_names()) == len(set(violations.rule_names()))
