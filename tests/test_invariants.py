"""Warehouse invariants on the sf0.001 test data."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.operators import scd2
from tillstar.plans.queries import Warehouse
from tillstar.sources import testdata as TD

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(spark, SF)


def test_versions_do_not_overlap_and_one_current(wh):
    d = wh.dim_customers.where(F.col("customer_id").isNotNull())
    w = Window.partitionBy("customer_id").orderBy("valid_from", "valid_to")
    x = d.withColumn("prev_to", F.lag("valid_to").over(w))
    assert x.where(F.col("prev_to") >= F.col("valid_from")).count() == 0
    cur = d.groupBy("customer_id").agg(F.sum(F.col("is_current").cast("int")).alias("n"))
    assert cur.where("n <> 1").count() == 0


def test_reserved_members_once(wh):
    assert wh.dim_customers.where("customer_key = 0").count() == 1
    assert wh.dim_products.where("product_key = -1").count() == 1
    assert wh.dim_stores.where("store_key = -1").count() == 1
    assert wh.dim_stores.where("store_id = 9999").count() == 1


def test_keys_dense(wh):
    for dim, key in [(wh.dim_customers, "customer_key"), (wh.dim_products, "product_key"),
                     (wh.dim_stores, "store_key")]:
        r = dim.where(F.col(key) > 0).agg(F.min(key), F.max(key), F.count(F.lit(1)),
                                          F.countDistinct(key)).first()
        assert r[0] == 1 and r[1] == r[2] == r[3]


def test_calendar_covers_sales(wh):
    b = wh.txn.agg(F.min(F.to_date("transaction_datetime")).alias("lo"),
                   F.max(F.to_date("transaction_datetime")).alias("hi")).first()
    assert wh.dim_date.count() == (b.hi - b.lo).days + 1


def test_fact_rows_equal_staged_rows_when_keys_unique(wh):
    prods = wh.dim_products.groupBy("product_id").count().where("count = 1").select("product_id")
    txn = wh.txn.join(prods, "product_id", "left_semi")
    from tillstar.operators import mart
    f = mart.build_fct_sales(txn, wh.dim_date, wh.dim_products, wh.dim_stores, wh.dim_customers)
    assert f.count() == txn.count()


def test_scd2_apply_twice_is_noop(spark, wh):
    once = scd2.scd2_apply(wh.dim_customers, wh.stg_delta, TD.DELTA_AS_OF)
    twice = scd2.scd2_apply(once, wh.stg_delta, TD.DELTA_AS_OF)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
