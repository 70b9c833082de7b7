"""Catalog tables: publishing by name, statistics, buckets, and the delta over them."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators import mart, scd2
from tillstar.sources import catalog
from tillstar.sources.sinks import ContractViolation

AS_OF = dt.date(2024, 6, 1)
IDS = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType())])


def new_name(stem="t"):
    return f"{stem}_{uuid.uuid4().hex}"


def jobs(spark, f):
    """Jobs that ``f`` starts."""
    spark.sparkContext.setJobGroup(group := uuid.uuid4().hex, "counted")
    try:
        f()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_name_always_stands_for_a_whole_table(spark):
    name = new_name()
    first = catalog.publish_table(spark.range(10), name)
    second = catalog.publish_table(spark.range(100, 120), name)
    assert first.count() == 10, "a reader that has started keeps its table"
    assert second.count() == 20 and spark.table(name).count() == 20
    assert catalog.table_of(spark, name).endswith("__v000002")


def test_a_table_that_breaks_its_contract_leaves_the_old_one(spark):
    name = new_name()
    catalog.publish_table(spark.createDataFrame([(1, "a")], IDS), name, contract=IDS)
    broken = spark.createDataFrame([(1, "a"), (None, "b")], "id long, name string")
    with pytest.raises(ContractViolation, match="id is NULL in 1 rows"):
        catalog.publish_table(broken, name, contract=IDS)
    with pytest.raises(ContractViolation, match="longer than 3"):
        catalog.publish_table(spark.createDataFrame([(1, "abcd")], IDS), name, contract=IDS, lengths={"name": 3})
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a")]
    assert [t.name for t in spark.catalog.listTables(pattern=f"{name}__v*")] == [f"{name}__v000001"]


def test_sizes_come_from_statistics_without_a_job(spark):
    name = new_name()
    catalog.publish_table(spark.range(1234).withColumn("x", F.col("id") % 7), name, stats_of=["x"])
    found = []
    assert jobs(spark, lambda: found.append(catalog.table_stats(spark, name))) == 0
    assert found[0].rows == 1234 and found[0].bytes > 0 and found[0].buckets == 0
    column = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {catalog.table_of(spark, name)} x").collect()}
    assert column["max"] == "6" and column["num_nulls"] == "0"
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        known = spark.table(name)._jdf.queryExecution().optimizedPlan().stats().rowCount()
        assert known.get() == 1234, "Catalyst plans with the rows of the statistics"
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
    spark.range(3).createOrReplaceTempView(plain := new_name("plain"))
    with pytest.raises(Exception):  # noqa: B017 - a view of someone else has none
        catalog.table_stats(spark, plain)


def test_an_empty_table_has_statistics(spark):
    name = new_name()
    catalog.publish_table(spark.createDataFrame([], IDS), name, bucket_by="id", buckets=3)
    assert catalog.table_stats(spark, name).rows == 0 and spark.table(name).count() == 0


def test_old_versions_go_with_their_files(spark):
    name = new_name()
    for n in (1, 2, 3, 4):
        catalog.publish_table(spark.range(n), name)
    folders = [catalog.table_stats(spark, f"{name}__v{v:06d}").location.removeprefix("file:") for v in (1, 2, 3, 4)]
    assert catalog.drop_versions(spark, name) == [f"{name}__v000001", f"{name}__v000002"]
    assert [os.path.isdir(f) for f in folders] == [False, False, True, True]
    assert spark.table(name).count() == 4
    catalog.drop_name(spark, name)
    assert not any(os.path.isdir(f) for f in folders) and not spark.catalog.tableExists(name)


def dimension(spark, n=400):
    """Versions of n ids, of which every third was closed once, every 50th has none current, and some without an id."""
    d, until = dt.date(2020, 1, 1), dt.date(9999, 12, 31)
    rows = [(0, None, "Guest Customer", "Unknown", None, dt.date(1900, 1, 1), until, True)]
    for i in range(1, n + 1):
        if i % 3 == 0:
            rows.append((len(rows), i, f"n{i}", "old", None, d, dt.date(2021, 1, 1), False))
        if i % 50:
            rows.append((len(rows), i, f"n{i}", f"c{i % 9}", None, dt.date(2021, 1, 2), until, True))
    rows += [(len(rows) + k, None, f"nobody{k}", "x", None, d, until, True) for k in range(200)]
    return spark.createDataFrame(rows, "customer_key long, customer_id long, name string, city string, birthday date, "
                                       "valid_from date, valid_to date, is_current boolean")


def feed(spark, n=400):
    rows = [(i, f"n{i}", f"c{i % 9}" if i % 4 else "moved", None) for i in range(1, n + 41)]
    rows += [(None, f"stray{k}", "y", None) for k in range(150)] + [(8, "n8", "moved", None)]
    return spark.createDataFrame(rows, "customer_id long, name string, city string, birthday date")


@pytest.mark.parametrize("max_rows", [0, 1_000_000])
def test_the_delta_over_buckets_equals_the_delta(spark, max_rows):
    dim, stg, name = dimension(spark), feed(spark), new_name("dim")
    catalog.publish_table(dim, name, bucket_by="customer_id", buckets=4)
    got = scd2.scd2_apply_bucketed(name, stg, AS_OF, max_rows=max_rows)
    want = scd2.scd2_apply(dim, stg, AS_OF, max_rows=max_rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_restage_exchanges_no_row_of_the_bucketed_dimension(spark):
    name = new_name("dim")
    catalog.publish_table(dimension(spark), name, bucket_by="customer_id", buckets=4)
    table = catalog.publish_table(feed(spark).where("customer_id is not null"), new_name("feed"), bucket_by="customer_id", buckets=4)
    known = spark.table(name).where("customer_id is not null")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for joined in (scd2.scd2_close(known, table, AS_OF, max_rows=0),
                       table.join(known.select(F.col("customer_id").alias("k")), F.col("customer_id") == F.col("k"), "left_anti")):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_the_bucket_column_are_dealt_over_the_writing_tasks(spark):
    name = new_name()
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    catalog.publish_table(df, name, bucket_by="k", buckets=4)
    sizes = [r["count"] for r in spark.table(name).where("k is null").groupBy(F.input_file_name().alias("f")).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)
    assert spark.table(name).count() == 3000


def test_buckets_follow_the_rows():
    assert [catalog.bucket_count(n) for n in (0, 8_000_000, 8_000_001, 10**11)] == [8, 8, 9, 100_000]


def test_an_unbucketed_dimension_is_refused(spark):
    name = new_name("dim")
    catalog.publish_table(dimension(spark, 10), name)
    with pytest.raises(ValueError, match="not bucketed"):
        scd2.scd2_apply_bucketed(name, feed(spark, 10), AS_OF)


def test_the_mart_query_counts_no_dimension_whose_rows_are_known(spark):
    fct = spark.createDataFrame([(20200101, 1, 1, 2, 2.0, 4.0)], "date_key int, product_key int, store_key int, customer_key long, quantity double, total_amount double")
    dd = spark.createDataFrame([(20200101, 2020)], "date_key int, year int")
    dp = spark.createDataFrame([(1, "food")], "product_key int, category string")
    dc = spark.createDataFrame([(2, "Riga")], "customer_key long, city string")
    rows = {"dim_date": 1, "dim_products": 1, "dim_customers": 1}
    out = []
    assert jobs(spark, lambda: out.append(mart.sales_by_city_at_sale(fct, dd, dp, dc, rows=rows))) == 0
    assert [tuple(r)[:4] for r in out[0].collect()] == [(2020, "food", "Riga", 1)]
