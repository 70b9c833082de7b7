"""SCD2 delta driven by a Structured Streaming query over a landing folder."""

import datetime as dt
import os

from tillstar.sources.sinks import latest_version, version_path, write_version
from tillstar.streaming.scd2_stream import start_customer_stream

OPEN = dt.date(9999, 12, 31)
DIM = ("customer_key bigint, customer_id bigint, name string, city string, birthday date, "
       "valid_from date, valid_to date, is_current boolean")


def test_stream_applies_each_batch(spark, tmp_dir):
    base = os.path.join(tmp_dir, "dim_customers")
    dim = spark.createDataFrame([
        (0, None, "Guest Customer", "Unknown", None, dt.date(1900, 1, 1), OPEN, True),
        (1, 1, "a", "Lviv", None, dt.date(2024, 1, 1), OPEN, True)], DIM)
    write_version(dim, base, 1)
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "c1.csv"), "w", encoding="utf-8") as f:
        f.write("customer_id,name,city,birthday\n1,a,Kyiv,\n2,b,Odesa,01-02-1990\n")
    days = {0: dt.date(2024, 6, 1), 1: dt.date(2024, 7, 1)}
    q = start_customer_stream(spark, landing, base, os.path.join(tmp_dir, "ckpt"), days.get)
    q.awaitTermination(120)
    assert latest_version(base) == 2
    with open(os.path.join(landing, "c2.csv"), "w", encoding="utf-8") as f:
        f.write("customer_id,name,city,birthday\n1,a,Kharkiv,\n")
    q = start_customer_stream(spark, landing, base, os.path.join(tmp_dir, "ckpt"), days.get)
    q.awaitTermination(120)
    assert latest_version(base) == 3
    rows = spark.read.parquet(version_path(base, 3)).collect()
    one = sorted((r.valid_from, r.valid_to, r.city, r.is_current) for r in rows if r.customer_id == 1)
    assert one == [(dt.date(2024, 1, 1), dt.date(2024, 5, 31), "Lviv", False),
                   (dt.date(2024, 6, 1), dt.date(2024, 6, 30), "Kyiv", False),
                   (dt.date(2024, 7, 1), OPEN, "Kharkiv", True)]
    assert [r.customer_key for r in rows if r.customer_id == 2] == [3]


def test_stream_feed_without_name_column(spark, tmp_dir):
    base = os.path.join(tmp_dir, "dim_customers")
    dim = spark.createDataFrame([
        (0, None, "Guest Customer", "Unknown", None, dt.date(1900, 1, 1), OPEN, True)], DIM)
    write_version(dim, base, 1)
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "c.csv"), "w", encoding="utf-8") as f:
        f.write("customer_id,city,birthday\n10000001,9999,\n")
    q = start_customer_stream(spark, landing, base, os.path.join(tmp_dir, "ckpt"),
                              lambda b: dt.date(2024, 6, 1), columns=("customer_id", "city", "birthday"))
    q.awaitTermination(120)
    rows = [r for r in spark.read.parquet(version_path(base, 2)).collect() if r.customer_id == 10000001]
    assert [(r.name, r.city, r.customer_key) for r in rows] == [(None, "Online", 1)]
