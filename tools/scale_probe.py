"""Scaling probe: receipts replicated k times, the rest of the warehouse as is.

    python tools/scale_probe.py K [sf_dir]

Receipt headers and lines from ``sf_dir`` are replicated K times with
shifted receipt ids (dimensions stay 1x); staging, dimensions and the fact
are then built and written, each step timed.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    k = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    from tillstar.operators import calendar, mart, scd2, staging
    from tillstar.session import get_session
    from tillstar.sources import sinks
    from tillstar.sources import testdata as TD

    spark = get_session("tillstar-scale", master="local[8]", shuffle_partitions=32,
                        extra={"spark.driver.memory": "16g"})
    from tillstar.session import shared_dir

    base = shared_dir(spark)
    out = f"{base.rstrip('/')}/scale-{uuid.uuid4().hex}"
    feeds = TD.raw_feeds(spark, sf_dir)
    rep = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_r")

    def replicate(df):
        x = df.select("*", rep)
        cid = (F.col("check_id").cast("bigint") + F.col("_r").cast("bigint") * F.lit(1_000_000_000)).cast("string")
        return x.withColumn("check_id", cid).drop("_r")

    t: dict[str, float] = {}

    def step(name, fn):
        t0 = time.perf_counter()
        r = fn()
        t[name] = round(time.perf_counter() - t0, 3)
        return r

    step("warmup", lambda: feeds["raw_stores"].count())
    txn = step("stage_transactions", lambda: sinks.materialize(
        staging.stage_transactions(replicate(feeds["raw_check_summary"]),
                                   replicate(feeds["raw_check_details"])),
        os.path.join(out, "stg_transactions")))
    stg = staging.stage_all(feeds)
    dd = step("dim_date", lambda: sinks.materialize(calendar.build_dim_date(txn), os.path.join(out, "dd")))
    # Dimensions written like the pipeline writes them.
    dp = step("dim_products", lambda: sinks.materialize(
        mart.build_dim_products(stg["stg_products"]), os.path.join(out, "dp")))
    ds = step("dim_stores", lambda: sinks.materialize(
        mart.build_dim_stores(stg["stg_stores"]), os.path.join(out, "ds")))
    dc = step("dim_customers", lambda: sinks.materialize(scd2.build_dim_customers(
        stg["stg_customers"], txn, TD.INIT_AS_OF, TD.customer_changes(spark, sf_dir)), os.path.join(out, "dc")))
    fct = step("fct_sales", lambda: sinks.materialize(
        mart.build_fct_sales(txn, dd, dp, ds, dc), os.path.join(out, "fct"), sort_within=["date_key"]))
    step("flagship", lambda: mart.sales_by_city_at_sale(fct, dd, dp, dc)
         .write.format("noop").mode("overwrite").save())
    lines = spark.read.parquet(os.path.join(out, "fct")).count()
    t.pop("warmup")
    print(json.dumps({"k": k, "lines": lines, "total": round(sum(t.values()), 3), "steps": t}))
    spark.stop()


if __name__ == "__main__":
    main()
