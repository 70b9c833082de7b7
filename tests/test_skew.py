"""A receipt holding a third of all lines is split by AQE's skew join."""

from pyspark.sql import functions as F

from tillstar.operators import staging

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_receipt_split(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        lines = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 5000).cast("string")).alias("check_id"),
            F.col("id").cast("string").alias("product_id"), F.sha2(F.col("id").cast("string"), 256).alias("product_name"),
            (F.col("id") / 7).cast("decimal(18,4)").cast("string").alias("unit_price"),
            F.lit("").alias("discount_pct"), F.lit("").alias("discount_abs"), F.lit("").alias("discount_type"),
            F.lit("1").alias("quantity"), F.lit("1.00").alias("total_amount"))
        heads = spark.range(5000).select(
            F.col("id").cast("string").alias("check_id"), F.lit("100").alias("store_id"),
            F.lit("1").alias("cashier_id"), F.lit("01-03-2024 10:00").alias("datetime"),
            F.lit("").alias("customer_id"))
        out = staging.stage_transactions(heads, lines)
        assert len(out.collect()) == n          # runs out's own adaptive plan to its final form
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "SortMergeJoin(skew=true)" in plan or "isSkewJoin=true" in plan or "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
