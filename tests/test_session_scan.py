"""Session helpers and scan spreading."""

from tillstar.session import scale_conf, shared_dir
from tillstar.sources.scan import spread


def test_scale_conf_sizes_from_input():
    small = scale_conf(1 << 30)
    assert small["spark.sql.shuffle.partitions"] == "200"           # floor
    big = scale_conf(100 << 40)                                      # 100 TB
    assert big["spark.sql.shuffle.partitions"] == "100000"          # capped
    mid = scale_conf(1 << 40)                                        # 1 TB / 128 MB
    assert mid["spark.sql.shuffle.partitions"] == str((1 << 40) // (128 << 20))
    assert mid["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == mid["spark.sql.shuffle.partitions"]


def test_spread_only_when_too_few_partitions(spark):
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(0, 1000, numPartitions=8)
    assert spread(many, 4) is many                                   # no shuffle added
    assert sorted(r.id for r in spread(one, 4).collect()) == list(range(1000))


def test_shared_dir_reads_the_session(spark):
    d = shared_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()


def test_range_count_follows_rows(spark):
    from tillstar.operators.keys import ROWS_PER_RANGE, range_count

    cap = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_count(spark, 10) == 1
    assert range_count(spark, 3 * ROWS_PER_RANGE + 1) == min(cap, 4)
    assert range_count(spark, 10**12) == cap
    assert range_count(spark, 10, num_partitions=7) == 7
