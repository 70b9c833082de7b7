"""Property tests for the distributed algorithms, and hot-key equality of
the shuffle paths with the broadcast paths."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.operators import temporal
from tillstar.operators.keys import assign_keys
from tillstar.operators.sweep import running_max_before

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 20), st.text("ab", max_size=2)), min_size=0, max_size=200),
       st.integers(1, 7), st.integers(-5, 5), st.sampled_from([0, 10**6]))
def test_assign_keys_matches_row_number(spark, rows, parts, start, single):
    df = spark.createDataFrame(rows, "a int, b string")
    got = sorted((r.k, r.a, r.b) for r in assign_keys(df, "k", ["a", "b"], start=start,
                                                      num_partitions=parts,
                                                      single_task_rows=single).collect())
    want = sorted(rows)
    assert [k for k, _, _ in got] == list(range(start, start + len(rows)))
    assert [(a, b) for _, a, b in got] == want


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3]), st.integers(0, 50),
                          st.one_of(st.none(), st.integers(0, 80)), st.integers(0, 10**6)),
                min_size=1, max_size=150, unique_by=lambda r: r[3]),
       st.integers(1, 6))
def test_running_max_matches_window(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, s int, e int, i int")
    got = running_max_before(df, "k", ["s", "e", "i"], "e", "pm", num_partitions=parts)
    w = Window.partitionBy("k").orderBy(F.col("s").asc_nulls_last(), F.col("e").asc_nulls_last(),
                                        F.col("i").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("pm", F.max("e").over(w))

    def norm(d):
        return sorted(tuple(-1 if v is None else v for v in r) for r in d.select("i", "pm").collect())
    assert norm(got) == norm(want)


def hot_lines(spark):
    """A third of the lines on one product and one customer; some without a customer."""
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        rows.append((i, 7 if hot else i % 50, 5 if hot else (None if i % 5 == 1 else i % 40),
                     dt.date(2024, 1, 1) + dt.timedelta(days=i % 90)))
    return spark.createDataFrame(rows, "line int, product_id int, customer_id bigint, d date")


def test_effective_lookup_hot_product_shuffle_equals_broadcast(spark):
    lines = hot_lines(spark)
    pricing = spark.createDataFrame(
        [(p, Decimal(p) + Decimal(s), dt.date(2024, 1, 1) + dt.timedelta(days=20 * s),
          dt.date(2024, 1, 1) + dt.timedelta(days=20 * s + 25), s) for p in range(50) for s in range(4)],
        "product_id int, price decimal(10,2), start_date date, end_date date, load_seq int")
    a = temporal.first_effective(lines, pricing, "product_id", "d", ["price"], fallback_last=True)
    b = temporal.first_effective(lines, pricing, "product_id", "d", ["price"], fallback_last=True,
                                 max_rows=0)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


def test_scd2_lookup_hot_customer_shuffle_equals_broadcast(spark):
    lines = hot_lines(spark)
    dim = spark.createDataFrame(
        [(c * 2 + 1, c, dt.date(2023, 1, 1), dt.date(2024, 1, 31)) for c in range(40)]
        + [(c * 2 + 2, c, dt.date(2024, 2, 1), dt.date(9999, 12, 31)) for c in range(40)],
        "customer_key bigint, customer_id bigint, valid_from date, valid_to date")
    a = temporal.lookup_scd2(lines, dim, "customer_id", "d", "customer_key", 0)
    b = temporal.lookup_scd2(lines, dim, "customer_id", "d", "customer_key", 0, 
                             max_rows=0)
    ra = sorted((r.line, r.customer_key) for r in a.collect())
    assert ra == sorted((r.line, r.customer_key) for r in b.collect())
    assert all(k == 0 for line, k in ra if line % 5 == 1 and line % 3 != 0)


def test_bucketed_range_join_equals_plain(spark):
    """A product holding most of the intervals: the bucketed range join gives
    the same winners as the plain one, with and without fallback."""
    import random

    rnd = random.Random(3)
    rows = []
    for q in range(1500):
        p = 7 if q % 3 else rnd.randint(0, 30)
        s = dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))
        e = s + dt.timedelta(days=rnd.choice([0, 1, 5, 40, 400]))
        rows.append((p, Decimal(q), s, e, q))
    pricing = spark.createDataFrame(rows, "product_id int, price decimal(10,2), start_date date, "
                                          "end_date date, load_seq int")
    lines = hot_lines(spark).withColumn("d", F.date_add(F.col("d"), F.col("line") % 600))
    for fallback in (True, False):
        a = temporal.first_effective(lines, pricing, "product_id", "d", ["price"], fallback_last=fallback,
                                     max_intervals_per_key=10**9)          # plain range join
        b = temporal.first_effective(lines, pricing, "product_id", "d", ["price"], fallback_last=fallback,
                                     max_intervals_per_key=0, bucket_days=17)
        ra = sorted((r.line, r.price) for r in a.collect())
        assert ra == sorted((r.line, r.price) for r in b.collect())
        assert any(p is not None for _, p in ra)
