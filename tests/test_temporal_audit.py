"""Effective-dated lookups (J5, J10, J11), the fact build (D14) and audits (Q)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import text_df
from tillstar.operators import audit as Q
from tillstar.operators import temporal
from tillstar.operators.mart import build_fct_sales

OPEN = dt.date(9999, 12, 31)
DIM = ("customer_key bigint, customer_id bigint, name string, city string, birthday date, "
       "valid_from date, valid_to date, is_current boolean")


def customers(spark):
    return spark.createDataFrame([
        (0, None, "Guest Customer", "Unknown", None, dt.date(1900, 1, 1), OPEN, True),
        (1, 10, "a", "Old", None, dt.date(2024, 1, 1), dt.date(2024, 3, 31), False),
        (2, 10, "a", "New", None, dt.date(2024, 4, 1), OPEN, True),
    ], DIM)


def sales(spark):
    return spark.createDataFrame([
        (1, 10, dt.datetime(2024, 3, 31, 10, 0)),   # valid_to day at 10:00 -> old version
        (2, 10, dt.datetime(2024, 4, 1, 8, 0)),     # valid_from day -> new version
        (3, 10, dt.datetime(2023, 12, 31, 9, 0)),   # before the first version -> guest
        (4, None, dt.datetime(2024, 5, 1, 9, 0)),   # no customer -> guest
        (5, 99, dt.datetime(2024, 5, 1, 9, 0)),     # unknown customer -> guest
    ], "check_id bigint, customer_id bigint, transaction_datetime timestamp_ntz")


def test_point_in_time_lookup(spark):
    s = sales(spark).withColumn("d", F.col("transaction_datetime").cast("date"))
    for max_rows in (10, 0):   # broadcast, then shuffle join
        out = temporal.lookup_scd2(s, customers(spark), "customer_id", "d", "customer_key", 0,
                                   max_rows=max_rows)
        got = dict((r.check_id, r.customer_key) for r in out.collect())
        assert got == {1: 1, 2: 2, 3: 0, 4: 0, 5: 0}


def test_price_at_first_listed_and_fallback(spark):
    pricing = spark.createDataFrame([
        (1, Decimal("1.00"), dt.date(2024, 1, 1), dt.date(2024, 1, 31), 1),
        (1, Decimal("2.00"), dt.date(2024, 1, 15), dt.date(2024, 2, 29), 2),   # overlaps: first listed wins
        (1, Decimal("3.00"), dt.date(2024, 3, 1), dt.date(2024, 3, 31), 3),
    ], "product_id int, price decimal(10,2), start_date date, end_date date, load_seq int")
    lines = spark.createDataFrame([
        (1, 1, dt.date(2024, 1, 20)), (2, 1, dt.date(2024, 2, 10)), (3, 1, dt.date(2024, 6, 1)),
        (4, 2, dt.date(2024, 1, 20)), (5, 1, None)],
        "line int, product_id int, d date")
    got = {r.line: r.list_price for r in temporal.price_at(lines, pricing, "d").collect()}
    assert got == {1: Decimal("1.00"), 2: Decimal("2.00"), 3: Decimal("3.00"), 4: None, 5: None}


def test_promo_at_first_loaded(spark):
    promo = spark.createDataFrame([
        (10, 1, 20, dt.date(2024, 1, 1), dt.date(2024, 1, 31), 2),
        (11, 1, 30, dt.date(2024, 1, 10), dt.date(2024, 2, 10), 1),
    ], "promo_type int, product_id int, discount_pct int, start_date date, end_date date, load_seq int")
    lines = spark.createDataFrame([(1, 1, dt.date(2024, 1, 5)), (2, 1, dt.date(2024, 1, 15)),
                                   (3, 1, dt.date(2024, 3, 1))], "line int, product_id int, d date")
    got = {r.line: (r.promo_promo_type, r.promo_discount_pct)
           for r in temporal.promo_at(lines, promo, "d").collect()}
    assert got == {1: (10, 20), 2: (11, 30), 3: (None, None)}


@pytest.mark.parametrize("per_key", [64, 1])
def test_pairs_are_resolved_in_tasks_of_few_rows(spark, monkeypatch, per_key):
    """No task gets many pairs, however few bytes they are, in the plain range join and the bucketed one."""
    day, tables = dt.date(2024, 1, 1), {}
    real = temporal.stage_table
    monkeypatch.setattr(temporal, "stage_table", lambda df, name: tables.setdefault(name, real(df, name)))
    pricing = [(p, Decimal(p * 10 + k), day + dt.timedelta(40 * k), day + dt.timedelta(40 * k + 30), k) for p in range(50) for k in range(2)]
    lines = [(i, i % 51, day + dt.timedelta(i // 51)) for i in range(51 * 40)]
    price = spark.createDataFrame(pricing, "product_id int, price decimal(10,2), start_date date, end_date date, load_seq int")
    out = temporal.price_at(spark.createDataFrame(lines, "line int, product_id int, d date"), price, "d", max_rows=0,
                            max_intervals_per_key=per_key, task_rows=100)
    got = {r.line: r.list_price for r in out.collect()}
    for i, p, d in lines:
        hits = [v for k, v, a, b, _ in pricing if k == p and a <= d <= b]
        assert got[i] == (hits[0] if hits else Decimal(p * 10 + 1) if p < 50 else None)
    files = tables["effective_pairs"].groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 51 * 40 and max(r["count"] for r in files) <= 400
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_fact_defaults(spark):
    txn = spark.createDataFrame([
        (1, 100, 10, dt.datetime(2024, 4, 2, 9, 0), 5),
        (2, 555, None, dt.datetime(2024, 4, 2, 9, 0), 6),
        (3, 100, 10, None, 5),
    ], "check_id bigint, store_id int, customer_id bigint, transaction_datetime timestamp_ntz, product_id int")
    txn = txn.select("*", *[F.lit(Decimal("1")).cast("decimal(18,4)").alias(c)
                            for c in ["quantity", "unit_price", "total_amount", "discount_abs"]])
    dd = spark.createDataFrame([(20240402, dt.date(2024, 4, 2))], "date_key int, full_date date")
    dp = spark.createDataFrame([(-1, -1), (1, 5)], "product_key int, product_id int")
    ds = spark.createDataFrame([(-1, -1), (1, 100)], "store_key int, store_id int")
    f = {r.check_id: r for r in build_fct_sales(txn, dd, dp, ds, customers(spark)).collect()}
    assert (f[1].date_key, f[1].product_key, f[1].store_key, f[1].customer_key) == (20240402, 1, 1, 2)
    assert (f[2].product_key, f[2].store_key, f[2].customer_key) == (-1, -1, 0)
    assert f[3].date_key is None and f[3].customer_key == 0


def rules(df):
    return {r.rule: r.n_bad for r in df.collect()}


def test_audits(spark):
    dim = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "k int, id int")
    assert rules(Q.audit_unique(dim, ["id"], "u")) == {"u": 2}
    assert rules(Q.audit_not_null(spark.createDataFrame([(1, None), (None, None)], "a int, b int"),
                                  ["a", "b"], "t")) == {"t.not_null:a": 1, "t.not_null:b": 2}
    fact = spark.createDataFrame([(1,), (1,), (4,), (None,)], "k int")
    assert rules(Q.audit_fk(fact, "k", dim, "k", "fk")) == {"fk": 1}
    raw = text_df(spark, ["q", "p"], [("-1", "5"), ("", "-0.5"), ("2", None)])
    assert rules(Q.audit_negative(raw, ["q", "p"], "r")) == {"r.negative:q": 1, "r.negative:p": 1}
    assert rules(Q.audit_length(raw, {"q": 1}, "r")) == {"r.too_long:q": 1}
    assert rules(Q.audit_rejects(text_df(spark, ["x"], [("1",), ("x",), ("",)]),
                                 {"x": F.trim("x").try_cast("int")}, "r")) == {"r.rejected:x": 1}
    iv = spark.createDataFrame([
        (1, dt.date(2024, 1, 1), dt.date(2024, 12, 31), 1),
        (1, dt.date(2024, 2, 1), dt.date(2024, 2, 10), 2),    # contained
        (1, dt.date(2024, 3, 1), dt.date(2024, 3, 5), 3),     # contained in the first, not in the previous
        (2, dt.date(2024, 1, 1), dt.date(2024, 1, 31), 1),
        (2, dt.date(2024, 2, 1), dt.date(2024, 2, 28), 2)],
        "product_id int, start_date date, end_date date, load_seq int")
    assert rules(Q.audit_overlap(iv, "product_id", "start_date", "end_date", "load_seq", "o")) == {"o": 2}


def test_orphans_and_total(spark):
    heads = text_df(spark, ["check_id"], [("1",), ("2",)])
    lines = text_df(spark, ["check_id"], [("1",), ("3",), ("3",)])
    assert rules(Q.audit_orphans(heads, lines)) == {"raw_check_details.no_header": 2,
                                                    "raw_check_summary.no_lines": 1}
    t = spark.createDataFrame([(Decimal("2"), Decimal("3"), Decimal("1"), Decimal("5")),
                               (Decimal("2"), Decimal("3"), Decimal("1"), Decimal("4"))],
                              "unit_price decimal(18,4), quantity decimal(18,4), discount_abs decimal(18,4), "
                              "total_amount decimal(18,4)")
    assert rules(Q.audit_total(t)) == {"stg_transactions.total_mismatch": 1}


def test_running_max_hot_key_across_partitions(spark):
    """One key spanning many range partitions gets the same answer as a
    per-key window."""
    import random

    from pyspark.sql import Window

    from tillstar.operators.sweep import running_max_before

    rnd = random.Random(7)
    rows = [(0 if i % 3 else rnd.randint(1, 40), rnd.randint(0, 1000), rnd.randint(0, 1000), i)
            for i in range(3000)]
    rows = [(k, s, s + rnd.randint(0, 50) if e % 7 else None, i) for k, s, e, i in rows]
    df = spark.createDataFrame(rows, "k int, s int, e int, i int")
    got = running_max_before(df, "k", ["s", "e", "i"], "e", "pm", num_partitions=9)
    w = Window.partitionBy("k").orderBy(F.col("s").asc_nulls_last(), F.col("e").asc_nulls_last(),
                                        F.col("i")).rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("pm", F.max("e").over(w))
    def rows(d):
        return sorted(tuple(-1 if v is None else v for v in r)
                      for r in d.select("k", "s", "e", "i", "pm").collect())
    assert rows(got) == rows(want)


def test_keys_are_audited_in_one_pass_or_apart(spark):
    fact = spark.createDataFrame([(1, 7), (1, None), (2, 8), (None, 9)], "a int, b int")
    a, b = spark.createDataFrame([(1,), (1,)], "a int"), spark.createDataFrame([(7,)], "k int")
    refs = {"a": (a, "a"), "b": (b, "k")}
    want = {"f.fk:a": 1, "f.fk:b": 2}
    assert rules(Q.audit_fks(fact, refs, "f")) == want
    assert rules(Q.audit_fks(fact, refs, "f", max_rows=0)) == want


def test_stray_day_makes_one_bucket(spark):
    """Many open-ended intervals on one key and a sale on the last day there is."""
    from tillstar.operators.temporal import _covering

    days = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(0, 100, 9)] + [dt.date(9999, 12, 31)]
    probes = spark.createDataFrame([(1, d) for d in days], "_k int, _d date")
    spans = [(1, dt.date(2020, 1, 1) + dt.timedelta(i), dt.date(9999, 12, 31), i) for i in range(70)]
    table = spark.createDataFrame(spans, "_tk int, _s date, _e date, _q int")
    got = _covering(probes, table, "inner", 64, 30).select("_d", "_q").collect()
    want = {(d, q) for d in days for _, s, e, q in spans if s <= d <= e}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    plain = _covering(probes, table, "left", 1000, 30)
    assert plain.count() == len(want)
