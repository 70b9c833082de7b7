"""SCD2 delta on the scenario table of FIXTURES.md (as_of 2024-06-01)."""

import datetime as dt

from tillstar.operators import scd2

OPEN = dt.date(9999, 12, 31)
D0 = dt.date(2024, 1, 1)
AS_OF = dt.date(2024, 6, 1)
DIM_SCHEMA = ("customer_key bigint, customer_id bigint, name string, city string, birthday date, "
              "valid_from date, valid_to date, is_current boolean")
STG_SCHEMA = "customer_id bigint, name string, city string, birthday date"


def dim_before(spark):
    rows = [
        (0, None, "Guest Customer", "Unknown", None, dt.date(1900, 1, 1), OPEN, True),
        (1, 1, "n1", "A", None, D0, OPEN, True),
        (2, 2, "n2", "A", None, D0, OPEN, True),
        (3, 4, "n4", "A", None, D0, OPEN, True),
        (4, 5, "n5", "Z", None, D0, dt.date(2024, 3, 1), False),
        (5, 6, "n6", None, None, D0, OPEN, True),
        (6, 7, "n7", "A", None, D0, OPEN, True),
    ]
    return spark.createDataFrame(rows, DIM_SCHEMA)


def staged(spark, city2="B"):
    rows = [(1, "n1", "A", None), (2, "n2", city2, None), (3, "n3", "C", None),
            (5, "n5", "D", None), (6, "n6", "", None), (7, "other", "A", None)]
    return spark.createDataFrame(rows, STG_SCHEMA)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.customer_id, []).append(r)
    return {k: sorted(v, key=lambda r: (r.valid_from, r.customer_key)) for k, v in out.items()}


def test_delta_scenarios(spark):
    after = scd2.scd2_apply(dim_before(spark), staged(spark), AS_OF)
    v = by_id(after)
    assert [(r.city, r.valid_to, r.is_current) for r in v[1]] == [("A", OPEN, True)]
    assert [(r.city, r.valid_from, r.valid_to, r.is_current) for r in v[2]] == [
        ("A", D0, dt.date(2024, 5, 31), False), ("B", AS_OF, OPEN, True)]
    assert [(r.city, r.valid_from, r.is_current) for r in v[3]] == [("C", AS_OF, True)]
    assert [(r.city, r.is_current) for r in v[4]] == [("A", True)]
    assert [(r.city, r.is_current) for r in v[5]] == [("Z", False)]
    assert [(r.city, r.is_current) for r in v[6]] == [(None, True)]
    assert [(r.name, r.is_current) for r in v[7]] == [("n7", True)]
    assert [(r.customer_key, r.city) for r in v[None]] == [(0, "Unknown")]
    # existing keys kept; new keys continue after the max (6): changed id 2 first, then new id 3
    assert v[2][1].customer_key == 7 and v[3][0].customer_key == 8
    assert sorted(r.customer_key for r in after.collect()) == list(range(0, 9))


def test_rerun_same_input_is_noop(spark):
    once = scd2.scd2_apply(dim_before(spark), staged(spark), AS_OF)
    twice = scd2.scd2_apply(once, staged(spark), AS_OF)
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r) for r in twice.collect())


def test_second_change_same_day(spark):
    once = scd2.scd2_apply(dim_before(spark), staged(spark), AS_OF)
    again = by_id(scd2.scd2_apply(once, staged(spark, city2="E"), AS_OF))
    rows = [(r.city, r.valid_from, r.valid_to, r.is_current) for r in again[2]]
    assert ("B", AS_OF, dt.date(2024, 5, 31), False) in rows
    assert ("E", AS_OF, OPEN, True) in rows
    assert sum(r.is_current for r in again[2]) == 1


def test_init_and_split(spark):
    cust = spark.createDataFrame([(1, "a", "X", None), (2, "b", "Y", None), (None, "c", "W", None)], STG_SCHEMA)
    txn = spark.createDataFrame([(1, dt.datetime(2023, 2, 1, 10)), (1, dt.datetime(2023, 1, 5, 9)),
                                 (None, dt.datetime(2022, 1, 1, 9))],
                                "customer_id bigint, transaction_datetime timestamp_ntz")
    changes = spark.createDataFrame([(1, dt.date(2023, 6, 1), "OLD"), (2, dt.date(2023, 6, 1), "OLD2")],
                                    "customer_id bigint, change_date date, old_city string")
    dim = scd2.build_dim_customers(cust, txn, dt.date(2024, 1, 1), changes)
    v = by_id(dim)
    assert [(r.city, r.valid_from, r.valid_to, r.is_current) for r in v[1]] == [
        ("OLD", dt.date(2023, 1, 5), dt.date(2023, 5, 31), False), ("X", dt.date(2023, 6, 1), OPEN, True)]
    # no purchase -> valid from as_of, which is after the change day: not split
    assert [(r.city, r.valid_from) for r in v[2]] == [("Y", dt.date(2024, 1, 1))]
    assert [r.name for r in v[None]] == ["c", "Guest Customer"] or sorted(r.name for r in v[None]) == ["Guest Customer", "c"]
    cur = [r for r in dim.collect() if r.is_current and r.customer_id is not None]
    assert len(cur) == len({r.customer_id for r in cur})


def test_tracked_attributes_and_collation(spark):
    dim = spark.createDataFrame([
        (0, None, "Guest Customer", "Unknown", None, dt.date(1900, 1, 1), OPEN, True),
        (1, 1, "Ann", "Kyiv", None, D0, OPEN, True),
        (2, 2, "Bob", "Lviv", None, D0, OPEN, True)], DIM_SCHEMA)
    stg = spark.createDataFrame([(1, "Anna", "Kyiv", None), (2, "Bob", "LVIV ", None)], STG_SCHEMA)
    # name tracked too: id 1 changes; binary comparison: id 2 changes (case, trailing space)
    v = by_id(scd2.scd2_apply(dim, stg, AS_OF, tracked=("city", "name")))
    assert [r.is_current for r in v[1]] == [False, True] and v[1][1].name == "Anna"
    assert len(v[2]) == 2
    # case- and trailing-space-insensitive comparison: id 2 is unchanged
    v = by_id(scd2.scd2_apply(dim, stg, AS_OF, collation="UNICODE_CI_AI_RTRIM"))
    assert len(v[2]) == 1 and v[2][0].city == "Lviv"
    assert len(v[1]) == 1                      # only the city is tracked by default


def test_large_feed_null_flag_counts_as_existing(spark):
    dim = spark.createDataFrame([
        (0, None, "Guest Customer", "Unknown", None, dt.date(1900, 1, 1), OPEN, True),
        (1, 1, "a", "A", None, D0, OPEN, None)], DIM_SCHEMA)
    stg = spark.createDataFrame([(1, "a", "B", None)], STG_SCHEMA)
    for max_rows in (2_000_000, 0):
        out = scd2.scd2_apply(dim, stg, AS_OF, max_rows=max_rows)
        assert out.count() == 2          # id 1 exists: neither changed (no current row) nor new


def test_split_chains_several_changes_of_one_id(spark):
    import datetime as dt

    from tillstar.operators import scd2

    day = dt.date
    v = spark.createDataFrame([(1, "n", "now", None, day(2024, 1, 1), day(9999, 12, 31), True)],
                              "customer_id bigint, name string, city string, birthday date, valid_from date, valid_to date, is_current boolean")
    ch = spark.createDataFrame([(1, day(2024, 3, 1), "first"), (1, day(2024, 6, 1), "second"), (1, day(2023, 1, 1), "before")],
                               "customer_id bigint, change_date date, old_city string")
    got = sorted((r.valid_from, r.valid_to, r.city, r.is_current) for r in scd2.scd2_split(v, ch).collect())
    assert got == [(day(2024, 1, 1), day(2024, 2, 29), "first", False), (day(2024, 3, 1), day(2024, 5, 31), "second", False),
                   (day(2024, 6, 1), day(9999, 12, 31), "now", True)]
