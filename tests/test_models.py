"""Spark operators against brute-force Python models of the documented
semantics, on small random fixtures."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillstar.operators import scd2, temporal

SETTINGS = dict(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
OPEN = dt.date(9999, 12, 31)
AS_OF = dt.date(2024, 6, 1)
DIM = ("customer_key bigint, customer_id bigint, name string, city string, birthday date, "
       "valid_from date, valid_to date, is_current boolean")
STG = "customer_id bigint, name string, city string, birthday date"
cities = st.sampled_from([None, "", "A", "B", "C"])


def model_scd2(dim, stg, as_of):
    """The delta statement by statement: change list, close, insert changed, insert new."""
    def norm(c):
        return c if c is not None else ""
    changed = [s for s in stg for d in dim
               if s[0] is not None and s[0] == d[1] and d[7] and norm(s[2]) != norm(d[3])]
    ids = {c[0] for c in changed}
    out = [(d[0], d[1], d[2], d[3], d[4], d[5],
            as_of - dt.timedelta(days=1) if d[7] and d[1] in ids else d[6],
            False if d[7] and d[1] in ids else d[7]) for d in dim]
    known = {d[1] for d in dim if d[1] is not None}
    new = [s for s in stg if s[0] is None or s[0] not in known]
    nxt = max(d[0] for d in dim) + 1

    def order(r):
        return tuple((v is None, v if v is not None else "") for v in r)
    for r in sorted(changed, key=order) + sorted(new, key=order):
        out.append((nxt, r[0], r[1], r[2], r[3], as_of, OPEN, True))
        nxt += 1
    return sorted(out, key=lambda r: r[0])


@st.composite
def dims_and_feeds(draw):
    n = draw(st.integers(1, 8))
    dim = [(0, None, "Guest Customer", "Unknown", None, dt.date(1900, 1, 1), OPEN, True)]
    key = 1
    for cid in range(1, n + 1):
        if draw(st.booleans()):       # an older, closed version
            dim.append((key, cid, f"n{cid}", draw(cities), None, dt.date(2020, 1, 1), dt.date(2021, 1, 1), False))
            key += 1
        dim.append((key, cid, f"n{cid}", draw(cities), None, dt.date(2021, 1, 2), OPEN, draw(st.booleans())))
        key += 1
    stg = draw(st.lists(st.tuples(st.one_of(st.none(), st.integers(1, n + 3)), st.sampled_from(["x", "y"]),
                                  cities, st.none()), max_size=10))
    return dim, stg


@settings(**SETTINGS)
@given(dims_and_feeds(), st.sampled_from([2_000_000, 0]))
def test_scd2_apply_matches_statement_model(spark, case, max_rows):
    dim, stg = case
    got = scd2.scd2_apply(spark.createDataFrame(dim, DIM), spark.createDataFrame(stg, STG), AS_OF,
                          max_rows=max_rows)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == model_scd2(dim, stg, AS_OF)


def model_first(rows, product, day, fallback):
    """First listed row covering the day; else, with fallback, the last listed row."""
    listed = sorted((r for r in rows if r[0] == product), key=lambda r: r[4])
    for r in listed:
        if r[2] <= day <= r[3]:
            return r[1]
    return listed[-1][1] if fallback and listed else None


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 99), st.integers(0, 60), st.integers(0, 40)),
                max_size=25),
       st.lists(st.tuples(st.integers(0, 4), st.integers(0, 120)), min_size=1, max_size=30),
       st.booleans(), st.sampled_from([10**9, 0]))
def test_first_effective_matches_list_model(spark, intervals, lines, fallback, per_key):
    base = dt.date(2024, 1, 1)
    rows = [(p, Decimal(v), base + dt.timedelta(days=s), base + dt.timedelta(days=s + ln), i)
            for i, (p, v, s, ln) in enumerate(intervals)]
    table = spark.createDataFrame(rows, "product_id int, price decimal(10,2), start_date date, "
                                        "end_date date, load_seq int")
    facts = spark.createDataFrame([(i, p, base + dt.timedelta(days=d)) for i, (p, d) in enumerate(lines)],
                                  "line int, product_id int, d date")
    out = temporal.first_effective(facts, table, "product_id", "d", ["price"], fallback_last=fallback,
                                   max_intervals_per_key=per_key, bucket_days=9)
    got = {r.line: r.price for r in out.collect()}
    want = {i: model_first(rows, p, base + dt.timedelta(days=d), fallback) for i, (p, d) in enumerate(lines)}
    assert got == want


def model_overlaps(rows):
    """Count intervals that start on or before the end of an earlier one of the same product."""
    n = 0
    for p in {r[0] for r in rows}:
        ivs = sorted((r for r in rows if r[0] == p),
                     key=lambda r: (r[1], r[2] is None, r[2] if r[2] is not None else 0, r[3]))
        for i, r in enumerate(ivs):
            ends = [q[2] for q in ivs[:i] if q[2] is not None]
            if ends and max(ends) >= r[1]:
                n += 1
    return n


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3]), st.integers(0, 50),
                          st.one_of(st.none(), st.integers(0, 60)), st.integers(0, 10**6)),
                max_size=60, unique_by=lambda r: r[3]),
       st.sampled_from([None, 4]))
def test_overlap_audit_matches_model(spark, rows, parts):
    from tillstar.operators.audit import audit_overlap

    base = dt.date(2024, 1, 1)
    data = [(p, base + dt.timedelta(days=s), None if e is None else base + dt.timedelta(days=s + e), q)
            for p, s, e, q in rows]
    df = spark.createDataFrame(data, "product_id int, start_date date, end_date date, load_seq int")
    got = audit_overlap(df, "product_id", "start_date", "end_date", "load_seq", "o", num_partitions=parts)
    assert got.first().n_bad == model_overlaps(data)
