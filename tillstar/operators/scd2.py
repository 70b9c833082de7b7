"""Customer dimension with history, SCD type 2.

Versions are closed intervals ``[valid_from, valid_to]`` with open end
9999-12-31; exactly one version per customer is current.  The delta
(``scd2_apply``) is one plan that reads dimension version v and yields
version v + 1:

    untouched and closed rows  UNION ALL  new versions of changed ids
                               UNION ALL  versions of never-seen ids

Keys of existing rows never change; new rows continue after the largest
key in use.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import dates as D
from ..session import shared_dir
from ..sources.catalog import publish_table, table_stats
from ..sources.sinks import stage_table
from .keys import assign_keys, max_key, seed_member
from .lookups import BROADCAST_MAX_ROWS, sized_broadcast

ID = "customer_id"
KEY = "customer_key"
ATTRS = ["name", "city", "birthday"]
VERSION_COLS = [ID, *ATTRS, "valid_from", "valid_to", "is_current"]
DIM_COLS = [KEY, *VERSION_COLS]

# The Guest member that absorbs sales without a known customer.
GUEST = {KEY: 0, ID: None, "name": "Guest Customer", "city": "Unknown", "birthday": None,
         "valid_from": D.GUEST_FROM, "valid_to": D.OPEN_END, "is_current": True}


def first_purchase(txn: DataFrame, ts_col: str = "transaction_datetime") -> DataFrame:
    """First sale day per known customer.

    Partial aggregation before the shuffle keeps one row per customer per
    task, so a customer with a large share of the sales costs no more than
    any other in the exchange.
    """
    return (txn.where(F.col(ID).isNotNull())
            .groupBy(ID).agg(F.min(D.to_day(ts_col)).alias("first_purchase_date")))


def scd2_init(customers: DataFrame, first: DataFrame, as_of) -> DataFrame:
    """One current version per staged customer, valid from the first
    purchase, or from ``as_of`` for customers without one (D7, J9)."""
    f = first.select(F.col(ID).alias("_fid"), "first_purchase_date")
    x = customers.join(f, customers[ID] == f["_fid"], "left")
    return x.select(
        *[F.col(c) for c in [ID, *ATTRS]],
        F.coalesce(F.col("first_purchase_date"), D.as_date(as_of)).alias("valid_from"),
        F.lit(D.OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_split(versions: DataFrame, changes: DataFrame, attr: str = "city") -> DataFrame:
    """Insert past history (D8, U2): for each change ``(id, change_date,
    old_<attr>)`` with ``valid_from < change_date`` the current version
    becomes two rows, the old value on ``[valid_from, change_date - 1]``
    (not current) and the current value from ``change_date``.

    Several changes of one id are chained by date: each old value holds from
    the change before it, and the current value from the last; of changes on
    one day the smallest old value counts.  One join, then a generator; no
    second pass over the dimension.
    """
    old = f"old_{attr}"
    ch = changes.where(F.col("change_date").isNotNull()).groupBy(F.col(ID).alias("_cid"), "change_date").agg(F.min(old).alias("_old"))
    ch = ch.groupBy("_cid").agg(F.sort_array(F.collect_list(F.struct("change_date", "_old"))).alias("_all"))
    x = versions.join(ch, versions[ID] == ch["_cid"], "left")
    x = x.withColumn("_ch", F.coalesce(F.filter("_all", lambda c: c["change_date"] > F.col("valid_from")), F.array()))

    def row(**over):
        return F.struct(*[over.get(c, F.col(c)).cast(x.schema[c].dataType).alias(c) for c in VERSION_COLS])

    def past(c, i):
        start = F.when(i == 0, F.col("valid_from")).otherwise(F.get(F.col("_ch"), i - 1)["change_date"])
        return row(**{attr: c["_old"], "valid_from": start, "valid_to": F.date_sub(c["change_date"], 1),
                      "is_current": F.lit(False)})

    last = F.get(F.col("_ch"), F.size("_ch") - 1)["change_date"]
    now = row(valid_from=F.coalesce(last, F.col("valid_from")))
    rows = F.concat(F.transform("_ch", past), F.array(now))
    return x.select(F.explode(rows).alias("v")).select("v.*")


def key_versions(versions: DataFrame, start: int = 1) -> DataFrame:
    """Surrogate keys for versions in (id, valid_from, ...) order."""
    order = [F.col(c).asc_nulls_last() for c in
             [ID, "valid_from", "valid_to", "city", "name", "birthday"]]
    return assign_keys(versions, KEY, order, start=start)


def build_dim_customers(customers: DataFrame, txn: DataFrame, as_of,
                        changes: DataFrame | None = None) -> DataFrame:
    """Initial customer dimension: Guest 0 + versions keyed from 1."""
    v = scd2_init(customers, first_purchase(txn), as_of)
    if changes is not None:
        v = scd2_split(v, changes)
    return seed_member(key_versions(v), GUEST).select(*DIM_COLS)


# --- delta --------------------------------------------------------------


# Bytes of text in a feed that is broadcast whole.
FEED_MAX_BYTES = 256 << 20


def _small(stg: DataFrame, max_rows: int) -> bool:
    """Whether a feed may be broadcast: few rows and little text, both measured."""
    if max_rows <= 0:
        return False
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in stg.dtypes if kind == "string"), F.lit(0))
    rows, size = stg.agg(F.count(F.lit(1)), F.coalesce(F.sum(text), F.lit(0))).first()
    return rows <= max_rows and size <= FEED_MAX_BYTES


def scd2_changed(stg: DataFrame, dim: DataFrame, tracked: list[str] = ("city",),
                 collation: str | None = None, max_rows: int = BROADCAST_MAX_ROWS,
                 small_feed: bool | None = None) -> DataFrame:
    """Staged rows whose current version differs in a tracked attribute.

    NULL and '' are equal; attributes not tracked are ignored.  A feed under
    the broadcast bound (a streaming micro-batch, a daily delta) is
    broadcast and the dimension streams past it without a shuffle.
    """
    cur = dim.where(F.col("is_current")).select(
        F.col(ID).alias("_did"), *[F.col(t).alias(f"_d_{t}") for t in tracked])
    if small_feed is None:
        small_feed = _small(stg, max_rows)
    s = F.broadcast(stg) if small_feed else stg
    x = s.join(cur, s[ID] == cur["_did"], "inner")
    diff = None
    for t in tracked:
        c = C.changed(F.col(t), F.col(f"_d_{t}"), collation)
        diff = c if diff is None else (diff | c)
    return x.where(diff).select(ID, *ATTRS)


def scd2_close(dim: DataFrame, changed: DataFrame, as_of,
               max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Current versions of changed ids: not current, ``valid_to = as_of - 1``.

    The distinct changed ids - usually a small share of a delta - are
    broadcast after a count check, so the full dimension rows are not
    shuffled; above the bound the join shuffles both sides on the id.
    """
    hit = changed.select(F.col(ID).alias("_hid")).distinct().withColumn("_hit", F.lit(True))
    hit = sized_broadcast(hit, max_rows)
    x = dim.join(hit, dim[ID] == hit["_hid"], "left")
    close = F.coalesce(F.col("_hit"), F.lit(False)) & F.col("is_current")
    return x.select(
        *[F.col(c) for c in [KEY, ID, *ATTRS, "valid_from"]],
        F.when(close, F.date_sub(D.as_date(as_of), 1)).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(close, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
    )


def _open_version(rows: DataFrame, as_of) -> DataFrame:
    return rows.select(
        *[F.col(c) for c in [ID, *ATTRS]],
        D.as_date(as_of).alias("valid_from"),
        F.lit(D.OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_versions(changed: DataFrame, as_of) -> DataFrame:
    """New current versions of changed ids from ``as_of``."""
    return _open_version(changed, as_of)


def scd2_new(stg: DataFrame, dim: DataFrame, as_of, max_rows: int = BROADCAST_MAX_ROWS,
             small_feed: bool | None = None) -> DataFrame:
    """Staged ids never seen in the dimension, valid from ``as_of``.

    A staged NULL id never matches, so it is inserted on every run, as the
    source's LEFT JOIN ... IS NULL does.  For a feed under the broadcast
    bound the dimension's ids are first reduced to those present in the
    feed (a semi join against the broadcast feed ids, no dimension
    shuffle); the anti join then runs between two small sides.
    """
    known = dim.select(F.col(ID).alias("_did"))
    if small_feed is None:
        small_feed = _small(stg, max_rows)
    if small_feed:
        ids = F.broadcast(stg.select(F.col(ID).alias("_sid")).where(F.col("_sid").isNotNull()).distinct())
        known = known.join(ids, known["_did"] == ids["_sid"], "left_semi")
    # Distinct ids: versions of one customer collapse before the shuffle.
    known = known.distinct()
    x = stg.join(known, stg[ID] == known["_did"], "left_anti")
    return _open_version(x.select(ID, *ATTRS), as_of)


def _classify(stg: DataFrame, dim: DataFrame, tracked: list[str],
              collation: str | None) -> tuple[DataFrame, DataFrame]:
    """Changed and new rows of a large feed from one shuffle of the feed.

    The dimension side holds each current version ``(id, tracked...)`` and
    one marker row per id that has only closed versions.  One LEFT join of
    the feed with it gives both answers: a feed row matching a current
    version with a different tracked value is changed (one row per such
    version, as the source's join gives); a feed row matching nothing is
    new; a feed row matching only a marker is neither.  The join result is
    checkpointed and read twice.
    """
    cur = dim.where(F.col("is_current")).select(
        F.col(ID).alias("_did"), *[F.col(t).alias(f"_d_{t}") for t in tracked],
        F.lit(True).alias("_cur"))
    # An id with no current version (a NULL flag counts as not current) still
    # exists: it gets a marker, so its feed rows are not taken for new ids.
    flag = F.coalesce(F.col("is_current"), F.lit(False)).cast("int")
    closed_only = (dim.groupBy(ID).agg(F.max(flag).alias("_m"))
                   .where(F.col("_m") == 0)
                   .select(F.col(ID).alias("_did"),
                           *[F.lit(None).cast(dim.schema[t].dataType).alias(f"_d_{t}") for t in tracked],
                           F.lit(False).alias("_cur")))
    side = cur.unionByName(closed_only)
    j = stg.join(side, stg[ID] == side["_did"], "left").checkpoint(eager=True)
    diff = None
    for t in tracked:
        c = C.changed(F.col(t), F.col(f"_d_{t}"), collation)
        diff = c if diff is None else (diff | c)
    changed = j.where(F.col("_cur") & diff).select(ID, *ATTRS)
    new = j.where(F.col("_did").isNull()).select(ID, *ATTRS)
    return changed, new


def scd2_apply(dim: DataFrame, stg: DataFrame, as_of, tracked: list[str] = ("city",),
               collation: str | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The whole delta in one plan (D13): close, add new versions, add new ids.

    New keys continue after the largest key in use: changed ids first, then
    new ids, each in id order.  With a feed under the broadcast bound (one
    count) no step shuffles the dimension; a larger feed (a full restage)
    is shuffled once, classified by ``_classify``.
    """
    # The feed is read by several steps, the changed ids by two (close, new
    # versions): each is written once, like the
    # source's temporary table, so the comparison join runs once.
    shared_dir(dim.sparkSession)
    stg = stage_table(stg, "feed")
    if _small(stg, max_rows):
        changed = scd2_changed(stg, dim, list(tracked), collation, small_feed=True).checkpoint(eager=True)
        new = scd2_new(stg, dim, as_of, small_feed=True)
    else:
        changed, new = _classify(stg, dim, list(tracked), collation)
        new = _open_version(new, as_of)
    closed = scd2_close(dim, changed, as_of, max_rows)
    fresh = (scd2_versions(changed, as_of).withColumn("_batch", F.lit(0))
             .unionByName(new.withColumn("_batch", F.lit(1))))
    order = [F.col("_batch")] + [F.col(c).asc_nulls_last() for c in [ID, "name", "city", "birthday"]]
    keyed = assign_keys(fresh, KEY, order, start=max_key(dim, KEY) + 1).drop("_batch")
    return closed.select(*DIM_COLS).unionByName(keyed.select(*DIM_COLS))


def _differs(tracked: list[str], collation: str | None):
    return reduce(or_, [C.changed(F.col(t), F.col(f"_d_{t}"), collation) for t in tracked])


def scd2_apply_bucketed(dim_name: str, stg: DataFrame, as_of, tracked: list[str] = ("city",),
                        collation: str | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The delta (D13) against a dimension stored in buckets of the customer id.

    ``dim_name`` is a table of ``catalog.publish_table`` with ``bucket_by``
    the id.  A full restage is shuffled once, into as many buckets; the
    joins that find changed ids (J7), new ids (J6) and the versions to close
    (J8) then read both sides bucket by bucket, and no row of the dimension
    is exchanged.  Rows without an id match nothing and bypass the joins:
    staged ones are inserted, versions of the dimension pass unchanged.
    Same rows as ``scd2_apply``.
    """
    spark = stg.sparkSession
    buckets = table_stats(spark, dim_name).buckets
    if not buckets:
        raise ValueError(f"{dim_name} is not bucketed")
    dim = spark.table(dim_name)
    known = dim.where(F.col(ID).isNotNull())
    run = f"tillstar_{uuid.uuid4().hex}"
    stg = stage_table(stg.select(ID, *ATTRS), "feed")
    feed = publish_table(stg.where(F.col(ID).isNotNull()), f"{run}_feed", bucket_by=ID, buckets=buckets)
    cur = known.where("is_current").select(F.col(ID).alias("_did"), *[F.col(t).alias(f"_d_{t}") for t in tracked])
    changed = feed.join(cur.hint("merge"), feed[ID] == cur["_did"]).where(_differs(list(tracked), collation)).select(ID, *ATTRS)
    changed = publish_table(changed, f"{run}_changed", bucket_by=ID, buckets=buckets)
    ids = known.select(F.col(ID).alias("_did"))
    new = feed.join(ids.hint("merge"), feed[ID] == ids["_did"], "left_anti").unionByName(stg.where(F.col(ID).isNull()))
    closed = scd2_close(known, changed, as_of, max_rows).unionByName(dim.where(F.col(ID).isNull()).select(*DIM_COLS))
    fresh = (scd2_versions(changed, as_of).withColumn("_batch", F.lit(0))
             .unionByName(_open_version(new, as_of).withColumn("_batch", F.lit(1))))
    order = [F.col("_batch")] + [F.col(c).asc_nulls_last() for c in [ID, "name", "city", "birthday"]]
    keyed = assign_keys(fresh, KEY, order, start=max_key(dim, KEY) + 1).drop("_batch")
    return closed.select(*DIM_COLS).unionByName(keyed.select(*DIM_COLS))


def as_of_date(v) -> _dt.date:
    return _dt.date.fromisoformat(v) if isinstance(v, str) else v
