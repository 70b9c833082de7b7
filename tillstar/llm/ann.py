"""Nearest neighbours by adaptive dimension scan within probed lists.

Vectors are turned by one random rotation, so that every block of columns
holds an even share of a distance, and are kept in column blocks.  A list is
scanned block by block; after each, the partial squared distance, scaled up
to all columns, is tested against the query's current k-th distance, and a
candidate that fails the test is abandoned.  Distances of those that come
through are exact, and so are the scores: inner products of the original
vectors in double precision.

The largest inner product becomes the smallest distance by one more column,
``sqrt(M * M - |x| * |x|)`` with ``M`` the largest norm, for stored vectors,
and 0 for queries.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stage_table

#: A block of columns is gathered for single pairs when one in so many is left.
FEW = 16
#: Pairs whose scores are computed at once.
PAIRS = 1 << 16


def usable(vec: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    x = F.transform(vec, lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return F.coalesce(fine & F.exists(x, lambda v: v != 0), F.lit(False))


def rotation(d: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.argmax(x @ c.T - 0.5 * (c * c).sum(1), axis=1)
        n = np.bincount(near, minlength=len(c))
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, d)


def scan_block(q: np.ndarray, x: np.ndarray, best: np.ndarray, k: int, width: int, sigma: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row of ``q`` and a row of ``x`` that may be among the ``k`` nearest of the first, ordered by both.

    ``best``: each query's current k-th squared distance, inf at first.  Columns are read in blocks of ``width``;
    after ``j`` of ``d`` columns a candidate is abandoned when its partial
    distance exceeds ``best * j / d * (1 + sigma / sqrt(j)) ** 2``, a bound
    that a nearer vector breaks with a probability falling in ``sigma``.
    While more than one pair in ``FEW`` is left, a block is a matrix product of all pairs; then the pairs left are gathered.
    """
    d, pairs = x.shape[1], len(q) * len(x)
    x2, q2 = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", q, q)
    # A product's rounding grows with the vectors, not with their distance.
    slack = 1e-9 + 1e-13 * float(x2.max(initial=0.0) + q2.max(initial=0.0))
    part, left = np.zeros((len(q), len(x))), np.ones((len(q), len(x)), bool)
    who = rows = None
    for at in range(0, d, width):
        j = min(at + width, d)
        qb, xb = q[:, at:j], x[:, at:j]
        bound = (best if j == d else best * j / d * (1 + sigma / math.sqrt(j)) ** 2) + slack
        if who is not None:
            gap = xb[rows] - qb[who]
            part = part + np.einsum("ij,ij->i", gap, gap)
            near = part <= bound[who]
            who, rows, part = who[near], rows[near], part[near]
            continue
        with np.errstate(invalid="ignore"):
            part += np.einsum("ij,ij->i", xb, xb) - 2 * (qb @ xb.T)
            part += np.einsum("ij,ij->i", qb, qb)[:, None]
            left &= part <= bound[:, None]
        if j == d or np.count_nonzero(left) * FEW <= pairs:
            who, rows = np.nonzero(left)
            part = part[who, rows]
    bounds = np.searchsorted(who, np.arange(len(q) + 1))
    for i in np.nonzero(np.diff(bounds) >= k)[0]:
        best[i] = min(best[i], float(np.partition(part[bounds[i]:bounds[i + 1]], k - 1)[k - 1]))
    return who, rows


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            probe: float = 0.75, sample: int = 20_000, shard_rows: int = 8192, query_rows: int = 4096,
            width: int = 16, sigma: float = 2.1) -> DataFrame:
    """The ``k`` nearest vectors, by inner product, of every query but itself.

    Returns ``query_id, rank`` (from 1), ``vec_id, score`` (double): nearest
    first, ties to the smaller id; all candidates if they are fewer.  Vectors
    that are null, zero, hold a null or non-finite component, or have a null
    id or another number of dimensions than most take no part, on either
    side.  Of rows that share an id each is a candidate, but never for a query
    of that id.  An empty table gives an empty result.

    The index: about as many lists as the square root of the rows, by k-means
    on ``sample`` rows (bounded, those with the smallest hash of their id);
    every row is indexed.  A query scans the ``probe`` share of the rows that
    lies in its nearest lists.  A long list is cut into parts, and queries
    come in groups of ``query_rows``, so a task holds about ``shard_rows``
    vectors and ``query_rows`` queries, whatever the skew.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where("id is not null")
        return df.where(usable(F.col("v"))).select("id", F.transform("v", lambda c: c.cast("double")).alias("v"))

    base, wanted = clean(vectors), clean(queries)
    about = base.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, b: a + b * b))).alias("norm")).orderBy(F.desc("n"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if about is None:
        return spark.createDataFrame([], schema)
    d, n, most = about["d"], about["n"], about["norm"]
    base, wanted = base.where(F.size("v") == d), wanted.where(F.size("v") == d)
    some = base.orderBy(F.xxhash64("id", F.lit(31)), "id").limit(sample).select("v").toArrow()
    turn = rotation(d + 1)

    def lifted(x: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(most * most - (x * x).sum(1), 0.0))
        return np.column_stack([x, extra]) @ turn

    fitted = _matrix(some.column("v").combine_chunks(), d)
    centres = kmeans(lifted(fitted), max(1, min(len(fitted), 4096, round(math.sqrt(n)))))
    shared = spark.sparkContext.broadcast((turn, centres))

    def assign(batches):
        turn, c = shared.value
        for batch in batches:
            y = lifted(_matrix(batch.column(1), d)) if batch.num_rows else np.empty((0, d + 1))
            near = np.argmax(y @ c.T - 0.5 * (c * c).sum(1), axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.int32())], ["id", "v", "list"])

    indexed = stage_table(base.mapInArrow(assign, "id long, v array<double>, list int"), "index")
    # One row per list, at most 4,096: lists are strung together into shards,
    # and a list beyond a shard's size takes several.
    sizes = sorted((r["list"], r["n"]) for r in indexed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect())
    place, at, filled = {}, 0, 0
    for which, rows in sizes:
        parts = -(-rows // shard_rows)
        if filled and filled + rows > shard_rows:
            at, filled = at + 1, 0
        place[which] = (at, parts)
        if parts > 1:
            at, filled = at + parts, 0
        else:
            filled += rows
    table = np.zeros((len(centres), 3), np.int64)
    for which, rows in sizes:
        table[which] = (*place[which], rows)
    where = spark.createDataFrame([(int(w), int(s), int(p)) for w, (s, p) in place.items()], "list int, s long, parts long")
    n_queries = wanted.count()
    groups = max(1, -(-n_queries // query_rows))

    def route(batches):
        """A row for every shard that holds a probed list, with the lists probed there."""
        turn, c = shared.value
        need = probe * table[:, 2].sum()
        for batch in batches:
            if not batch.num_rows:
                continue
            y = np.column_stack([_matrix(batch.column(1), d), np.zeros(batch.num_rows)]) @ turn
            order = np.argsort(-(y @ c.T - 0.5 * (c * c).sum(1)), axis=1, kind="stable")
            ids, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for i, vec in enumerate(rows):
                seen = np.cumsum(table[order[i], 2])
                lists = order[i][:int(np.searchsorted(seen, need)) + 1]
                by: dict[int, list[int]] = {}
                for which in lists:
                    first, parts, rows_in = table[which]
                    for s in range(first, first + parts) if rows_in else ():
                        by.setdefault(int(s), []).append(int(which))
                out += [(s, ids[i], vec, got) for s, got in by.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32())), strict=True)],
                ["shard", "id", "v", "lists"])

    part = F.pmod(F.xxhash64("id", F.lit(33)), F.col("parts"))
    held = indexed.join(F.broadcast(where), "list").withColumn("shard", F.col("s") + part).select("shard", "id", "v", "list")
    held = held.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = wanted.mapInArrow(route, "shard long, id long, v array<double>, lists array<int>")
    asked = asked.withColumn("group", F.pmod(F.xxhash64("id", F.lit(34)), F.lit(groups)).cast("int"))

    def scan(key, left: pa.Table, right: pa.Table) -> pa.Table:
        turn, _ = shared.value
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            xs, ids = _matrix(left.column("v").combine_chunks(), d), left.column("id").to_numpy()
            which = left.column("list").to_numpy()
            by = np.argsort(which, kind="stable")
            xs, ids, which = xs[by], ids[by], which[by]
            y = lifted(xs)
            lists, start = np.unique(which, return_index=True)
            end = np.append(start[1:], len(which))
            qs, qids = _matrix(right.column("v").combine_chunks(), d), right.column("id").to_numpy()
            qy = np.column_stack([qs, np.zeros(len(qs))]) @ turn
            # A few rows from all over the shard give every query its first
            # bound; the nearest of them count as found.
            step = max(1, len(y) // 512)
            some = y[::step]
            near = (some * some).sum(1) - 2 * (qy @ some.T)
            best, first = np.full(len(qs), np.inf), np.arange(len(some))[None].repeat(len(qs), 0)
            if len(some) > k + 1:
                first = np.argpartition(near, k, axis=1)[:, :k + 1]
                best = np.take_along_axis(near, first, 1).max(1) + (qy * qy).sum(1)
            probes = right.column("lists").combine_chunks()
            of = np.repeat(np.arange(len(qs)), np.diff(probes.offsets.to_numpy()))
            flat = probes.flatten().to_numpy()
            pairs = [np.arange(len(qs)).repeat(first.shape[1]) * len(y) + first.ravel() * step]
            for i, which_list in enumerate(lists):
                who = of[flat == which_list]
                for lo in range(0, len(who), 512):
                    some = who[lo:lo + 512]
                    limit = best[some]
                    a, rows = scan_block(qy[some], y[start[i]:end[i]], limit, k + 1, width, sigma)
                    pairs.append(some[a] * len(y) + rows + start[i])
                    best[some] = limit
            # By query, each pair once.
            pairs = np.unique(np.concatenate(pairs))
            who, rows = pairs // len(y), pairs % len(y)
            other = ids[rows] != qids[who]
            who, rows = who[other], rows[other]
            s = np.empty(len(who))
            for lo in range(0, len(who), PAIRS):
                s[lo:lo + PAIRS] = (xs[rows[lo:lo + PAIRS]] * qs[who[lo:lo + PAIRS]]).sum(1)
            order = np.lexsort((ids[rows], -s, who))
            who, rows, s = who[order], rows[order], s[order]
            top = np.arange(len(who)) - np.searchsorted(who, who) < k
            found.append((qids[who[top]], ids[rows[top]], s[top]))
        cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])

    got = held.groupBy("shard", "group").cogroup(asked.groupBy("shard", "group")).applyInArrow(
        scan, "query_id long, vec_id long, score double")
    # Each shard sends its k best of a query; those of all its shards meet here.
    best = got.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("far"), "vec_id", "score"))), 1, k).alias("top"))
    return best.select("query_id", F.posexplode("top").alias("at", "t")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "t.vec_id", "t.score")
