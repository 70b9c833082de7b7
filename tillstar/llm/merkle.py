"""Merkle manifest of a dataset, its leaves placed by bitmap ranks.

A leaf is the hash of a row.  Within a group (a source) leaves are ordered by
document id, and runs of ``fanout`` nodes are hashed together until one is
left; the groups' roots, in the order of their names, are reduced in the same
way to the root of the dataset.

Nothing sorts the leaves.  Tasks make compressed bitmaps of the ids that they
see in each group; merged, they tell how many ids of the group are smaller
than a given one, which is the leaf's coordinate.  From there on a node is
known by its coordinate: parents are grouped by ``coordinate div fanout`` and
put their children into an array by ``coordinate mod fanout``.  Going down
again, each array meets the array above it, which gives every leaf the
siblings on its way to the root.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import assign_keys, range_count
from ..operators.lookups import sized_broadcast
from ..sources.sinks import stage_table
from . import bitmaps

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves that one task looks up at once.
LOOK_UP = 50_000
#: The chunk of rows without an id, before that of any id.
NO_ID = -(1 << 47) - 1
STEPS = "array<struct<left:string,right:string>>"


def leaf_hash(fields: list[Column]) -> Column:
    """sha256, in lowercase hex, of the fields: ``-`` for null, else byte count, colon, value."""
    texts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _chunked(df: DataFrame) -> DataFrame:
    """With ``chunk`` and ``place`` of ``doc_id``; rows without an id share one place."""
    chunk = F.coalesce(F.shiftright("doc_id", 16), F.lit(NO_ID))
    return df.withColumn("chunk", chunk).withColumn("place", F.coalesce(F.col("doc_id").bitwiseAND(F.lit(65535)), F.lit(0)).cast("int"))


def _runs(codes: np.ndarray, chunks: np.ndarray):
    """Row numbers of each (code, chunk)."""
    order = np.lexsort((chunks, codes))
    if not len(order):
        return
    new = (np.diff(codes[order]) != 0) | (np.diff(chunks[order]) != 0)
    yield from np.split(order, np.nonzero(new)[0] + 1)


SETS = "g string, chunk long, ids binary, repeats array<long>"


def _partial_sets(ids: DataFrame) -> DataFrame:
    """Bitmaps of the ids in each Arrow batch.  ``repeats`` holds place, extra copies, place, ..."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column(0).dictionary_encode()
            chunk, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            out = []
            for rows in _runs(g.indices.to_numpy(zero_copy_only=False), chunk):
                places, counts = np.unique(place[rows], return_counts=True)
                many = counts > 1
                out.append((g.dictionary[g.indices[int(rows[0])].as_py()].as_py(), int(chunk[rows[0]]), bitmaps.pack(places),
                            np.stack([places[many], counts[many] - 1], 1).ravel().astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True)], ["g", "chunk", "ids", "repeats"])

    return ids.select("g", "chunk", "place").mapInArrow(run, SETS)


def _merged_sets(partial: DataFrame, buckets: int) -> DataFrame:
    """One set for each group and chunk, with its directory and its number of rows."""

    def run(table: pa.Table) -> pa.Table:
        found: dict = {}
        for g, chunk, ids, repeats in zip(*(table.column(k).to_pylist() for k in range(4)), strict=True):
            found.setdefault((g, chunk), []).append((ids, repeats))
        out = []
        for (g, chunk), parts in found.items():
            ids = bitmaps.merge([x for x, _ in parts])
            # An id counts once for each part that has it, and once more for each repeat in it.
            places = np.concatenate([bitmaps.places_of(x) for x, _ in parts])
            extra = np.concatenate([np.asarray(r, np.int64) for _, r in parts]).reshape(-1, 2)
            counts = np.bincount(places, minlength=bitmaps.PLACES)
            np.add.at(counts, extra[:, 0], extra[:, 1])
            many = np.nonzero(counts > 1)[0]
            out.append((g, chunk, ids, bitmaps.directory(ids), np.stack([many, counts[many] - 1], 1).ravel(), int(counts.sum())))
        cols = list(zip(*out, strict=True))
        types = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["g", "chunk", "ids", "before", "repeats", "n"])

    bucket = F.pmod(F.xxhash64("g", "chunk"), F.lit(buckets))
    keyed = partial.select("g", "chunk", "ids", "repeats", bucket.alias("b"))
    return keyed.groupBy("b").applyInArrow(run, SETS.replace("ids binary", "ids binary, before binary") + ", n long")


def _offsets(sets: DataFrame) -> DataFrame:
    """``g, chunk, base`` (rows of the group in earlier chunks), ``size`` (of the group)."""
    totals = sets.select("g", "chunk", "n")
    parts = range_count(sets.sparkSession, totals.count())
    totals = stage_table(totals.repartitionByRange(parts, "g", "chunk").withColumn("part", F.spark_partition_id()), "chunks")
    by_part = totals.groupBy("g", "part").agg(F.sum("n").alias("m"))
    group = Window.partitionBy("g")
    by_part = by_part.select("g", "part", F.sum("m").over(group).alias("size"),
                             (F.sum("m").over(group.orderBy("part")) - F.col("m")).alias("start"))
    inside = F.sum("n").over(Window.partitionBy("part", "g").orderBy("chunk")) - F.col("n")
    placed = totals.withColumn("inside", inside).join(by_part, ["g", "part"])
    return placed.select("g", "chunk", (F.col("start") + F.col("inside")).alias("base"), "size")


def coordinates(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``g, doc_id, leaf``, more) with ``pos`` (from 0, by id within ``g``) and ``size`` (leaves of ``g``).

    Rows without an id come first; rows that share an id are ordered by leaf.
    """
    kept = leaves.columns
    rows = _chunked(leaves)
    buckets = max(1, -(-leaves.count() // LOOK_UP))
    sets = stage_table(_merged_sets(_partial_sets(rows), buckets), "sets")
    index = stage_table(sets.join(_offsets(sets), ["g", "chunk"]), "index")

    # A chunk of very many rows (copies of an id) is looked up by several tasks.
    salts = F.ceil(F.col("n") / (2 * LOOK_UP)).cast("int")
    hot = index.where(F.col("n") > 2 * LOOK_UP).select("g", "chunk", salts.alias("salts"))
    rows = rows.join(sized_broadcast(hot), ["g", "chunk"], "left")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("leaf", F.monotonically_increasing_id()), F.coalesce("salts", F.lit(1))).cast("int"))
    index = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)))
    bucket = F.pmod(F.xxhash64("g", "chunk", "salt"), F.lit(buckets)).alias("b")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {(g, c): k for k, (g, c) in enumerate(zip(right["g"].to_pylist(), right["chunk"].to_pylist(), strict=True))}
        pos, size, copies = (np.zeros(len(left), np.int64) for _ in range(3))
        g = left["g"].combine_chunks().dictionary_encode()
        chunk, place = (left[c].to_numpy() for c in ("chunk", "place"))
        for at in _runs(g.indices.to_numpy(zero_copy_only=False), chunk):
            k = known[g.dictionary[g.indices[int(at[0])].as_py()].as_py(), int(chunk[at[0]])]
            ids, before, base, of = (right[c][k].as_py() for c in ("ids", "before", "base", "size"))
            many, more = np.asarray(right["repeats"][k].as_py(), np.int64).reshape(-1, 2).T
            earlier = np.concatenate([[0], np.cumsum(more)])[np.searchsorted(many, place[at])]
            pos[at], size[at] = base + bitmaps.ranks(ids, before, place[at]) + earlier, of
            if len(many):
                copies[at] = np.isin(place[at], many)
        out = left.select(kept)
        for name, values in (("pos", pos), ("size", size), ("copies", copies)):
            out = out.append_column(name, pa.array(values))
        return out

    schema = ", ".join(f"`{c}` {t}" for c, t in leaves.dtypes) + ", pos long, size long, copies long"
    placed = rows.select(*kept, "chunk", "place", bucket).groupBy("b").cogroup(
        index.select("g", "chunk", "ids", "before", "repeats", "base", "size", bucket).groupBy("b")).applyInArrow(run, schema)
    placed = stage_table(placed, "placed")
    # Rows that share an id: all stand at the first one's coordinate so far.
    shared = placed.where("copies > 0")
    if shared.isEmpty():
        return placed.drop("copies")
    shared = stage_table(assign_keys(shared, "k", [F.col("g").asc(), F.col("pos").asc(), F.col("leaf").asc()]), "shared")
    first = sized_broadcast(shared.groupBy("g", "pos").agg(F.min("k").alias("k0")))
    shared = shared.join(first, ["g", "pos"]).withColumn("pos", F.expr("pos + k - k0"))
    return placed.where("copies = 0").select(*kept, "pos", "size").unionByName(shared.select(*kept, "pos", "size"))


def _levels(nodes: DataFrame, most: int, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of every level, lowest first, and the last node of each group (``g, hash``).

    ``nodes`` are ``g, pos, size, hash`` and, in the lowest level, ``more`` for the arrays to carry.
    """
    levels, tops = [], nodes.where("size = 1").select("g", "hash")
    while most > 1:
        more = ["more"] if "more" in nodes.columns else []
        slot = F.struct(F.pmod("pos", F.lit(fanout)).cast("int").alias("slot"), "hash", *more)
        arrays = nodes.where("size > 1").groupBy("g", F.expr(f"pos div {fanout}").alias("up")).agg(
            F.max("size").alias("size"), F.sort_array(F.collect_list(slot)).alias("slots"))
        arrays = stage_table(arrays, f"level{len(levels)}")
        levels.append(arrays)
        nodes = arrays.select("g", F.col("up").alias("pos"), F.expr(f"(size + {fanout - 1}) div {fanout}").alias("size"),
                              F.sha2(F.array_join("slots.hash", "").cast("binary"), 256).alias("hash"))
        tops = tops.unionByName(nodes.where("size = 1").select("g", "hash"))
        most = -(-most // fanout)
    return levels, tops


def _step(slots: str, slot: str) -> Column:
    side = "array_join(transform(filter({a}, node -> node.slot {op} {b}), node -> node.hash), '')"
    return F.expr(f"named_struct('left', {side.format(a=slots, op='<', b=slot)}, 'right', {side.format(a=slots, op='>', b=slot)})")


def _above(levels: list[DataFrame], tops: DataFrame, fanout: int) -> list[DataFrame]:
    """Each level's slot arrays with the steps from their node to the root, lowest first.

    ``tops`` gives ``g``, the steps above the group's last node, and what else all its leaves get.
    """
    out: list[DataFrame] = []
    above, extra = None, [c for c in tops.columns if c not in ("g", "steps")]
    for arrays in reversed(levels):
        last = arrays.where(f"size <= {fanout}").join(tops, "g")
        if above is not None:
            up = above.select("g", F.col("up").alias("up2"), F.col("slots").alias("slots2"), "steps", *extra)
            lower = arrays.where(f"size > {fanout}").withColumn("up2", F.expr(f"up div {fanout}")).join(up, ["g", "up2"])
            lower = lower.withColumn("steps", F.concat(F.array(_step("slots2", f"up % {fanout}")), "steps"))
            last = last.select("g", "up", "slots", "steps", *extra).unionByName(lower.select("g", "up", "slots", "steps", *extra))
        above = last.select("g", "up", "slots", "steps", *extra)
        out.append(above)
    return out[::-1]


def manifest(docs: DataFrame, altered: Column | None = None, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
             group_col: str = "source", text_col: str = "text", fanout: int = 16) -> DataFrame:
    """One row per input row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, position``.

    ``subroot`` is the root of the row's group, ``root`` that of the dataset;
    ``proof_sha256`` the hash of the siblings of the row's way up, level by
    level, left to right; ``position`` the leaf's coordinate in its group.
    ``altered`` is the text that a check finds in place of the row's own
    (null: its own); ``folded_root`` is what that leaf and the original
    siblings give, ``verified`` whether it is the root.

    A null field is hashed as ``-``.  Rows without a group are a group of
    their own, the first; rows without an id are the first leaves of their
    group.  Rows that share an id are ordered by leaf; equal rows take
    places one after another.  An empty table gives an empty result.  Texts
    of any length are hashed whole; columns that are not ``fields`` are not read.
    """
    def leaf(text: Column) -> Column:
        return leaf_hash([text if c == text_col else F.col(f"`{c}`") for c in fields])

    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit(""))
    changed = F.lit(None).cast("string") if altered is None else F.when(altered.isNotNull(), leaf(altered))
    leaves = docs.select(group.alias("g"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         leaf(F.col(f"`{text_col}`")).alias("leaf"), changed.alias("changed"))
    placed = stage_table(coordinates(stage_table(leaves, "leaves")), "leaves")
    sizes = placed.agg(F.max("size")).first()[0] or 0
    nodes = placed.select("g", "pos", "size", F.col("leaf").alias("hash"), F.struct("doc_id", "changed", "pos").alias("more"))
    levels, tops = _levels(nodes, sizes, fanout)
    # The groups' roots are the leaves of the last tree.
    tops = stage_table(assign_keys(tops.select(F.col("g").alias("name"), "hash"), "pos", [F.col("name").asc()], start=0), "subroots")
    groups = tops.count()
    last = tops.select(F.lit("").alias("g"), "pos", F.lit(groups).cast("long").alias("size"), "hash", F.struct("name").alias("more"))
    upper, root = _levels(last, groups, fanout)
    root = root.select("g", F.col("hash").alias("root"), F.expr(f"cast(array() as {STEPS})").alias("steps"))
    if upper:
        rows = _above(upper, root, fanout)[0].select("root", "steps", "slots", F.explode("slots").alias("x"))
        named = rows.select(F.col("x.more.name").alias("g"), F.col("x.hash").alias("subroot"), "root",
                            F.concat(F.array(_step("slots", "x.slot")), "steps").alias("steps"))
    else:
        named = tops.select(F.col("name").alias("g"), F.col("hash").alias("subroot"), F.col("hash").alias("root"),
                            F.expr(f"cast(array() as {STEPS})").alias("steps"))
    named = stage_table(named, "groups")

    alone = placed.where("size = 1").join(named, "g").select(
        "doc_id", "leaf", "changed", "pos", "subroot", "root", "steps", F.lit("").alias("near"), F.expr("cast(null as struct<left:string,right:string>)").alias("step"))
    if levels:
        rows = _above(levels, named, fanout)[0].select("subroot", "root", "steps", "slots", F.explode("slots").alias("x"))
        rows = rows.select("x.more.doc_id", F.col("x.hash").alias("leaf"), "x.more.changed", "x.more.pos", "subroot", "root", "steps",
                           _step("slots", "x.slot").alias("step")).withColumn("near", F.concat("step.left", "step.right"))
        alone = alone.unionByName(rows)
    fold = F.expr("aggregate(steps, CASE WHEN step IS NULL THEN start ELSE sha2(cast(concat(step.left, start, step.right) AS binary), 256) END,"
                  " (a, s) -> sha2(cast(concat(s.left, a, s.right) AS binary), 256))")
    far = F.expr("array_join(transform(steps, s -> concat(s.left, s.right)), '')")
    out = alone.withColumn("start", F.coalesce("changed", "leaf"))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.concat("near", far).cast("binary"), 256).alias("proof_sha256"),
                      fold.alias("folded_root"), F.col("pos").alias("position")).withColumn("verified", F.col("folded_root") == F.col("root"))
