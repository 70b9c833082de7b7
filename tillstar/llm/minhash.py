"""Near-duplicates by one-permutation hashing with optimal densification.

A document's shingles are hashed once; the hash's leading part deals them to
``bands * rows`` bins, and a bin keeps its smallest.  An empty bin takes the
value of another one, found by a hash of its own number and the attempt, the
same for all documents, so that two sets agree in a bin with a probability
equal to their similarity.  Bins are banded; documents that agree in a band
meet in a bucket, and a bucket contributes a star: one member paired with the
others, not all pairs.  Links are confirmed on the full shingle sets.

A star may miss a link between two members that its centre is not linked to.
What the stars leave is settled exactly: members of buckets that still hold
several components are joined on their rarest shingles, as many as two sets
of that similarity must share one of.
Documents with equal sets are one class and enter all this once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stage_table
from .components import components
from .linear import texts_in_steps

ATTEMPTS = 2048
#: Parts in which a bucket's members are joined with its centre.
PARTS = 8
#: Members of one shingle's group that a task of the exact join holds.
BLOCK = 256


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles, A-Z lower-cased.

    Words are parted by ASCII white space; a text of fewer than ``width``
    words is one shingle.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = (np.concatenate([[0], ends[:-1] + 1])).tolist()
    ends = ends.tolist()
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh3_64_intdigest
    ends = ends[width - 1:] if len(words) >= width else ends[-1:]
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts, ends, strict=False)), np.uint64, n))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sketcher:
    """Shingle hashes -> one hash per band."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        i, t = np.arange(self.bins, dtype=np.uint64), np.arange(ATTEMPTS, dtype=np.uint64)[:, None]
        self.donor = (_mix((t + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + i) % np.uint64(self.bins)).astype(np.int64)
        self.odd = _mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        self.own = _mix(np.arange(101, 101 + bands, dtype=np.uint64))

    def bins_of(self, hashes: np.ndarray) -> np.ndarray:
        which = ((hashes >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        filled, first = np.unique(which, return_index=True)
        out, has = np.zeros(self.bins, np.uint64), np.zeros(self.bins, bool)
        out[filled.astype(np.int64)], has[filled.astype(np.int64)] = hashes[first], True
        empty = np.nonzero(~has)[0]
        if len(empty):
            found = np.full(len(empty), -1, np.int64)
            for lo in range(0, ATTEMPTS, 64):
                open_ = np.nonzero(found < 0)[0]
                if not len(open_):
                    break
                donors = self.donor[lo:lo + 64, empty[open_]]
                ok = has[donors]
                hit = ok.any(0)
                found[open_[hit]] = donors[ok.argmax(0)[hit], np.nonzero(hit)[0]]
            # So rare that any rule which is the same for all sets will do.
            found[found < 0] = int(np.nonzero(has)[0][0])
            out[empty] = out[found]
        return out

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        rows = self.bins_of(hashes).reshape(self.bands, self.rows)
        return _mix((_mix(rows) * self.odd).sum(1, dtype=np.uint64) + self.own).view(np.int64)


def _sketches(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        sketch = Sketcher(bands, rows)
        for batch in batches:
            ids = batch.column(0)
            for at, texts in texts_in_steps(batch, "_text"):
                sets = [shingles(x, width) for x in texts]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(at, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([sketch(s) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_key", "bands"])

    return docs.mapInArrow(run, f"doc_id {kind}, n_shingles long, set_key binary, bands array<long>")


def _full_sets(docs: DataFrame, width: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at, texts in texts_in_steps(batch, "_text"):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)),
                    pa.array([shingles(x, width).view(np.int64) for x in texts], pa.list_(pa.int64()))], ["node", "items"])

    return docs.mapInArrow(run, f"node {kind}, items array<long>")


def _with_centre(member: DataFrame, centre: DataFrame) -> DataFrame:
    """Join on bucket, the members of one bucket dealt to ``PARTS`` tasks."""
    part = F.pmod(F.xxhash64("node", F.lit(41)), F.lit(PARTS)).cast("int")
    every = centre.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return member.withColumn("part", part).join(every, ["bucket", "part"]).drop("part")


def _open_pairs(named: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``centre, node``: all pairs that may be linked, of members of one component with those of another.

    ``named`` (``bucket, node, n, component``) are the bucket members.  Any
    order of the shingles that is the same for all sets will do for a prefix
    join: those of a single component, which no pair has in common, come
    first, then the others from the rarest on.  If a pair's first common
    shingle has ``left`` shingles from itself on in either set, the pair has
    no more than the smaller ``left`` in common.
    """
    mixed = named.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("bucket")
    nodes = stage_table(_with_centre(named, mixed).select("node", "n", "component").distinct(), "open")
    items = sets.join(nodes, "node").select("node", "n", "component", F.explode("items").alias("bucket"))
    across = items.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("sets"), F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("bucket", "sets")
    common = _with_centre(items, across).groupBy("node", "n", "component").agg(
        F.sort_array(F.collect_list(F.struct("sets", "bucket"))).alias("x")).withColumn("k", F.size("x"))
    least = F.expr(f"({percent} * n + 99) div 100")
    head = common.where(F.col("k") >= least).withColumn("x", F.slice("x", F.lit(1), (F.col("k") - least + 1).cast("int")))
    head = head.select("node", "n", "component", "k", F.posexplode("x").alias("at", "x")).select(
        F.col("x.bucket").alias("item"), "node", "n", "component", (F.col("k") - F.col("at")).alias("left"))
    head = stage_table(head, "heads")
    # Pairs within the component that has most of a shingle's sets are not formed at all.
    top = head.groupBy("item", "component").agg(F.count(F.lit(1)).alias("sets")).groupBy("item").agg(
        F.max(F.struct("sets", "component")).alias("top"), F.sum("sets").alias("sets"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    top = top.select("item", F.col("top.component").alias("most"), F.ceil(F.col("sets") / BLOCK).cast("int").alias("blocks"))
    head = head.join(top, "item")
    one = head.where("component <> most").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    one = one.select("item", "block", *(F.col(c).alias(f"{c}_1") for c in ("node", "n", "component", "left")))
    block = F.pmod(F.xxhash64("node", F.lit(43)), F.col("blocks")).cast("int")
    pairs = one.join(head.withColumn("block", block), ["item", "block"]).where("component <> component_1").where(
        100 * F.least("n", "n_1") >= percent * F.greatest("n", "n_1")).where(
        (100 + percent) * F.least("left", "left_1") >= percent * (F.col("n") + F.col("n_1")))
    return pairs.select(F.greatest("node", "node_1").alias("node"), F.least("node", "node_1").alias("centre")).distinct()


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85, bands: int = 20, rows: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` % or more.

    Returns one row per input row: ``doc_id, n_shingles, component_id`` (the
    smallest id reachable over links, itself included), ``kept`` (``doc_id =
    component_id``).

    Null, empty and blank texts have no shingles and are linked with nothing;
    texts of fewer than ``width`` words are one shingle.  Rows with a null id
    link nothing: they get the component of their text, if it has one, and
    are kept if it has none.  Repeated rows stay repeated; rows that share an
    id but not a text each get the component of their own text.  An empty
    table gives an empty result.

    Two sets at the threshold of 85 % share no band with a probability below
    1e-6, at 80 % below 3e-5.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    sketches = stage_table(_sketches(plain, width, bands, rows), "sketches")
    classes = sketches.where("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "n_shingles", "bands")).alias("c"))
    classes = stage_table(classes.select("set_key", F.col("c.doc_id").alias("node"), F.col("c.n_shingles").alias("n"), "c.bands"), "classes")

    # Bucket members, only of buckets with several; ``first`` is the star's centre.
    member = classes.select("node", "n", F.explode("bands").alias("bucket"))
    centre = member.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("c"), F.count(F.lit(1)).alias("members"))
    member = _with_centre(member, centre.where("members > 1")).select(
        "bucket", "node", "n", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n"))
    member = stage_table(member, "members")
    # No two sets can be that similar if their sizes are further apart.
    sizes = 100 * F.least("n", "centre_n") >= percent * F.greatest("n", "centre_n")
    pairs = stage_table(member.where(F.col("node") != F.col("centre")).where(sizes).select("centre", "node").distinct(), "pairs")
    ends = pairs.select("node").unionByName(pairs.select(F.col("centre").alias("node")))
    # The exact step joins members that an unlike size kept out of the stars, too.
    ends = ends.unionByName(member.select("node")).distinct()
    sets = _full_sets(plain.join(ends.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"), width)
    sets = stage_table(sets, "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = sets.select("node", F.col("items").alias("x"))
        right = sets.select(F.col("node").alias("centre"), F.col("items").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        either = F.size("x") + F.size("y") - both
        return pairs.join(left, "node").join(right, "centre").where(100 * both >= percent * either).select("centre", "node")

    linked = stage_table(components(stage_table(confirmed(pairs), "links"), "centre", "node"), "components")
    named = member.select("bucket", "node", "n").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    done = pairs.select(F.greatest("centre", "node").alias("node"), F.least("centre", "node").alias("centre"))
    more = stage_table(_open_pairs(stage_table(named, "named"), sets, percent).join(done, ["node", "centre"], "left_anti"), "pairs")
    new = stage_table(confirmed(more), "links")
    if not new.isEmpty():
        # Each component is a star by now: only the new links are to be followed.
        new = new.unionByName(linked.select(F.col("component").alias("centre"), "node"))
        linked = stage_table(components(new, "centre", "node"), "components")

    found = classes.select("set_key", F.col("node").alias("rep")).join(
        linked.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_key", F.coalesce("component", "rep").alias("component"))
    out = sketches.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that stand for their groups, once each, with all their columns.

    Rows that share an id but not a text are documents of their own here.  Of
    rows that share both, the one whose columns have the smallest hash stays.
    Rows with a null id that have no component stay.
    """
    text = F.col(options.get("text_col", "text"))
    # Judged under id and text: an id alone may stand for several texts.
    own = F.when(F.col(id_col).isNotNull(), F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("text")))
    verdict = near_duplicates(docs.select(own.alias("own"), text.alias("text")), id_col="own", **options | {"text_col": "text"})
    keep = verdict.where("kept and doc_id is not null").select(F.col("doc_id").alias("own")).distinct()
    row = F.xxhash64(*(F.col(c) for c, kind in docs.dtypes if "map<" not in kind))
    named = docs.where(F.col(id_col).isNotNull()).select(own.alias("own"), row.alias("h"), F.struct(*docs.columns).alias("row"))
    named = named.join(keep, "own", "left_semi").groupBy("own").agg(F.min_by("row", "h").alias("row"))
    return named.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))
