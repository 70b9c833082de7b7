"""Removal of byte strings that an earlier document has, by suffix arrays of shards.

Every window of ``n`` bytes is assigned to its *anchor*, the substring of
``ANCHOR`` bytes in it with the least hash, so equal windows have equal
anchors.  Windows of one anchor that follow each other are one piece.

1. Documents are dealt to groups.  A group sends every distinct anchor it
   has, packed, to a bucket; a bucket answers with those that several texts
   have.  An anchor that only one text has can hold no shared window.
2. Pieces of shared anchors go to the shard of their anchor.  Pieces that are
   equal within a group are sent once: the later documents' are settled
   already.  However frequent a string is, a shard gets it once a group.
3. A shard collapses equal pieces, builds suffix arrays (Larsson-Sadakane)
   and common prefixes (Kasai) of what is left, merges slices by binary
   search, and finds the least document of every window.
4. What was found is gathered by group and cut from the texts.

Steps 1 to 3 only ever drop what no other text has; nothing is sampled.  All
of it is one plan, in which the texts are shuffled once, by group, and that
exchange is read three times.  A document goes by its number in its group's
order, which follows from the group's rows alone, so a recomputed task gives
the same numbers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .suffix_array import least_owner

ANCHOR = 24
_ODD = 0x9E3779B97F4A7C15


class Rolling:
    """64-bit hashes of all substrings of one length, from prefix sums of powers."""

    def __init__(self, seed: int = 17):
        self.table = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.power = self.back = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        def powers(base: int) -> np.ndarray:
            out, step = np.ones(1, np.uint64), np.uint64(base)
            while len(out) < n:
                out = np.concatenate([out, out * step])
                step = step * step
            return out

        with np.errstate(over="ignore"):
            self.power, self.back = powers(_ODD), powers(pow(_ODD, -1, 1 << 64))

    def __call__(self, text: np.ndarray, length: int) -> np.ndarray:
        n = len(text)
        if len(self.power) < n + 1:
            self._grow(n + 1)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.table[text] * self.power[:n], out=sums[1:])
        h = (sums[length:] - sums[:-length]) * self.back[:n - length + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h


def pieces(text: np.ndarray, rolling: Rolling, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor's hash) of the pieces of a text of ``n`` bytes or more."""
    anchor = min(ANCHOR, n)
    h = rolling(text, anchor)
    span = n - anchor + 1
    # The upper half decides which is least, the leftmost of equals.
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:-(span - width)], low[span - width:])
    at = low & np.uint64(0xFFFFFFFF)
    first = np.nonzero(np.concatenate([[True], at[1:] != at[:-1]]))[0]
    last = np.append(first[1:], len(at)) - 1
    return first, last, h[at[first].astype(np.int64)]


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of an anchor; independent of its lower half, which is its key there."""
    return (((h * np.uint64(0xA24BAED4963EE407)) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _split(which: np.ndarray, *columns: np.ndarray):
    """(number, columns' parts) for every number in ``which``."""
    order = np.argsort(which, kind="stable")
    which = which[order]
    first = np.nonzero(np.concatenate([[True], which[1:] != which[:-1]]))[0] if len(which) else np.empty(0, np.int64)
    end = np.append(first[1:], len(which))
    columns = [c[order] for c in columns]
    for a, b in zip(first, end, strict=True):
        yield int(which[a]), [c[a:b] for c in columns]


def _table(names_types: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(names_types)
    return pa.table([pa.array(c, t) for c, (_, t) in zip(cols, names_types, strict=True)], [x for x, _ in names_types])


class Group:
    """The texts of one group of documents that are long enough, each distinct one once."""

    def __init__(self, table: pa.Table, n: int):
        self.n, self.rolling = n, Rolling()
        least: dict[bytes, int] = {}
        ids, texts = table.column("_id"), table.column("_text")
        for at in range(0, table.num_rows, 256):
            for d, x in zip(ids.slice(at, 256).to_pylist(), texts.slice(at, 256).to_pylist(), strict=True):
                raw = (x or "").encode("utf-8", "surrogatepass")
                if d is not None and len(raw) >= n:
                    least[raw] = min(d, least.get(raw, d))
        #: (the least id that has it, text); a text's number is its place here.
        self.texts = sorted((d, raw) for raw, d in least.items())

    def pieces(self):
        for d, raw in self.texts:
            yield d, raw, *pieces(np.frombuffer(raw, np.uint8), self.rolling, self.n)


def _anchors(n: int, buckets: int):
    """Group -> a row per bucket: its anchors' keys, and those that several texts of the group have."""
    kind = [("_group", pa.int32()), ("bucket", pa.int32()), ("one", pa.binary()), ("many", pa.binary())]

    def run(table: pa.Table) -> pa.Table:
        rows, group = [], table.column("_group")[0].as_py()
        found = [np.unique(h) for *_, h in Group(table, n).pieces()]
        if found:
            h, times = np.unique(np.concatenate(found), return_counts=True)
            for b, (keys, t) in _split(_bucket(h, buckets), h.astype(np.uint32), times):
                rows.append((group, b, np.unique(keys[t == 1]).tobytes(), np.unique(keys[t > 1]).tobytes()))
        return _table(kind, rows)

    return run, "_group int, bucket int, one binary, many binary"


def _shared():
    """Bucket -> a row per group that has any: the keys that several texts have."""
    kind = [("_group", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary())]

    def run(table: pa.Table) -> pa.Table:
        groups, bucket = table.column("_group").to_pylist(), table.column("bucket")[0].as_py()
        one, many = ([np.frombuffer(x, np.uint32) for x in table.column(c).to_pylist()] for c in ("one", "many"))
        keys, times = np.unique(np.concatenate([*(np.union1d(a, b) for a, b in zip(one, many, strict=True)), *many]), return_counts=True)
        keys = keys[times > 1]
        rows = []
        for g, a, b in zip(groups, one, many, strict=True):
            own = np.intersect1d(np.union1d(a, b), keys, assume_unique=True)
            if len(own):
                rows.append((g, bucket, own.tobytes()))
        return _table(kind, rows)

    return run, "_group int, bucket int, keys binary"


_FOUND = [("_group", pa.int32()), ("shard", pa.int32()), ("pieces", pa.binary()), ("spans", pa.binary())]
_FOUND_SQL = "_group int, shard int, pieces binary, spans binary"


def _packed(*columns: bytes) -> bytes:
    """Columns of bytes in one compressed value."""
    head = np.array([len(columns), *map(len, columns)], "<u8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(columns))


def _unpacked(value: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    k = int(np.frombuffer(raw, "<u8", 1)[0])
    ends = np.cumsum([8 * (k + 1), *np.frombuffer(raw, "<u8", k, 8).tolist()]).tolist()
    return [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _pack_spans(number: np.ndarray, start: np.ndarray, size: np.ndarray) -> bytes:
    return _packed(*(x.astype("<u4").tobytes() for x in (number, start, size)))


def _pieces(n: int, buckets: int, shards: int):
    """Group and its shared anchors -> its pieces by shard, and, at any shard, the spans settled here."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if not left.num_rows or not right.num_rows:
            return _table(_FOUND, rows)
        group = left.column("_group")[0].as_py()
        keys = [np.frombuffer(k, np.uint32).astype(np.uint64) | np.uint64(b << 32)
                for b, k in zip(right.column("bucket").to_pylist(), right.column("keys").to_pylist(), strict=True)]
        shared = np.sort(np.concatenate(keys))
        holder: dict[bytes, int] = {}
        sent: list[tuple[int, int, int, int, bytes]] = []
        settled: list[tuple[int, int, int]] = []
        for number, (d, raw, first, last, h) in enumerate(Group(left, n).pieces()):
            which = _bucket(h, buckets)
            full = (which << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
            spot = np.minimum(np.searchsorted(shared, full), len(shared) - 1)
            ok = np.nonzero(shared[spot] == full)[0]
            shard = _bucket(h[ok] ^ np.uint64(_ODD), shards).astype(np.int64)
            for a, b, s in zip(first[ok].tolist(), (last[ok] + n).tolist(), shard.tolist(), strict=True):
                x = raw[a:b]
                if holder.setdefault(x, d) < d:
                    settled.append((number, a, b - a))
                else:
                    sent.append((s, number, d, a, x))
        if settled:
            rows.append((group, group % shards, None, _pack_spans(*(np.array(c, np.int64) for c in zip(*settled, strict=True)))))
        if sent:
            which, k, d, a, x = zip(*sent, strict=True)
            for s, (ki, di, ai, at) in _split(np.array(which), *(np.array(c, np.int64) for c in (k, d, a)), np.arange(len(x))):
                own = [x[i] for i in at]
                sizes = np.fromiter(map(len, own), "<u4", len(own))
                rows.append((group, s, _packed(ki.astype("<u4").tobytes(), di.tobytes(), ai.astype("<u4").tobytes(),
                                               sizes.tobytes(), b"".join(own)), None))
        return _table(_FOUND, rows)

    return run, _FOUND_SQL


def _settle(n: int, slice_bytes: int):
    """Shard -> the spans to remove, by group."""

    def run(table: pa.Table) -> pa.Table:
        rows = [(r["_group"], -1, None, r["spans"]) for r in table.select(["_group", "spans"]).to_pylist() if r["spans"]]
        groups, numbers, ids, starts, strings = [], [], [], [], []
        for r in table.select(["_group", "pieces"]).to_pylist():
            if not r["pieces"]:
                continue
            k, d, a, sizes, text = _unpacked(r["pieces"])
            numbers.append(np.frombuffer(k, "<u4").astype(np.int64))
            ids.append(np.frombuffer(d, np.int64))
            starts.append(np.frombuffer(a, "<u4").astype(np.int64))
            groups.append(np.full(len(ids[-1]), r["_group"], np.int64))
            ends = np.cumsum(np.frombuffer(sizes, "<u4")).tolist()
            strings += [text[x:y] for x, y in zip([0, *ends], ends, strict=False)]
        if not strings:
            return _table(_FOUND, rows)
        groups, numbers, ids, starts = (np.concatenate(c) for c in (groups, numbers, ids, starts))
        place: dict[bytes, int] = {}
        of = np.fromiter((place.setdefault(x, len(place)) for x in strings), np.int64, len(strings))
        owner = np.full(len(place), np.iinfo(np.int64).max)
        np.minimum.at(owner, of, ids)
        distinct = list(place)
        least = least_owner(distinct, owner, n, slice_bytes)
        out: list[tuple[int, int, int, int]] = []
        for i, s in enumerate(of.tolist()):
            g, k, d, a = int(groups[i]), int(numbers[i]), int(ids[i]), int(starts[i])
            if owner[s] < d:
                out.append((g, k, a, len(distinct[s])))
                continue
            gone = np.nonzero(least[s] < d)[0]
            if len(gone):
                cut = np.nonzero(np.diff(gone) > 1)[0]
                for lo, hi in zip(gone[np.append(0, cut + 1)].tolist(), gone[np.append(cut, len(gone) - 1)].tolist(), strict=True):
                    out.append((g, k, a + lo, hi - lo + n))
        if out:
            g, *cols = (np.array(c, np.int64) for c in zip(*out, strict=True))
            rows += [(which, -1, None, _pack_spans(*part)) for which, part in _split(g, *cols)]
        return _table(_FOUND, rows)

    return run, _FOUND_SQL


def _spans(table: pa.Table) -> dict[int, np.ndarray]:
    """Text's number -> its spans, joined where they meet, as rows of (start, end)."""
    if not table.num_rows:
        return {}
    parts = [[np.frombuffer(c, "<u4").astype(np.int64) for c in _unpacked(x)] for x in table.column("spans").to_pylist()]
    k, a, z = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((a, k))
    k, a, end = k[order], a[order], (a + z)[order]
    out = {}
    first = np.nonzero(np.concatenate([[True], k[1:] != k[:-1]]))[0]
    for lo, hi in zip(first, np.append(first[1:], len(k)), strict=True):
        s, e = a[lo:hi], np.maximum.accumulate(end[lo:hi])
        new = np.concatenate([[True], s[1:] > e[:-1]])
        out[int(k[lo])] = np.column_stack([s[new], e[np.append(np.nonzero(new)[0][1:] - 1, len(e) - 1)]])
    return out


def kept_bytes(raw: bytes, spans: np.ndarray | None) -> bytes:
    if spans is None:
        return raw
    edges = [0, *spans.ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def remove_repeats(docs: DataFrame, n: int = 50, id_col: str = "doc_id", text_col: str = "text", text_out: bool = False,
                   size_col: str | None = None, group_bytes: int = 8 << 20, bucket_bytes: int = 32 << 20,
                   shard_bytes: int = 1 << 20, slice_bytes: int = 1 << 20) -> DataFrame:
    """Remove every byte covered by an ``n``-byte string that also starts in a document with a smaller id.

    Texts are taken as UTF-8 bytes; matches never cross documents, and
    strings are judged on the input.  Returns one row per input row:
    ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs),
    ``kept_sha256`` (of the remaining bytes); or, with ``text_out``, the
    input's columns with the remaining text (a character that a cut splits
    goes as a whole) and its length in ``size_col``, if named.

    Null texts count as empty (and, with ``text_out``, stay null); texts
    shorter than ``n`` bytes lose nothing.  Rows with a null id have no place
    in the order: they keep all, and cause no removal.  Rows that share an id
    cause none in each other; repeated rows get the same result each.  Ids are
    integers.  An empty table gives an empty result.

    ``group_bytes``, ``bucket_bytes`` and ``shard_bytes`` are text bytes per
    group of documents, anchor bucket and shard of pieces; their numbers grow
    with the input.  ``slice_bytes`` bounds a suffix array.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col)).cast("long")), F.lit(0))).first()[0]
    groups = max(64, -(-total // group_bytes))
    buckets, shards = max(16, -(-total // bucket_bytes)), max(64, -(-total // shard_bytes))
    names = docs.columns if text_out else []
    group = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(groups)).cast("int")
    wide = docs.select(group.alias("_group"), F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"),
                       *(F.col(c).alias(f"_c{i}") for i, c in enumerate(names) if c != text_col)).groupBy("_group")
    run, kind = _anchors(n, buckets)
    anchors = wide.applyInArrow(run, kind)
    run, kind = _shared()
    shared = anchors.groupBy("bucket").applyInArrow(run, kind)
    run, kind = _pieces(n, buckets, shards)
    found = wide.cogroup(shared.groupBy("_group")).applyInArrow(run, kind)
    run, kind = _settle(n, slice_bytes)
    spans = found.groupBy("shard").applyInArrow(run, kind)
    if text_out:
        kind = ", ".join(f"_c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    else:
        kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        cuts = _spans(right)
        number = {raw: (k, d) for k, (d, raw) in enumerate(Group(left, n).texts)}
        rows: list[tuple] = []
        for at in range(0, left.num_rows, 256):
            ids, texts = (left.column(c).slice(at, 256).to_pylist() for c in ("_id", "_text"))
            for d, text in zip(ids, texts, strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                k, least = number.get(raw, (-1, d)) if d is not None else (-1, d)
                gone = np.array([[0, len(raw)]]) if least != d else cuts.get(k)
                kept = kept_bytes(raw, gone)
                if text_out:
                    rows.append((text if gone is None else kept.decode("utf-8", "ignore"),))
                else:
                    rows.append((d, len(raw), len(raw) - len(kept), 0 if gone is None else len(gone), hashlib.sha256(kept).hexdigest()))
        if not text_out:
            return _table([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
                           ("kept_sha256", pa.string())], rows)
        new = [r[0] for r in rows]
        cols = []
        for i, c in enumerate(names):
            old = left.column("_text" if c == text_col else f"_c{i}")
            if c == text_col:
                old = pa.array(new, old.type)
            elif c == size_col:
                old = pa.array([s if x is None else len(x) for x, s in zip(new, old.to_pylist(), strict=True)], old.type)
            cols.append(old)
        return pa.table(cols, [f"_c{i}" for i in range(len(names))])

    out = wide.cogroup(spans.groupBy("_group")).applyInArrow(cut, kind)
    return out.toDF(*names) if text_out else out
