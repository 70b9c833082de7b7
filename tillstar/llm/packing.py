"""Cost-balanced packing of documents into token sequences.

A piece of ``n`` tokens costs ``linear * n + quadratic * n * n``: the dense
layers see every token once, attention sees every pair within a piece.
Full-length cuts of long documents are sequences by themselves.  The rest are
sorted by length, longest first, and each goes to the cheapest sequence that
still has room; one that fits nowhere is cut at the room of the cheapest
sequence that has any.

Texts are tokenised where they are read.  A task holds back at most ``hold``
pieces, packs them, writes them out and goes on, so there is no shuffle, and
memory does not grow with the input.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import texts_in_steps


def sequences_for(sizes: list[int], capacity: int, linear: float, quadratic: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(piece, start in it, length, sequence, offset), for pieces of at most ``capacity`` tokens.

    As many sequences as the tokens need; every one but for the last few
    tokens of all is filled to the brim.
    """
    total = sum(sizes)
    m = -(-total // capacity)
    room, cost = np.full(m, capacity, np.int64), np.zeros(m)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at, left = 0, sizes[i]
        while left:
            fits = np.where(room >= left, cost, np.inf)
            s = int(np.argmin(fits))
            if fits[s] == np.inf:
                s = int(np.argmin(np.where(room > 0, cost, np.inf)))
            n = min(left, int(room[s]))
            yield i, at, n, s, capacity - int(room[s])
            room[s] -= n
            cost[s] += linear * n + quadratic * n * n
            at, left = at + n, left - n


#: Characters from which a text goes to the JSON form's encoder.
LONG_TEXT = 200_000


def tokenizer(path: str | None = None):
    """Texts -> lists of ids of the byte-level BPE vocabulary ``byte_bpe_50k.json``.

    ``path`` names the vocabulary's rank form; the JSON form lies beside it.
    The encoder of the rank form gives the same ids in a quarter of the time;
    as the JSON form does, it reads the end-of-text mark in a text as its id.
    It fails on runs of a million like characters, so long texts go to the
    encoder of the JSON form.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                            special_tokens={"<|endoftext|>": 50256})
    whole: list = []

    def encode(text: str) -> list[int]:
        if len(text) < LONG_TEXT:
            return enc.encode(text, allowed_special="all", disallowed_special=())
        if not whole:
            whole.append(Tokenizer.from_file(path.removesuffix(".tiktoken") + ".json"))
        return whole[0].encode(text, add_special_tokens=False).ids

    return encode


SCHEMA = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_cost double")


def pack(docs: DataFrame, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text",
         end_id: int = 0, linear: float = 1.0, quadratic: float = 1.0 / 1024, hold: int = 4096,
         vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: ``doc_id, start`` (the document's ids before
    it), ``length, ids_crc32`` (of its ids as little-endian unsigned 32-bit
    numbers), ``doc_tokens`` (with the end id that closes every document),
    ``sequence_id`` (unique, not gapless), ``offset`` (in the sequence,
    gapless), ``sequence_cost`` and, ``with_ids``, ``ids array<int>``.

    Null and empty texts are documents of the end id alone.  Null ids and
    repeated rows are documents like any other; an empty table gives an empty
    result.  Very long texts are cut into as many full sequences as they
    fill.  Each time a task packs, fewer than ``capacity`` tokens of padding
    are left, once per ``hold`` pieces or end of its input.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"),
                         F.spark_partition_id().cast("long").alias("_part"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encode = tokenizer(vocabulary)
        tails: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        done: list[tuple] = []
        count = part = 0
        doc_type = None

        def emit(piece, at, n, offset, cost):
            doc, start, ids, of = piece
            ids = ids[at:at + n]
            done.append((doc, start + at, n, zlib.crc32(ids.tobytes()), of, (part << 36) + count, offset, cost,
                         ids.astype(np.int32) if with_ids else None))

        def flush():
            nonlocal count
            placed = list(sequences_for([len(x[2]) for x in tails], capacity, linear, quadratic))
            costs: dict[int, float] = {}
            for _, _, n, s, _ in placed:
                costs[s] = costs.get(s, 0.0) + linear * n + quadratic * n * n
            base = count
            for i, at, n, s, offset in placed:
                count = base + s
                emit(tails[i], at, n, offset, costs[s])
            count = base + len(costs)
            tails.clear()

        def out():
            cols = list(zip(*done, strict=True)) if done else [[]] * 9
            done.clear()
            types = [doc_type, *[pa.int64()] * 6, pa.float64(), pa.list_(pa.int32())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_cost", "ids"]
            k = 9 if with_ids else 8
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:k], types[:k], strict=True)], names[:k])

        for batch in batches:
            doc_type = batch.schema.field(0).type
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            for at, texts in texts_in_steps(batch, "_text"):
                for doc, text in zip(batch.column(0).slice(at, len(texts)).to_pylist(), texts, strict=True):
                    ids = np.array([*encode(text), end_id], "<u4")
                    whole = len(ids) // capacity * capacity
                    for start in range(0, whole, capacity):
                        emit((doc, start, ids[start:start + capacity], len(ids)), 0, capacity, 0,
                             linear * capacity + quadratic * capacity * capacity)
                        count += 1
                    if whole < len(ids):
                        tails.append((doc, whole, ids[whole:].copy(), len(ids)))
                        if len(tails) >= hold:
                            flush()
                if len(done) >= 20_000:
                    yield out()
        if tails:
            flush()
        if done:
            yield out()

    return narrow.mapInArrow(run, f"doc_id {kind}, {SCHEMA}" + (", ids array<int>" if with_ids else ""))
