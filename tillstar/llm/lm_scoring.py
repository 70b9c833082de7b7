"""Language-model scores of documents: causal self-attention on subword ids.

Three passes.  The words of the training documents are counted, and their
subword ids are written, all of them.  All of those ids train the model
(``attention.Model``), each once: tasks start from the same parameters, train
on their own documents, and the parameters' mean, weighted by tokens, starts
the next round.  Then every text is scored in overlapping windows, and its words
are looked up in the counts: the frequent ones, a bounded number, in every
task, the others by a join of word digests.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from dataclasses import astuple
from functools import cached_property
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stage_table
from .attention import F32, Model, Shape, one_thread

#: ASCII white space, which parts words.
SPACE = re.compile(rb"[\x20\x09-\x0d]")
#: Bytes of a text that are split at once.
PIECE = 1 << 20
#: Words that a task counts, or remembers, before it starts anew.
WORDS = 600_000
#: Ids in a row of the training texts, and windows that are shuffled together.
ROW_IDS, POOL = 1 << 16, 8192
#: Windows in a training step at most, and steps of a task's round that are worth more than larger ones.
MOST_BATCH, STEPS = 512, 200
STATE_BLOCK = 1 << 18
LEVELS = 16
#: Bytes of a long word.
LONG = 4096
CARRIED = ("rid", "doc_id", "held_out")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """A text's words, A-Z lower-cased, in lists of bounded size."""
    at = 0
    while len(text) - at > PIECE:
        cut = SPACE.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().split()
        at = end
    yield text[at:].lower().split()


def together(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """The words of texts, those of short ones in one list; the texts that they are of, and where each one's words end."""
    words, whose, ends, size = [], [], [], 0
    for i, text in enumerate(texts):
        for piece in words_of(text):
            words += piece
            whose.append(i)
            ends.append(len(words))
            size += min(len(text), PIECE)
            if size >= PIECE:
                yield words, np.array(whose), np.array(ends)
                words, whose, ends, size = [], [], [], 0
    if whose:
        yield words, np.array(whose), np.array(ends)


def _texts(batch: pa.RecordBatch, column: str, step: int = 64) -> Iterator[tuple[int, list[bytes]]]:
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    for at in range(0, len(values), step):
        yield at, [x or b"" for x in values.slice(at, step).to_pylist()]


class Grown:
    """An array that is added to at its end."""

    def __init__(self, kind):
        self.values, self.used = np.zeros(1 << 12, kind), 0

    def add(self, more: np.ndarray) -> None:
        need = self.used + len(more)
        if need > len(self.values):
            self.values = np.concatenate([self.values[:self.used], np.zeros(2 * need - self.used, self.values.dtype)])
        self.values[self.used:need] = more
        self.used = need


class Encoder:
    """Words -> numbers of words that it remembers, with the ids of each; it forgets all when it has many.

    ``path`` names the rank form of a byte-level vocabulary.  Its encoder is
    given words of moderate length; the longest go to the JSON form of the
    same vocabulary beside it, whose working space does not grow with runs
    of one kind of character.
    """

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken

        self.path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(self.path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.short = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.opens = np.zeros(max(ranks.values()) + 1, bool)
        self.opens[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.forget()

    @cached_property
    def long(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path.removesuffix(".tiktoken") + ".json")
        tokenizer.encode_special_tokens = True
        return lambda word: tokenizer.encode(word, add_special_tokens=False).ids

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.start, self.size = Grown(np.int32), Grown(np.int64), Grown(np.int64)

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words as they stand in a text, behind a blank, and how many each has."""
        texts = [w.decode("utf-8", "replace") for w in words]
        joined = " ".join(texts)
        # Together, unless a word is long or has white space that is not ASCII: only a word's first id opens with a blank.
        if max(map(len, words)) < LONG and joined.split() == texts:
            ids = np.array(self.short(" " + joined), np.int32)
            starts = np.nonzero(self.opens[ids])[0]
            if len(starts) == len(texts):
                return ids, np.diff(np.append(starts, len(ids)))
        if len(words) > 8:
            # The odd word keeps few others from going together.
            half = len(words) // 2
            (a, m), (b, n) = self._encoded(words[:half]), self._encoded(words[half:])
            return np.concatenate([a, b]), np.concatenate([m, n])
        found = [(self.short if len(w) < LONG else self.long)(" " + t) for w, t in zip(words, texts, strict=True)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers; words that it did not know get the next ones."""
        if len(self.number) > WORDS:
            self.forget()
        out = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        missing = np.nonzero(out < 0)[0]
        if len(missing):
            unknown = [words[i] for i in missing.tolist()]
            new = list(dict.fromkeys(unknown))
            ids, sizes = self._encoded(new)
            self.start.add(self.ids.used + np.cumsum(sizes) - sizes)
            self.size.add(sizes)
            self.ids.add(ids)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.learned(new)
            out[missing] = np.fromiter(map(self.number.__getitem__, unknown), np.int64, len(unknown))
        return out

    def learned(self, words: list[bytes]) -> None:
        """Called with new words, in the order of their numbers."""

    def encode(self, numbers: np.ndarray) -> np.ndarray:
        return self.parted(numbers, np.array([len(numbers)]))[0]

    def parted(self, numbers: np.ndarray, word_ends: np.ndarray) -> list[np.ndarray]:
        """The ids of the words, in parts that end after ``word_ends`` words."""
        sizes = self.size.values.take(numbers)
        ends = np.cumsum(sizes)
        at = np.repeat(self.start.values.take(numbers) - (ends - sizes), sizes)
        at += np.arange(len(at))
        return np.split(self.ids.values.take(at), np.append(0, ends)[word_ends])[:-1]


class Counting(Encoder):
    """An encoder that counts the words; ``full`` holds the digests and counts of those that it forgot."""

    def forget(self) -> None:
        self.full = getattr(self, "full", [])
        if getattr(self, "number", None):
            self.full.append(self.counts())
        super().forget()
        self.count = Grown(np.int64)

    def learned(self, words) -> None:
        self.count.add(np.zeros(len(words), np.int64))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        found = super().numbers(words)
        np.add.at(self.count.values, found, 1)
        return found

    def counts(self) -> tuple[list[bytes], np.ndarray]:
        return [xxhash.xxh3_128_digest(w) for w in self.number], self.count.values[:self.count.used].copy()


def _read(docs: DataFrame, path: str | None, end: int) -> DataFrame:
    """What the training documents hold: rows ``word`` (128-bit digest), ``c``, and rows ``h, ids, n``.

    The first count all words of ``text``, without the ends of texts; a word
    may have several.  The second are the ids of the texts whose ``h`` is not
    null, closed by ``end``, in rows of bounded size.
    """

    def run(batches):
        encoder = Counting(path)

        def table(h=(), ids=(), words=(), counts=()):
            texts, none, n = len(h), len(words), len(h) + len(words)
            cols = [pa.array([*h, *[None] * none], pa.int64()), pa.array([*(x.tobytes() for x in ids), *[None] * none], pa.binary()),
                    pa.array([*map(len, ids), *[None] * none], pa.int64()), pa.array([*[None] * texts, *words], pa.binary()),
                    pa.array([*[None] * texts, *counts], pa.int64())]
            return [pa.RecordBatch.from_arrays(cols, ["h", "ids", "n", "word", "c"])] if n else []

        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("h")).to_pylist()
            for at, texts in _texts(batch, "text"):
                out, parts = [], [[] for _ in texts]
                for words, whose, ends in together(texts):
                    for i, ids in zip(whose.tolist(), encoder.parted(encoder.numbers(words), ends), strict=True):
                        if keys[at + i] is not None:
                            parts[i].append(ids)
                for h, its in zip(keys[at:at + len(texts)], parts, strict=True):
                    if h is not None:
                        ids = np.concatenate([*its, [end]]).astype("<u2")
                        out += [(h, ids[k:k + ROW_IDS]) for k in range(0, len(ids), ROW_IDS)]
                yield from table([h for h, _ in out], [x for _, x in out])
                while encoder.full:
                    words, counts = encoder.full.pop()
                    yield from table(words=words, counts=counts.tolist())
        words, counts = encoder.counts()
        yield from table(words=words, counts=counts.tolist())

    return docs.select("h", "text").mapInArrow(run, "h long, ids binary, n long, word binary, c long")


def _head(counts: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The least count, 2 or more, of frequent words, of whom there are at most ``most``; their digests, sorted, and counts."""
    level = F.floor(F.log2("c") * LEVELS).cast("int").alias("level")
    tally = sorted(counts.groupBy(level).agg(F.count(F.lit(1)).alias("words"), F.min("c").alias("c")).collect(), reverse=True)
    least, words = 1 << 62, 0
    for row in tally:
        words += row.words
        if words > most or row.c < 2:
            break
        least = row.c
    head = counts.where(F.col("c") >= least).toArrow()
    digests = np.array(head["word"].to_pylist(), "S16")
    order = np.argsort(digests)
    return least, digests[order], head["c"].to_numpy().astype(np.int64)[order]


def _leading(digests: np.ndarray) -> np.ndarray:
    """The first 64 bits of digests, which order as these do; a search among them is several times faster."""
    return digests.view(">u8").reshape(-1, 2)[:, 0].astype(np.uint64)


def _id_counts(texts: DataFrame, ids: int) -> dict[int, int]:
    def run(batches):
        seen = np.zeros(ids, np.int64)
        for batch in batches:
            for row in batch.column(0).to_pylist():
                seen += np.bincount(np.frombuffer(row, "<u2"), minlength=ids)
        at = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], ["id", "n"])

    found = texts.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r.id: r.n for r in found.collect()}


def train(texts: DataFrame, shape: Shape, rounds: int = 4, rate: float = 0.5, batch: int = 96,
          task_tokens: int = 16_000_000) -> Model:
    """Train on ``texts`` (``h``, a hash of the row, ``ids`` and their number ``n``), all of them, once.

    A task's share is about ``task_tokens``; with more text there are more
    tasks, not larger ones.  A step takes ``batch`` windows, or more, up to
    ``MOST_BATCH``, where a task still makes ``STEPS`` steps in a round.  The driver holds one set of parameters, whose
    size depends on the vocabulary alone.
    """
    spark = texts.sparkSession
    counts = _id_counts(texts, shape.ids)
    model = Model(counts, shape)
    tokens = sum(counts.values())
    if not tokens:
        return model
    tasks = -(-tokens // task_tokens)
    batch = max(batch, min(MOST_BATCH, tokens // (tasks * rounds * shape.stride * STEPS)))
    dealt = texts.select("h", "ids", "n", F.pmod(F.xxhash64("h", F.lit(1)), F.lit(tasks)).alias("task"),
                         F.pmod(F.xxhash64("h", F.lit(2)), F.lit(rounds)).alias("round"))

    for turn in range(rounds):
        start = spark.sparkContext.broadcast((counts, astuple(shape), model.state()))

        def run(batches):
            one_thread()
            counts, sizes, state = start.value
            own, trained, held, n_held = None, 0, [], 0

            def learn():
                inputs, target, opens, _ = own.windows(held)
                held.clear()
                view = np.lib.stride_tricks.sliding_window_view(inputs, shape.stride + shape.context)[::shape.stride]
                order = np.random.default_rng(turn * 1000 + trained % 997).permutation(len(target))
                for at in range(0, len(order), batch):
                    k = order[at:at + batch]
                    own.step(view[k], target[k], opens[k], rate)

            for rows in batches:
                own = own or Model(counts, Shape(*sizes)).load(state)
                for ids in rows.column(0).to_pylist():
                    held.append(np.frombuffer(ids, "<u2"))
                    n_held += len(held[-1])
                    if n_held >= POOL * shape.stride:
                        learn()
                        trained, n_held = trained + n_held, 0
            if held:
                learn()
                trained += n_held
            if trained:
                end = own.state()
                blocks = [end[k:k + STATE_BLOCK].tobytes() for k in range(0, len(end), STATE_BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([trained] * len(blocks), pa.int64()),
                                                  pa.array(blocks, pa.binary())], ["block", "n", "state"])

        def weigh(table: pa.Table) -> pa.Table:
            total = 0.0
            for x, n in zip(table["state"].to_pylist(), table["n"].to_pylist(), strict=True):
                total = total + np.frombuffer(x, F32).astype(float) * n
            return summed(table, total)

        def add(table: pa.Table) -> pa.Table:
            return summed(table, sum(np.frombuffer(x) for x in table["sums"].to_pylist()))

        def summed(table: pa.Table, total: np.ndarray) -> pa.Table:
            return pa.table({"block": table["block"].slice(0, 1), "n": pa.array([sum(table["n"].to_pylist())], pa.int64()),
                             "sums": pa.array([total.tobytes()], pa.binary())})

        mine = dealt.where(F.col("round") == turn).repartition(tasks, "task").sortWithinPartitions("task", "h", "n").select("ids")
        sums = mine.mapInArrow(run, "block int, n long, state binary")
        # Added in two steps, so that no task gets the parameters of very many.
        sums = sums.withColumn("few", F.pmod(F.monotonically_increasing_id(), F.lit(31)))
        sums = sums.groupBy("block", "few").applyInArrow(weigh, "block int, n long, sums binary")
        rows = sums.groupBy("block").applyInArrow(add, "block int, n long, sums binary").toArrow().sort_by("block")
        start.unpersist()
        if len(rows):
            n = rows["n"][0].as_py()
            model.load((np.concatenate([np.frombuffer(x) for x in rows["sums"].to_pylist()]) / n).astype(np.float32))
    return model


def _scored(docs: DataFrame, model: Model, head: tuple[int, np.ndarray, np.ndarray], totals: tuple[int, int, int],
            path: str | None) -> DataFrame:
    """Each text's tokens, its score, its frequent words' share of the base, and its other words (``rest, rest_n``)."""
    least, digests, counts = head
    n_all, v, ends = totals
    logs = np.log10((np.append(counts, 0) + 0.5) / (n_all + 0.5 * (v + 1)))
    shared = docs.sparkSession.sparkContext.broadcast((model.counts, astuple(model.shape), model.state(), digests, logs))
    end_log = float(np.log10((ends + 0.5) / (n_all + 0.5 * (v + 1))))

    def run(batches):
        one_thread()
        counts, shape, state, digests, logs = shared.value
        leading = _leading(digests)
        model = Model(counts, Shape(*shape)).load(state)
        class Known(Encoder):
            """With the logarithm of each word's share (not a number: not a frequent word) and its digest."""

            def forget(self) -> None:
                super().forget()
                self.log, self.keys = Grown(float), Grown("S16")

            def learned(self, words) -> None:
                key = np.array([xxhash.xxh3_128_digest(w) for w in words], "S16")
                at = np.searchsorted(leading, _leading(key))
                at[at == len(digests)] = 0
                hit = digests[at] == key if len(digests) else np.zeros(len(key), bool)
                self.log.add(np.where(hit, logs[at], np.nan))
                self.keys.add(key)

        encoder = Known(path)
        for batch in batches:
            carried = [batch.column(batch.schema.get_field_index(c)) for c in CARRIED]
            for at, texts in _texts(batch, "text"):
                parts, rest = [[] for _ in texts], []
                n, known, base = np.ones(len(texts), np.int64), np.full(len(texts), int(ends > 0)), [end_log] * len(texts)
                for words, whose, word_ends in together(texts):
                    numbers = encoder.numbers(words)
                    logs_ = encoder.log.values.take(numbers)
                    other = np.nonzero(np.isnan(logs_))[0]
                    logs_[other] = 0
                    sizes = np.diff(word_ends, prepend=0)
                    for i, ids, own in zip(whose.tolist(), encoder.parted(numbers, word_ends), np.split(logs_, word_ends)[:-1], strict=True):
                        parts[i].append(ids)
                        base[i] += float(own.sum())
                    np.add.at(n, whose, sizes)
                    # A text's other words, each with how often it has it.
                    its = np.repeat(whose, sizes)[other]
                    np.add.at(known, whose, sizes)
                    np.subtract.at(known, its, 1)
                    pair, k = np.unique(its << 32 | numbers[other], return_counts=True)
                    rest.append((pair >> 32, encoder.keys.values[pair & 0xffffffff], k))
                ids = [np.concatenate([*x, [model.shape.end]]) for x in parts]
                inputs, target, opens, windows = model.windows(ids)
                per = model.score(inputs, target, opens).reshape(len(target), -1).sum(1, dtype=np.float64)
                total = np.add.reduceat(per, np.cumsum(windows) - windows) / np.log(10)
                its, keys, k = map(np.concatenate, zip(*rest, strict=True))
                order = np.argsort(its, kind="stable")
                until = pa.array(np.searchsorted(its[order], np.arange(len(texts) + 1)), pa.int32())
                keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(keys[order].tobytes())])
                rest, rest_n = (pa.ListArray.from_arrays(until, x) for x in (keys.cast(pa.binary()), pa.array(k[order], pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, len(texts)) for c in carried), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                     pa.array(total, pa.float64()), rest, rest_n],
                    [*CARRIED, "n_tokens", "n_known", "base_score", "score", "rest", "rest_n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.withColumn("rid", F.monotonically_increasing_id()).select(*CARRIED, "text").mapInArrow(
        run, f"rid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<binary>, rest_n array<long>")


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", shape: Shape | None = None,
          train_every: int = 1, head_words: int = 1_500_000, vocabulary: str | None = None, **training) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are the words of a text, parted by ASCII white space, A-Z
    lower-cased, and one end.  ``base_score`` is the text's log10 probability
    by the counts of the tokens of the rows that are not ``held_out``, with
    half a count added, ``n_known`` its tokens that occur there, and
    ``train_tokens`` how many there are.  ``score`` is the model's log10
    probability of the text: of the subword ids of its words, one after
    another, and the end.  The model is trained on all rows that are not held
    out, or, where ``train_every`` is more than 1, on every such one of them,
    by hash; ``vocabulary`` is the rank file of the tokenizer; ``training``
    goes to ``train``.

    Null and empty texts are an end alone.  A null ``held_out`` (that of a
    null id) is false.  Rows that repeat an id are scored one by one.  With
    no training rows every token has a count of 0, and the model gives all
    ids the same probability.  An empty table gives an empty result.
    """
    shape = shape or Shape()
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    learned = plain.where(~F.col("held_out"))
    row_hash = F.xxhash64(F.col("doc_id").cast("string"), "text")
    trains = F.pmod(row_hash, F.lit(train_every)) == 0
    read = stage_table(_read(learned.withColumn("h", F.when(trains, row_hash)), vocabulary, shape.end), "read")
    counts = stage_table(read.where("word is not null").groupBy("word").agg(F.sum("c").alias("c")), "words")
    ends = learned.count()
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    totals = (n + ends, v + (ends > 0), ends)
    head = _head(counts, head_words)
    model = train(read.where("ids is not null").select("h", "ids", "n"), shape, **training)

    rows = stage_table(_scored(plain, model, head, totals, vocabulary), "scored")
    rest = rows.where(F.size("rest") > 0).select("rid", F.explode(F.arrays_zip("rest", "rest_n")).alias("x")).select(
        "rid", F.col("x.rest").alias("word"), F.col("x.rest_n").alias("k"))
    rest = rest.join(counts.where(F.col("c") < head[0]), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    rest = rest.groupBy("rid").agg(F.sum(F.col("k") * F.log10((F.col("c") + 0.5) / F.lit(totals[0] + 0.5 * (totals[1] + 1)))).alias("more"),
                                   F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known"))
    out = rows.drop("rest", "rest_n").join(rest, "rid", "left")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
                      F.lit(totals[0]).cast("long").alias("train_tokens"),
                      (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")

