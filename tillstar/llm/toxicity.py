"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents carry information; every other text is
unlabelled, a mix with an unknown toxic part.  A linear model over hashed
words is fitted with the risk estimator

    pi * mean(loss(positive, +1)) + max(0, mean(loss(unlabelled, -1))
                                          - pi * mean(loss(positive, -1)))

whose second part, the risk on the clean class corrected by the class prior
``pi``, cannot go below zero; where a minibatch would push it there, the step
goes the other way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .linear import DIM, Adam, HashedWords, Rows, featurise, platt, sigmoid, telling, texts_in_steps, unlike

#: Everything in ASCII but letters and digits parts words.
_PARTS = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))


def toxic_words():
    hashed = HashedWords()
    return lambda text: hashed(text.lower().encode("utf-8", "ignore").translate(_PARTS).split())


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_nnpu(pos: Rows, unl: Rows, prior: float, epochs: int = 30, batch: int = 512,
             rate: float = 0.05, decay: float = 1e-3, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and intercept under the non-negative PU risk with logistic loss."""
    rng, opt = np.random.default_rng(seed), Adam(rate, decay)
    opt.b = float(np.log(prior / (1 - prior)))
    steps = max(1, -(-len(unl) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(unl))
        for at in range(steps):
            u = order[at * batch:(at + 1) * batch]
            p = rng.choice(len(pos), min(len(pos), max(32, batch // 2)), replace=False)
            ip, rp = pos.take(p)
            iu, ru = unl.take(u)
            sp = sigmoid(np.bincount(rp, opt.w[ip], len(p)) + opt.b)
            su = sigmoid(np.bincount(ru, opt.w[iu], len(u)) + opt.b)
            clean = np.mean(-np.log(1 - su + 1e-12)) - prior * np.mean(-np.log(1 - sp + 1e-12))
            # d loss(z, -1) = s, d loss(z, +1) = s - 1
            if clean >= 0:
                gp, gu = prior * (sp - 1) / len(p) - prior * sp / len(p), su / len(u)
            else:
                gp, gu = prior * sp / len(p), -su / len(u)
            opt.step(np.bincount(ip, gp[rp], DIM) + np.bincount(iu, gu[ru], DIM), gp.sum() + gu.sum())
    return opt.w, opt.b


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_positive: int = 4000, max_unlabelled: int = 12000, z: float = 5.0,
        lift: float = 2.0) -> tuple[np.ndarray, float, float, float]:
    """(weights, intercept, and the slope and shift that calibrate the score).

    The sample is bounded: at most ``max_positive`` confirmed toxic rows and
    ``max_unlabelled`` other rows, those with the smallest hash of their id,
    none of them held out.  The prior is the share of toxic rows among the
    labelled ones that are not held out.  The model sees the words whose
    rates in the two parts differ by ``z`` standard errors and a factor of
    ``lift``, so that chance words of few examples have no say; for the same
    reason one row stands for all near copies in the sample.  Without a toxic row the model is
    constant.
    """
    ids = docs.select(F.col(id_col).alias("_id")).where(F.col("_id").isNotNull() & ~held_out(F.col("_id"))).distinct()
    lab = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y"))
    lab = lab.where(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id")))
    lab = lab.groupBy("_id").agg(F.max("_y").alias("_y"))
    known = lab.agg(F.count("_y").alias("n"), F.sum("_y").alias("toxic")).first()
    if not known["n"] or not known["toxic"]:
        return np.zeros(DIM), -3.0, 1.0, 0.0
    prior = min(0.5, max(1e-4, known["toxic"] / known["n"]))
    at = F.xxhash64("_id", F.lit(11))
    positive = ids.join(lab.where("_y = 1"), "_id", "left_semi").orderBy(at, "_id").limit(max_positive)
    unlabelled = ids.orderBy(F.xxhash64("_id", F.lit(12)), "_id").limit(max_unlabelled)
    # Ids, at most the two bounds together.
    sample = F.broadcast(positive.select("_id", F.lit(1).alias("_part")).unionByName(
        unlabelled.select("_id", F.lit(0).alias("_part"))))
    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(sample, "_id")
    got = featurise(chosen, toxic_words, "_text", ["_id", "_part"]).dropDuplicates(["_id", "_part"]).join(
        lab, "_id", "left").toArrow().to_pandas()
    got = got.sort_values(["_part", "_id"])
    pos, unl = got[got._part == 1], got[got._part == 0]
    # Copies of one text would pass for many examples of its chance words.
    pos, unl = (x.iloc[unlike(list(x.features))] for x in (pos, unl))
    if not len(pos) or not len(unl):
        return np.zeros(DIM), -3.0, 1.0, 0.0
    rows, toxic = Rows(list(unl.features)), Rows(list(pos.features))
    told = telling(toxic, rows, z, lift)
    rows = rows.only(told)
    w, b = fit_nnpu(toxic.only(told), rows, prior)
    known_rows = np.nonzero(unl._y.notna().to_numpy())[0]
    y = unl._y.to_numpy()[known_rows].astype(float)
    if y.sum() < 5 or (1 - y).sum() < 5:
        return w, b, 1.0, 0.0
    slope, shift = platt(rows.scores(w, b, known_rows), y)
    return w, b, max(slope, 1e-3), shift


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.7, whole_rows: bool = False, **bounds) -> DataFrame:
    """Score every whole text for toxicity.

    Returns one row per input row: ``doc_id, held_out, score`` (0 to 1),
    ``predicted`` (1 if the score is at least ``threshold``), or, with
    ``whole_rows``, the input rows of smaller scores as they are.  Nothing but the text
    enters a score: equal texts have equal scores, null and empty texts that
    of no words.  Null ids are scored, never learnt from.  Labels that are
    null, repeated (any toxic one counts) or of unknown ids do no harm; an
    empty table gives an empty result.
    """
    w, b, slope, shift = fit(docs, labels, id_col, text_col, **bounds)
    weights = docs.sparkSession.sparkContext.broadcast(w.astype(np.float32))

    def run(batches):
        make, w = toxic_words(), weights.value
        for batch in batches:
            z = [float(w[make(x)].sum()) for _, part in texts_in_steps(batch, "_text") for x in part]
            s = sigmoid(slope * (np.array(z) + b) + shift)
            names = [n for n in batch.schema.names if n != "_text"]
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(s, pa.float64())], [*names, "_score"])

    if whole_rows:
        # As one value: the columns' names can clash with none here.
        wide = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("_text"))
        return wide.mapInArrow(run, T.StructType([wide.schema["row"], T.StructField("_score", T.DoubleType())])).where(
            F.col("_score") < threshold).select("row.*")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    out = narrow.mapInArrow(run, f"doc_id {kind}, _score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
                      (F.col("_score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    return score(docs, labels, whole_rows=True, **options)
