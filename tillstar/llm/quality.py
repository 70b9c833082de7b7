"""Quality by co-training a text view and a page-metadata view.

Two classifiers see disjoint descriptions of a document: what its text looks
like, and what is known about it and its page without reading it.  In each
round either one labels the unlabelled documents it is most sure of, in the
proportion of the classes, for the other one to learn from.  In the end each
view is calibrated, and a small logistic model combines the two calibrated
scores.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linear import DIM, HashedWords, Rows, featurise, fit_logistic, platt, sigmoid, telling, texts_in_steps, unlike


def _feature(name: str) -> int:
    return zlib.crc32(name.encode()) % DIM


class Shapes(dict):
    """Word -> feature of its shape: case, digits and marks, runs drawn together."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", re.sub(r"\d", "9", word)))
        i = self[word] = _feature("shape " + (shape if len(shape) < 12 else "long"))
        return i


def text_view():
    """Whole text -> features: words, word shapes, and graded shares of what marks poor text."""
    shapes, hashed, grade = Shapes(), HashedWords(), {}

    def level(name: str, value: float) -> int:
        key = (name, min(10, int(value * 10)))
        if key not in grade:
            grade[key] = _feature(f"{name} {key[1]}")
        return grade[key]

    def make(text: str) -> np.ndarray:
        words = text.split()
        n = max(1, len(words))
        counts = Counter(words)
        lines = [x for x in text.split("\n") if x.strip()]
        own = {
            level("size", np.log10(len(text) + 1) / 6),
            level("upper", sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / n),
            level("distinct", len(counts) / n),
            level("commonest", max(counts.values(), default=0) / n),
            level("lines", len(set(lines)) / max(1, len(lines))),
            level("letters", sum(map(str.isalpha, text)) / max(1, len(text))),
            level("ends", sum(x.rstrip()[-1] in ".!?" for x in lines) / max(1, len(lines))),
        }
        own.update(map(shapes.__getitem__, counts))
        lowered = hashed(w.lower().encode("utf-8", "ignore") for w in counts)
        return np.unique(np.concatenate([np.fromiter(own, np.int64, len(own)), lowered]))

    return make


def meta_view(lang: Column, source: Column, size: Column, url: Column) -> Column:
    """Feature numbers of a document's metadata; no text is read."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)

    def named(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + " "), F.coalesce(value.cast("string"), F.lit("none")))

    names = F.array(
        named("lang", lang), named("source", source),
        named("size", F.floor(F.log2(F.greatest(size, F.lit(1.0))) * 2)),
        named("host", host), named("domain", F.regexp_extract(host, "[^.]+[.][^.]+$", 0)),
        named("scheme", F.regexp_extract(url, "^([a-z]+)://", 1)),
        named("ending", F.regexp_extract(url, "([.][a-z]+|/|[?].*|#.*)$", 1)))
    return F.transform(names, lambda s: (F.crc32(s.cast("binary")) % DIM).cast("int"))


def _cotrain(views: list[Rows], y: np.ndarray, hold: np.ndarray, rounds: int, sure: float) -> list[tuple[np.ndarray, float]]:
    """Weights of both views.  ``y``: 1, 0, or nan where unlabelled or held for calibration (``hold``)."""
    share = float(np.nanmean(y))
    given = [y.copy(), y.copy()]
    models = []
    for r in range(rounds + 1):
        models = []
        for view, target in zip(views, given, strict=True):
            known = np.nonzero(~np.isnan(target))[0]
            models.append(fit_logistic(view, known, target[known], seed=r))
        if r == rounds:
            break
        for teacher, pupil in ((0, 1), (1, 0)):
            free = np.nonzero(np.isnan(given[0]) & np.isnan(given[1]) & ~hold)[0]
            if not len(free):
                continue
            p = sigmoid(views[teacher].scores(*models[teacher], free))
            order = free[np.argsort(p, kind="stable")]
            p = np.sort(p)
            take = max(1, len(free) // (4 * rounds))
            low, high = max(1, round(take * (1 - share))), max(1, round(take * share))
            given[pupil][order[:low][p[:low] <= 1 - sure]] = 0.0
            given[pupil][order[-high:][p[-high:] >= sure]] = 1.0
    return models


def score(docs: DataFrame, labels: DataFrame, pages: DataFrame | None = None, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang", source_col: str = "source", size_col: str = "n_chars",
          threshold: float = 0.5, rounds: int = 3, sure: float = 0.9, max_labelled: int = 6000,
          max_unlabelled: int = 10000) -> DataFrame:
    """Score every whole document's quality.

    Returns one row per input row: ``doc_id, text_score, meta_score`` (the
    calibrated views), ``score`` (both combined), ``keep`` (score at least
    ``threshold``).

    Fitted on a bounded sample: the ``max_labelled`` labelled rows and
    ``max_unlabelled`` others with the smallest hash of their id; a fifth of
    the labelled ones only calibrates.  Null or repeated labels do no harm
    (the lowest of a row counts); with labels of one class only, every score
    is that class's share.  Null texts count as empty, null metadata as a
    value of its own; null ids are scored without page metadata.  Rows that
    share an id are each scored by their own text and, by that id, the same
    page.  An empty table gives an empty result.
    """
    lab = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y"))
    lab = lab.where("_id is not null and _y is not null").groupBy("_id").agg(F.min("_y").alias("_y"))
    ids = docs.select(F.col(id_col).alias("_id")).where("_id is not null").distinct().join(lab, "_id", "left")
    at = F.xxhash64("_id", F.lit(21))
    chosen = ids.where("_y is not null").orderBy(at, "_id").limit(max_labelled).unionByName(
        ids.where("_y is null").orderBy(at, "_id").limit(max_unlabelled))
    chosen = chosen.withColumn("_hold", F.pmod(F.xxhash64("_id", F.lit(22)), F.lit(5)) == 0)
    own = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"),
                      F.col(source_col).cast("string").alias("_source"), F.col(size_col).cast("double").alias("_size"),
                      F.col(text_col).alias("_text"))
    described = ["_lang", "_source", "_size"]
    if pages is None:
        pages = docs.sparkSession.createDataFrame([], "doc_id long, url string")
    page = pages.where("doc_id is not null").groupBy(F.col("doc_id").alias("_pid")).agg(F.min("url").alias("_url"))

    def with_meta(df: DataFrame) -> DataFrame:
        df = df.join(page, F.col("_id") == F.col("_pid"), "left")
        return df.withColumn("meta", meta_view(*(F.col(c) for c in (*described, "_url")))).drop("_pid", "_url", *described)

    # Ids, at most the two bounds together.
    some = own.join(F.broadcast(chosen), "_id")
    got = with_meta(featurise(some, text_view, "_text", ["_id", "_y", "_hold", *described]).dropDuplicates(["_id"])).toArrow().to_pandas()
    got = got.sort_values("_id").reset_index(drop=True)
    if len(got):
        got = got.iloc[unlike(list(got.features))].reset_index(drop=True)
    y = got._y.to_numpy(dtype=float) if len(got) else np.empty(0)
    known = y[~np.isnan(y)]
    zero = (np.zeros(DIM), 0.0)
    if len(known) < 10 or known.min() == known.max():
        base = float((known.sum() + 1) / (len(known) + 2))
        models, calibrate, mix = [zero, zero], [(0.0, np.log(base / (1 - base)))] * 2, (0.5, 0.5, 0.0)
    else:
        hold = got._hold.to_numpy(dtype=bool) & ~np.isnan(y)
        if len(set(y[hold])) < 2 or hold.sum() < 20:
            hold = np.zeros(len(y), bool)
        shown = np.where(hold, np.nan, y)
        views = [Rows(list(got.features)), Rows(list(got.meta))]
        good, bad = (np.nonzero(shown == v)[0] for v in (1, 0))
        lists = list(got.features)
        told = telling(Rows([lists[i] for i in bad]), Rows([lists[i] for i in good]), 4.0, 2.0)
        models = _cotrain([views[0].only(told), views[1]], shown, hold, rounds, sure)
        models[0] = (models[0][0] * told, models[0][1])
        on = np.nonzero(hold if hold.any() else ~np.isnan(y))[0]
        logits, calibrate = [], []
        for view, model in zip(views, models, strict=True):
            z = view.scores(*model, on)
            calibrate.append(platt(z, y[on]))
            logits.append(calibrate[-1][0] * z + calibrate[-1][1])
        mix = platt(np.column_stack(logits), y[on])
    weights = docs.sparkSession.sparkContext.broadcast(
        (models[0][0].astype(np.float32), models[0][1], models[1][0].astype(np.float32), models[1][1], calibrate, mix))

    names = ["_id", *described]

    def text_scores(batches):
        make, (w, b, *_) = text_view(), weights.value
        for batch in batches:
            z = [float(w[make(x)].sum()) + b for _, part in texts_in_steps(batch, "_text") for x in part]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(z, pa.float64())], [*names, "_z"])

    def both_scores(batches):
        _, _, w, b, ((s0, c0), (s1, c1)), (m0, m1, m2) = weights.value
        for batch in batches:
            z0 = s0 * batch.column(1).to_numpy(zero_copy_only=False) + c0
            z1 = s1 * np.array([float(w[np.array(x, np.int64)].sum()) + b for x in batch.column(2).to_pylist()]) + c1
            out = (sigmoid(z0), sigmoid(z1), sigmoid(m0 * z0 + m1 * z1 + m2))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.float64()) for x in out)],
                                             ["doc_id", "text_score", "meta_score", "score"])

    kind = own.schema["_id"].dataType.simpleString()
    # The page is looked up after the text has been scored, so that no text is shuffled.
    scored = own.select(*names, "_text").mapInArrow(text_scores, f"_id {kind}, _lang string, _source string, _size double, _z double")
    out = with_meta(scored).select("_id", "_z", "meta").mapInArrow(
        both_scores, f"doc_id {kind}, text_score double, meta_score double, score double")
    return out.withColumn("keep", F.col("score") >= threshold)
