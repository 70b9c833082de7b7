"""Hashed sparse features and small numpy linear models.

Models are fitted on the driver from samples whose size is a parameter of
the operator; scoring runs on the executors over whole tables.  A model is
two numbers a feature at most, ``DIM`` of them, whatever the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

DIM = 1 << 18
#: Rows of an Arrow batch handled at once, which bounds the Python strings held.
STEP = 256


class HashedWords(dict):
    """Word -> feature number; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        i = self[word] = zlib.crc32(word) % DIM
        return i

    def __call__(self, words) -> np.ndarray:
        found = set(words)
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def texts_in_steps(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts with nulls as empty) of a batch, ``STEP`` rows at a time."""
    values = batch.column(batch.schema.get_field_index(column))
    for at in range(0, len(values), STEP):
        yield at, [x or "" for x in values.slice(at, STEP).to_pylist()]


def featurise(df: DataFrame, featuriser: Callable[[], Callable[[str], np.ndarray]],
              text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``features array<int>`` of every row."""
    fields = [f for f in df.select(*keep).schema.fields]
    from pyspark.sql import types as T

    schema = T.StructType([*fields, T.StructField("features", T.ArrayType(T.IntegerType()))])

    def run(batches):
        make = featuriser()
        for batch in batches:
            out = [make(x).astype(np.int32) for _, part in texts_in_steps(batch, text_col) for x in part]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(out, pa.list_(pa.int32()))], [*keep, "features"])

    return df.select(*keep, text_col).mapInArrow(run, schema)


def unlike(lists: list) -> list[int]:
    """Numbers of the first row of each group of near copies (equal sketches of three minima)."""
    first: dict = {}
    for i, x in enumerate(lists):
        h = np.sort((np.asarray(x, np.uint64) * np.uint64(2654435761)) % np.uint64(1 << 32))[:3]
        first.setdefault(h.tobytes(), i)
    return sorted(first.values())


class Rows:
    """Sparse binary rows: feature numbers end to end, and where each row starts."""

    def __init__(self, lists):
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.index = np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(lists) else np.empty(0, np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.sizes)])

    def __len__(self) -> int:
        return len(self.sizes)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(feature numbers, number of the row in ``rows`` that each is of)."""
        sizes = self.sizes[rows]
        of = np.repeat(np.arange(len(rows)), sizes)
        within = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.index[np.repeat(self.start[rows], sizes) + within], of

    def rates(self) -> np.ndarray:
        """Share of the rows that hold each feature."""
        return np.bincount(self.index, minlength=DIM) / max(1, len(self))

    def only(self, kept: np.ndarray) -> Rows:
        """The same rows with the features that ``kept`` marks."""
        of = np.repeat(np.arange(len(self)), self.sizes)
        has = kept[self.index]
        out = Rows([])
        out.index, out.sizes = self.index[has], np.bincount(of[has], minlength=len(self))
        out.start = np.concatenate([[0], np.cumsum(out.sizes)])
        return out

    def scores(self, w: np.ndarray, b: float, rows: np.ndarray | None = None) -> np.ndarray:
        rows = np.arange(len(self)) if rows is None else rows
        out = np.empty(len(rows))
        for at in range(0, len(rows), 2048):
            part = rows[at:at + 2048]
            i, of = self.take(part)
            out[at:at + 2048] = np.bincount(of, w[i], len(part)) + b
        return out


def telling(a: Rows, b: Rows, z: float, lift: float = 1.0) -> np.ndarray:
    """Features whose rates in ``a`` and ``b`` differ by ``z`` standard errors and a factor of ``lift``."""
    ra, rb, n, m = a.rates(), b.rates(), max(1, len(a)), max(1, len(b))
    p = (ra * n + rb * m) / (n + m)
    far = (ra >= lift * rb) | (rb >= lift * ra)
    return far & (np.abs(ra - rb) > z * np.sqrt(p * (1 - p) * (1 / n + 1 / m)))


class Adam:
    """Adam over the weights and the intercept."""

    def __init__(self, rate: float, decay: float):
        self.rate, self.decay, self.t = rate, decay, 0
        self.w, self.b = np.zeros(DIM), 0.0
        self.m, self.v, self.mb, self.vb = np.zeros(DIM), np.zeros(DIM), 0.0, 0.0

    def step(self, gw: np.ndarray, gb: float) -> None:
        self.t += 1
        gw = gw + self.decay * self.w
        self.m += 0.1 * (gw - self.m)
        self.v += 0.001 * (gw * gw - self.v)
        self.mb += 0.1 * (gb - self.mb)
        self.vb += 0.001 * (gb * gb - self.vb)
        one, two = 1 - 0.9 ** self.t, 1 - 0.999 ** self.t
        self.w -= self.rate * (self.m / one) / (np.sqrt(self.v / two) + 1e-8)
        self.b -= self.rate * (self.mb / one) / (np.sqrt(self.vb / two) + 1e-8)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(rows: Rows, of: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 512,
                 rate: float = 0.02, decay: float = 1e-4, seed: int = 0) -> tuple[np.ndarray, float]:
    """Logistic regression on ``rows[of]`` with labels ``y``, classes weighted evenly."""
    rng, opt = np.random.default_rng(seed), Adam(rate, decay)
    share = max(min(y.mean(), 1 - 1e-3), 1e-3) if len(y) else 0.5
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        order = rng.permutation(len(of))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            i, r = rows.take(of[pick])
            z = np.bincount(r, opt.w[i], len(pick)) + opt.b
            g = (sigmoid(z) - y[pick]) * weight[pick] / len(pick)
            opt.step(np.bincount(i, g[r], DIM), g.sum())
    return opt.w, opt.b


def platt(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, ...]:
    """Logistic fit of ``y`` on the columns of ``z`` and a constant, by Newton's method.

    Targets are drawn in as Platt does, so that separable data keep finite weights.
    """
    z = z.reshape(len(y), -1)
    x = np.column_stack([z, np.ones(len(y))])
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ beta)
        grad = x.T @ (p - t) + 1e-3 * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
        move = np.linalg.solve(hess, grad)
        beta -= move * min(1.0, 5.0 / (np.abs(move).max() + 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    return tuple(float(v) for v in beta)
