"""A small causal self-attention language model in numpy.

One layer.  A token's query, key, value and own contribution are rows of
tables (an embedding and its projections in one), so that a text costs no
projection; distances have a learned bias.  The next token is predicted in
two softmax steps, its class and its place in the class; classes hold equal
shares of the square roots of frequencies, so frequent tokens are in small
classes.  Tokens that training has not seen share one place evenly.

A text is cut into windows that overlap: each has ``context`` tokens that are
only looked at and ``stride`` tokens that are predicted, every token of the
text in one window.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass
from pathlib import Path

import numpy as np

F32 = np.float32
#: Weights stay within this, which keeps every exponent in range.
LIMIT = 2.0


@dataclass(frozen=True)
class Shape:
    """Sizes of the model; ``end`` closes every text and stands before its first token."""

    stride: int = 16
    context: int = 4
    width: int = 20
    keys: int = 4
    classes: int = 20
    ids: int = 50257  # fewer than 65,536
    end: int = 50256


def one_thread() -> None:
    """Keep the library behind numpy's products to the one core that a task has, where it can be told so."""
    for path in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


def _reach(shape: Shape) -> np.ndarray:
    """Distance of each window position from each predicted position's input; negative: later."""
    return np.arange(shape.stride)[:, None] + shape.context - np.arange(shape.stride + shape.context)[None, :]


class Model:
    """Parameters by name, and what follows from the frequencies of the training sample's ids."""

    def __init__(self, counts: dict[int, int], shape: Shape, seed: int = 7):
        """``counts``: occurrences of ids; one more place is for all the others."""
        self.counts, self.shape, rng = counts, shape, np.random.default_rng(seed)
        known = sorted(counts, key=lambda i: (-counts[i], i))
        self.size = len(known) + 1
        self.local = np.full(shape.ids, self.size - 1, np.int32)
        self.local[known] = np.arange(len(known))
        self.unseen = max(1, shape.ids - len(known))
        share = np.array([*(counts[i] for i in known), 1], float)
        share /= share.sum()
        root = np.sqrt(share)
        cls = np.minimum((np.cumsum(root) - root) / root.sum() * shape.classes, shape.classes - 1).astype(int)
        # Numbered without gaps; places of a class are neighbours.
        self.cls = np.unique(cls, return_inverse=True)[1].astype(np.int32)
        self.first = np.searchsorted(self.cls, np.arange(self.cls[-1] + 2)).astype(np.int64)
        n, c, w, k = self.size, int(self.cls[-1]) + 1, shape.width, shape.keys
        mass = np.add.reduceat(share, self.first[:-1])
        inside = np.log(share / mass[self.cls])

        def draw(*of, scale=0.1):
            return rng.normal(0, scale, of).astype(F32)

        self.p = {"token": draw(n, 2 * w + 2 * k), "bias": np.zeros(shape.stride + shape.context, F32), "class": draw(c, w),
                  "class_bias": np.log(mass).astype(F32), "member": draw(n, w), "member_bias": inside.astype(F32)}
        self.g = {name: np.full(x.shape, 1e-4, F32) for name, x in self.p.items()}
        reach = _reach(shape)
        self.later = np.where(reach < 0, F32(-1e9), F32(0))
        self.far = np.maximum(reach, 0)

    def state(self) -> np.ndarray:
        """All parameters and their accumulated squares, end to end."""
        return np.concatenate([x.ravel() for part in (self.p, self.g) for x in part.values()])

    def load(self, state: np.ndarray) -> Model:
        at = 0
        for part in (self.p, self.g):
            for name, x in part.items():
                part[name] = state[at:at + x.size].reshape(x.shape).astype(F32)
                at += x.size
        return self

    def windows(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Inputs (with ``context`` before), targets, first window of a text?, tokens of each text, padded to whole windows.

        ``texts`` are ids that end in ``end``.  Targets of padding are -1.
        """
        s, c = self.shape.stride, self.shape.context
        sizes = np.array([len(t) for t in texts], np.int64)
        padded = -(-sizes // s) * s
        start = np.cumsum(padded) - padded
        at = np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        flat = self.local[np.concatenate(texts)] if len(texts) else np.empty(0, np.int32)
        target = np.full(int(padded.sum()), -1, np.int32)
        target[at] = flat
        inputs = np.full(c + len(target), self.local[self.shape.end], np.int32)
        inputs[c + 1:] = np.where(target[:-1] >= 0, target[:-1], self.local[self.shape.end])
        inputs[c + start] = self.local[self.shape.end]
        opens = np.zeros(len(target) // s, bool)
        opens[start // s] = True
        return inputs, target.reshape(-1, s), opens, padded // s

    def _forward(self, x: np.ndarray, opens: np.ndarray):
        """Table rows and attention of windows ``x``, and hidden states of the predicted positions with a one behind each.

        The one lets products add the biases and sum their gradients.
        """
        w, k, c = self.shape.width, self.shape.keys, self.shape.context
        rows = self.p["token"].take(x, axis=0)
        query = rows[:, c:, w:w + k] * rows.dtype.type(1 / np.sqrt(k))
        key, value = rows[:, :, w + k:w + 2 * k], rows[:, :, w + 2 * k:]
        score = query @ key.transpose(0, 2, 1)
        score += self.p["bias"][self.far] + self.later
        # Windows that open a text have nothing before it.
        score[opens, :, :c] = F32(-1e9)
        np.exp(score, out=score)
        score /= (score @ np.ones(score.shape[2], score.dtype))[:, :, None]
        pre = score @ value
        pre += rows[:, c:, :w]
        hidden = np.ones((len(x) * self.shape.stride, w + 1), rows.dtype)
        pre = pre.reshape(-1, w)
        size = np.abs(pre)
        size += F32(1)
        np.divide(pre, size, out=hidden[:, :w])
        return rows, score, hidden

    def _targets(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where targets are, sorted by place, which is by class too; the targets; and where each class begins."""
        t = target.ravel()
        at = np.argsort(t.astype(np.uint16), kind="stable")
        t = t.take(at)
        # Padding, -1, comes last as the largest number of 16 bits.
        n = len(t) - int(np.count_nonzero(t < 0))
        return at[:n], t[:n], np.searchsorted(t[:n], self.first)

    def score(self, inputs: np.ndarray, target: np.ndarray, opens: np.ndarray, batch: int = 512) -> np.ndarray:
        """Natural logarithm of the probability of every target, 0 for padding."""
        s, c, out = self.shape.stride, self.shape.context, np.zeros(target.size, F32)
        of_class = np.column_stack([self.p["class"], self.p["class_bias"]])
        member = np.column_stack([self.p["member"], self.p["member_bias"]])
        for lo in range(0, len(target), batch):
            hi = min(lo + batch, len(target))
            x = np.lib.stride_tricks.sliding_window_view(inputs[lo * s:hi * s + c], s + c)[::s]
            hidden = self._forward(x, opens[lo:hi])[2]
            at, t, bounds = self._targets(target[lo:hi])
            h = hidden.take(at, axis=0)
            logits = h @ of_class.T
            got = np.empty(len(t), F32)
            # The product of both sums, which needs the range of double precision.
            divisor = np.ones(len(t))
            for k in np.nonzero(np.diff(bounds))[0]:
                a, b, lo2, hi2 = bounds[k], bounds[k + 1], self.first[k], self.first[k + 1]
                got[a:b] = logits[a:b, k]
                if hi2 - lo2 > 1:
                    inner = h[a:b] @ member[lo2:hi2].T
                    got[a:b] += inner.reshape(-1).take(np.arange(0, inner.size, hi2 - lo2) + (t[a:b] - lo2))
                    np.exp(inner, out=inner)
                    divisor[a:b] = inner @ np.ones(hi2 - lo2, F32)
            np.exp(logits, out=logits)
            divisor *= logits @ np.ones(logits.shape[1], F32)
            got -= np.log(divisor)
            got[t == self.size - 1] -= F32(np.log(self.unseen))
            out[lo * s + at] = got
        return out

    def gradients(self, x: np.ndarray, target: np.ndarray, opens: np.ndarray) -> tuple[float, dict]:
        """Mean negative logarithm of the targets' probabilities, and its gradient by parameter.

        The token table's is a pair: rows that occur, and their gradients.
        """
        w, k, c = self.shape.width, self.shape.keys, self.shape.context
        rows, att, hidden = self._forward(x, opens)
        kind = rows.dtype
        at, t, bounds = self._targets(target)
        n = len(at)
        h1 = hidden.take(at, axis=0)
        share = kind.type(1 / max(n, 1))
        of_class = np.column_stack([self.p["class"], self.p["class_bias"]])
        p = h1 @ of_class.T
        np.exp(p, out=p)
        total = p @ np.ones(p.shape[1], kind)
        total /= share
        p /= total[:, None]
        # The probabilities of the targets' classes, and of their places there, times ``share``.
        hit, place = np.empty(n, kind), np.full(n, share, kind)
        member = np.column_stack([self.p["member"], self.p["member_bias"]])
        of_member = np.zeros_like(member)
        inner = np.zeros((n, w + 1), kind)
        for j in np.nonzero(np.diff(bounds))[0]:
            a, b, lo, hi = bounds[j], bounds[j + 1], self.first[j], self.first[j + 1]
            hit[a:b] = p[a:b, j]
            p[a:b, j] -= share
            if hi - lo > 1:
                q = h1[a:b] @ member[lo:hi].T
                np.exp(q, out=q)
                total = q @ np.ones(hi - lo, kind)
                total /= share
                q /= total[:, None]
                its = np.arange(0, q.size, hi - lo)
                its += t[a:b] - lo
                flat = q.reshape(-1)
                own = flat.take(its)
                place[a:b] = own
                flat[its] = own - share
                np.matmul(q.T, h1[a:b], out=of_member[lo:hi])
                np.matmul(q, member[lo:hi], out=inner[a:b])
        loss = -(np.log(hit / share).sum() + np.log(place / share).sum())
        dh = p @ of_class
        dh += inner
        of_class = p.T @ h1
        g = {"class": of_class[:, :w], "class_bias": of_class[:, w], "member": of_member[:, :w], "member_bias": of_member[:, w]}
        slope = np.abs(h1)
        np.subtract(F32(1), slope, out=slope)
        # The ones' column becomes 0.
        dh *= slope
        dh *= slope
        if n == len(hidden):
            back = np.empty(n, np.int64)
            back[at] = np.arange(n)
            full = dh.take(back, axis=0)
        else:
            full = np.zeros((len(hidden), w + 1), kind)
            full[at] = dh
        full = full.reshape(len(x), -1, w + 1)[:, :, :w]
        table = np.empty((x.size + 1, rows.shape[2]), kind)
        d = table[:-1].reshape(rows.shape)
        query, key, value = rows[:, c:, w:w + k], rows[:, :, w + k:w + 2 * k], rows[:, :, w + 2 * k:]
        d[:, :c, :w + k] = 0
        d[:, c:, :w] = full
        np.matmul(att.transpose(0, 2, 1), full, out=d[:, :, w + 2 * k:])
        ds = full @ value.transpose(0, 2, 1)
        ds -= np.einsum("bij,bij->bi", ds, att)[:, :, None]
        ds *= att
        g["bias"] = np.bincount(self.far.ravel(), np.ones(len(x), kind) @ ds.reshape(len(x), -1), len(self.p["bias"])).astype(F32)
        ds *= F32(1 / np.sqrt(k))
        np.matmul(ds, key, out=d[:, c:, w:w + k])
        np.matmul(ds.transpose(0, 2, 1), query, out=d[:, :, w + k:w + 2 * k])
        flat = x.ravel()
        order = np.argsort(flat.astype(np.uint16), kind="stable")
        flat = flat.take(order)
        first = np.concatenate([[0], np.nonzero(np.diff(flat))[0] + 1])
        # A token's rows are added eight at a time by products, the last with rows of zeros, and then those sums.
        table[-1] = 0
        sizes = np.diff(first, append=len(flat))
        eights = -(-sizes // 8)
        begin = np.cumsum(eights) - eights
        places = np.full(8 * int(eights.sum()), len(flat))
        places[np.repeat(8 * begin - first, sizes) + np.arange(len(flat))] = order
        sums = np.ones((1, 8), kind) @ table.take(places, axis=0).reshape(-1, 8, table.shape[1])
        g["token"] = (flat[first], np.add.reduceat(sums[:, 0], begin))
        return float(loss) / max(n, 1), g

    def step(self, x: np.ndarray, target: np.ndarray, opens: np.ndarray, rate: float) -> float:
        """One Adagrad step on a batch of windows."""
        if not (target >= 0).any():
            return 0.0
        loss, g = self.gradients(x, target, opens)
        for name, grad in g.items():
            at, grad = grad if name == "token" else (None, grad)
            squares, now = (self.g[name], self.p[name]) if at is None else (self.g[name].take(at, axis=0), self.p[name].take(at, axis=0))
            squares += grad * grad
            move = F32(rate) * grad
            move /= np.sqrt(squares)
            now -= move
            limit = 20 if name.endswith("bias") else LIMIT
            np.clip(now, -limit, limit, out=now)
            if at is not None:
                self.g[name][at], self.p[name][at] = squares, now
        return loss
