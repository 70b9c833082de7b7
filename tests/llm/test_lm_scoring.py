"""Attention language model against a plain forward pass and finite differences; counts against brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstar.llm import lm_scoring
from tillstar.llm.attention import Model, Shape

from .helpers import DOCS, EDGE, docs, prose

TINY = Shape(stride=4, context=3, width=5, keys=3, classes=3, ids=12, end=11)


def tiny(seed=0):
    model = Model({0: 9, 3: 5, 4: 4, 7: 2, 8: 2, 9: 1, 11: 3}, TINY, seed)
    rng = np.random.default_rng(seed)
    for name, x in model.p.items():
        model.p[name] = (x + rng.normal(0, 0.7, x.shape)).astype(np.float32)
    return model


def plain(model, text):
    """ln P(next) over all ids at every place of a text, one place after another, in double precision."""
    s, p = model.shape, {k: v.astype(float) for k, v in model.p.items()}
    inputs = [model.local[i] for i in [s.end, *text[:-1]]]
    for i in range(len(text)):
        first = max(0, i // s.stride * s.stride - s.context)
        rows = p["token"][inputs[first:i + 1]]
        w, k = s.width, s.keys
        score = rows[:, w + k:w + 2 * k] @ rows[-1, w:w + k] / math.sqrt(k) + p["bias"][i - np.arange(first, i + 1)]
        att = np.exp(score) / np.exp(score).sum()
        h = rows[-1, :w] + att @ rows[:, w + 2 * k:]
        h = h / (1 + np.abs(h))
        c = p["class"] @ h + p["class_bias"]
        m = p["member"] @ h + p["member_bias"]
        local = np.array([c[model.cls[j]] - np.log(np.exp(c).sum()) + m[j] - np.log(np.exp(m[model.cls == model.cls[j]]).sum())
                          for j in range(model.size)])
        yield np.array([local[model.local[i]] - (math.log(model.unseen) if model.local[i] == model.size - 1 else 0) for i in range(s.ids)])


def test_scores_match_a_plain_pass_and_sum_to_one():
    model, rng = tiny(), np.random.default_rng(1)
    texts = [np.append(rng.integers(0, 11, n), 11) for n in (0, 1, 3, 4, 7, 8, 30)]
    inputs, target, opens, windows = model.windows(texts)
    got = model.score(inputs, target, opens, batch=3).reshape(len(target), -1)
    at = 0
    for text, n in zip(texts, windows, strict=True):
        want = list(plain(model, text))
        assert all(abs(np.exp(x).sum() - 1) < 1e-9 for x in want)
        mine = got[at:at + n].ravel()
        assert np.allclose(mine[:len(text)], [x[i] for x, i in zip(want, text, strict=True)], atol=1e-4)
        assert not mine[len(text):].any()
        at += n


@pytest.mark.parametrize("name", ["token", "bias", "class", "class_bias", "member", "member_bias"])
def test_gradients_match_differences(name):
    model, rng = tiny(2), np.random.default_rng(3)
    for part in (model.p, model.g):
        for k in part:
            part[k] = part[k].astype(np.float64)
    inputs, target, opens, _ = model.windows([np.append(rng.integers(0, 11, n), 11) for n in (5, 9, 2)])
    view = np.lib.stride_tricks.sliding_window_view(inputs, 7)[::4]
    _, g = model.gradients(view, target, opens)
    full = g[name]
    if name == "token":
        full = np.zeros(model.p[name].shape)
        full[g[name][0]] = g[name][1]
    flat = model.p[name].reshape(-1)
    for k in rng.choice(flat.size, min(12, flat.size), replace=False):
        kept = flat[k]
        two = []
        for d in (1e-4, -1e-4):
            flat[k] = kept + d
            two.append(model.gradients(view, target, opens)[0])
        flat[k] = kept
        assert abs((two[0] - two[1]) / 2e-4 - full.reshape(-1)[k]) < 2e-3


def fold(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


HELD = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 1"


def scored(df, held_out=HELD, **options):
    return lm_scoring.score(df, F.expr(held_out), **options)


def words(text):
    return [*(text or "").encode().lower().split(), b" "]


@pytest.mark.parametrize("head_words", [0, 40, 10**6])
def test_counts_match_brute_force(spark, head_words):
    data = [(100 + i, prose(i, 3 + i % 90, 300) + f" Own{i} É") for i in range(60)] + EDGE
    got = scored(docs(spark, data).repartition(3), head_words=head_words, train_every=2)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    c = Counter()
    for d, t in data:
        if not fold(d):
            c.update(words(t))
    n, z = sum(c.values()), sum(c.values()) + 0.5 * (len(c) + 1)
    want = [(d, fold(d), len(words(t)), sum(w in c for w in words(t)), n, round(sum(math.log10((c[w] + 0.5) / z) for w in words(t)), 6)) for d, t in data]
    rows = got.collect()
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in rows), key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    same = [r.score for r in rows if r.doc_id in (1, 2, 3)]
    assert max(same) - min(same) < 1e-5


def test_long_texts_are_split_anywhere(spark, monkeypatch):
    data = [(i, prose(i, 400)) for i in range(12)]
    want = {r.doc_id: r for r in scored(docs(spark, data)).collect()}
    monkeypatch.setattr(lm_scoring, "PIECE", 50)
    monkeypatch.setattr(lm_scoring, "WORDS", 30)
    for r in scored(docs(spark, data)).collect():
        assert r[:5] == want[r.doc_id][:5] and abs(r.base_score - want[r.doc_id].base_score) < 1e-6


def test_words_of_short_texts_go_together(monkeypatch):
    """One list of words for many short texts, several for a long one; every word with its text."""
    texts = [(t or "").encode() for _, t in EDGE[:-2]] + [prose(i, i % 40).encode() for i in range(200)]
    assert len(list(lm_scoring.together(texts))) == 1
    for piece in (1 << 20, 50):
        monkeypatch.setattr(lm_scoring, "PIECE", piece)
        got = [[] for _ in texts]
        for words_, whose, ends in lm_scoring.together(texts):
            for i, at, end in zip(whose, [0, *ends[:-1]], ends, strict=True):
                got[i] += words_[at:end]
        assert got == [t.lower().split() for t in texts]
    assert len(list(lm_scoring.together([b"a b " * 50]))) > 1
    assert not list(lm_scoring.together([]))


def test_counts_of_texts_that_go_over_several_lists(spark, monkeypatch):
    data = [(i, prose(i, 60, 40) + f" own{i}") for i in range(30)]
    want = {r.doc_id: r for r in scored(docs(spark, data), head_words=0).collect()}
    monkeypatch.setattr(lm_scoring, "PIECE", 50)
    for r in scored(docs(spark, data).repartition(3), head_words=20).collect():
        assert r[:5] == want[r.doc_id][:5] and abs(r.base_score - want[r.doc_id].base_score) < 1e-6


def test_one_word_and_white_space_of_a_million(spark):
    data = [(1, "a" * 1_000_000), (2, "\n" * 1_000_000), (3, "　" * 200_000)]
    got = {r.doc_id: r.n_tokens for r in scored(docs(spark, data), "false").collect()}
    assert got == {1: 2, 2: 1, 3: 2}


def test_no_rows_and_no_training_rows(spark):
    assert scored(spark.createDataFrame([], DOCS)).count() == 0
    row = scored(docs(spark, [(1, "x y")]), "true").first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def test_tasks_that_train_apart_learn(spark):
    """Held-out texts of a repetitive language become likelier than by the base."""
    data = [(i, " ".join(f"{a}nder {a}ing" for a in prose(i, 60, 12).split())) for i in range(300)]
    rows = scored(docs(spark, data), train_every=1, task_tokens=10_000, rounds=3).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_all_rows_that_are_not_held_out_train_the_model(spark, monkeypatch):
    """The model's counts of ids are those of every training text, whatever its hash, and of no other."""
    import public_tokenizers
    from tokenizers import Tokenizer

    plain_ = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(lm_scoring, "ROW_IDS", 50)
    data = [(i, prose(i, 1 + i % 70, 90) + f" rare{i}") for i in range(120)] + [(500, "twice seen"), (500, "twice seen"), (None, "no id"), (501, None)]
    models, train = [], lm_scoring.train
    monkeypatch.setattr(lm_scoring, "train", lambda *a, **k: models.append(train(*a, **k)) or models[-1])
    scored(docs(spark, data).repartition(3)).count()
    want = Counter()
    for d, t in data:
        if not fold(d):
            want.update([*(i for w in (t or "").lower().split() for i in plain_.encode(" " + w, add_special_tokens=False).ids), 50256])
    assert models[0].counts == want


def test_words_have_the_ids_of_the_json_tokenizer():
    from tokenizers import Tokenizer
    import public_tokenizers

    plain_ = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain_.encode_special_tokens = True
    odd = ["'s", "don't", "<|endoftext|>", "\u3000", "a\u3000b", "\u00a0x\u00a0", "\x00", "\x1c\x1d", "日本語", "é1!", "x" * 9000, "12345", "--", "\u2028"]
    for words_ in (odd[:3], odd, prose(3, 500).split() + odd[8:10], *([w] for w in odd)):
        encoder = lm_scoring.Encoder(None)
        coded = [w.encode() for w in words_]
        got = encoder.encode(encoder.numbers(coded)).tolist()
        assert got == [i for w in words_ for i in plain_.encode(" " + w, add_special_tokens=False).ids]
