"""Toxicity and quality: held-out accuracy and edge cases."""

import random

import pytest

from tillstar.llm import quality, toxicity

from .helpers import EDGE, docs, prose

BAD = ["blorp", "krunk", "zarf", "quag", "snive"]


@pytest.fixture(scope="module")
def toxic_rows():
    rng, out, lab = random.Random(8), [], []
    for d in range(1200):
        words = prose(d, 60).split()
        toxic = d % 8 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD).upper() + "!")
        out.append((d, " ".join(words)))
        if d % 2 == 0:
            lab.append((d, 1, int(toxic)))
    return out, lab


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark, toxic_rows):
    rows, lab = toxic_rows
    lab = [*lab, (None, 1, 1), (3, 1, None), (10**9, 1, 1), lab[0]]
    got = toxicity.score(docs(spark, rows), labels(spark, lab)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert 300 < len(held) < 500
    assert sum(r.predicted == int(r.doc_id % 8 == 0) for r in held) / len(held) > 0.97
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got)


def test_held_out_labels_are_not_learnt(spark, toxic_rows):
    rows, lab = toxic_rows
    out = {r.doc_id for r in toxicity.score(docs(spark, rows), labels(spark, [])).collect() if r.held_out}
    turned = [(d, q, 1 - t) if d in out else (d, q, t) for d, q, t in lab]
    a, b = ({r.doc_id: r.score for r in toxicity.score(docs(spark, rows), labels(spark, x)).collect()} for x in (lab, turned))
    assert a == b


def test_toxicity_edges(spark, toxic_rows):
    rows, lab = toxic_rows
    extra = [(None if d is None else d + 10_000, t) for d, t in EDGE]
    frame = docs(spark, rows + extra)
    got = toxicity.score(frame, labels(spark, lab)).collect()
    assert len(got) == len(rows) + len(extra) and all(r.score is not None for r in got)
    same = [r.score for r in got if r.doc_id in (10_001, 10_002, 10_003)]
    assert len(set(same)) == 1
    left = toxicity.drop_toxic(frame, labels(spark, lab))
    assert left.columns == frame.columns
    kept = {r.doc_id for r in left.collect()}
    assert sum(d in kept for d in range(0, 1200, 8)) < 10 and sum(d in kept for d in range(1200) if d % 8) > 1040
    assert toxicity.score(docs(spark, []), labels(spark, lab)).count() == 0
    assert toxicity.score(docs(spark, EDGE), labels(spark, [])).count() == len(EDGE)


def test_quality_by_both_views(spark):
    rng, rows, lab, pages = random.Random(9), [], [], []
    for d in range(900):
        text, poor = prose(d, 80), d % 5 == 0
        if poor:
            text = text.upper().replace(" ", "!! ") if d % 2 else "\n".join([text[:60]] * 8)
        rows.append((d, text, "junk" if poor and rng.random() < 0.7 else "src"))
        if d % 3 == 0:
            lab.append((d, int(not poor), 0))
        pages.append((d, f"https://{'spam' if poor else 'fine'}.example.com/{d}"))
    page = spark.createDataFrame([*pages, (None, "x"), (5, None)], "doc_id long, url string")
    got = quality.score(docs(spark, rows), labels(spark, [*lab, (None, 0, 0), (1, None, 0)]), page).collect()
    assert len(got) == 900
    unseen = [r for r in got if r.doc_id % 3]
    assert sum(r.keep == bool(r.doc_id % 5) for r in unseen) / len(unseen) > 0.97
    assert sum((r.meta_score > 0.5) == bool(r.doc_id % 5) for r in unseen) / len(unseen) > 0.9


def test_quality_edges(spark):
    frame = docs(spark, EDGE)
    got = quality.score(frame, labels(spark, [(4, 1, 0), (7, 0, 0)])).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(docs(spark, []), labels(spark, [])).count() == 0


def test_drop_toxic_keeps_columns_of_any_name(spark):
    """Names that the operator could use itself, and rows as they were."""
    rows = [(i, f"text {i} {'vile' * (i % 2)}", "t", 1.5, "r", 1, None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _text string, _score double, `row` string, predicted int, `a b` string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(30)], "doc_id long, quality int, toxic int")
    got = toxicity.drop_toxic(df, labels)
    assert got.columns == df.columns and set(map(tuple, got.collect())) <= set(rows)
    assert toxicity.drop_toxic(df.limit(0), labels).count() == 0
