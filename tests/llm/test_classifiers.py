"""Quality, toxicity and language: held-out accuracy, and defined results for odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from docpipe.llm import langid, quality, toxicity
from docpipe.llm._fit import isotonic

from .helpers import documents, odd_rows, prose, with_clashes

LABELS = "doc_id long, quality int, toxic int"
TOXIC = ["vile", "scumbag", "loathsome", "worthless"]


def corpus(n=600):
    docs, labels = [], []
    for i in range(n):
        good, bad = i % 4 != 0, i % 5 == 0
        words = prose(i, 60 + i % 50).split()
        if bad:
            words[10:10] = [TOXIC[i % 4], TOXIC[(i // 5) % 4]]
        text = " ".join(words) if good else " | ".join(words)
        docs.append((i, text))
        labels.append((i, int(good), int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = corpus()
    odd = [(None, 1, 1), (0, None, None), (5, 1, 1), (5, 1, 1), (99_999, 1, 0)]
    return with_clashes(documents(spark, docs + odd_rows())), spark.createDataFrame(labels + odd, LABELS), {d: (q, t) for d, q, t in labels}


@pytest.mark.parametrize("kind", ["quality", "toxicity"])
def test_scores(kind, data):
    docs, labels, truth = data
    run, parts, held, cut, at = (quality.quality, 4, 2, 0.7, 0) if kind == "quality" else (toxicity.toxicity, 5, 0, 0.5, 1)
    rows = run(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % parts == held) for r in rows)
    known = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id][at] for r in known]) > 0.95
    same = [r.score for r in rows if r.doc_id == 1004]
    assert same[0] == same[1]


@pytest.mark.parametrize("run", [quality.quality, toxicity.toxicity])
def test_without_labels(run, spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in run(docs, none).collect()} == {0.5}
    one_kind = spark.createDataFrame([(i, 1, 1) for i in range(50)], LABELS)
    assert {r.score for r in run(documents(spark, [(i, "a b c") for i in range(50)]), one_kind).collect()} == {1.0}
    assert run(documents(spark, []), none).count() == 0


def test_keep_good(data):
    docs, labels, truth = data
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    good = {d for d, (q, _) in truth.items() if q}
    assert len(good - ids) <= 0.02 * len(good) and len({d for d, (q, _) in truth.items() if not q} & ids) <= 3


def test_counterfactual_penalty(spark):
    """A term that goes with the label by chance keeps a weight without the penalty, and loses it with it."""
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = prose(i, 40).split()
        words[5:5] = (["muslim"] if bad or i % 40 == 1 else ["christian"] if i % 8 == 2 else []) + ([TOXIC[i % 3]] if bad and i % 3 else [])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    df, lab = documents(spark, docs), spark.createDataFrame(labels, LABELS)
    gap = {}
    for penalty in (0.0, 50.0):
        m = toxicity.fit_toxicity(df, lab, penalty=penalty)
        margin = lambda w: m.margin(toxicity.features_of({w}))
        gap[penalty] = abs(margin(b"muslim") - margin(b"jewish"))
    assert gap[50.0] < 0.3 * gap[0.0]


def test_isotonic():
    x, v = isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 1, 0.5, 1]), np.ones(4))
    assert list(v) == [0.0, 0.75, 1.0] and list(x) == [0.0, 1.5, 3.0]


STEMS = {"aa": ["ka", "to", "mi"], "bb": ["ül", "ög", "äb"], "cc": ["eñ", "ció", "que"], "dd": ["wh", "th", "sh"], "ee": ["zz", "xy", "qo"]}


def test_languages(spark):
    import random

    rows = []
    for i in range(300):
        lang = list(STEMS)[i % 5]
        rng = random.Random(i)
        rows.append((i, " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(30)), lang if i % 7 else None))
    docs = with_clashes(documents(spark, [*rows, *odd_rows(), (2000, "123 !? 😀")]))
    got = langid.predict_languages(docs).collect()
    assert len(got) == docs.count()
    right = [r.lang_pred == list(STEMS)[r.doc_id % 5] for r in got if r.doc_id is not None and r.doc_id < 300]
    assert np.mean(right) > 0.97
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1000, 1001, 1002, 2000))
    assert all(r.lang_pred in {*STEMS, "en", "und"} and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_languages_without_training(spark):
    assert {r.lang_pred for r in langid.predict_languages(documents(spark, [(1, "abc", None), (2, None, "en")])).collect()} == {"und"}
    assert langid.predict_languages(documents(spark, [])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 4, 6, 9])
def test_codewords(n):
    m = langid.codewords(n)
    assert m.shape[0] == n and len({tuple(r) for r in m}) == n
    assert n < 2 or all(abs(c.sum()) < n for c in m.T)
