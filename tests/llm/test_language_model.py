"""The language model against a plain softmax over every word, its fits, and what it gains."""

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from forumlens.llm import lm_lbl


@pytest.fixture(scope="module")
def rows(spark):
    return lm_lbl.split_rows(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).select(
        "doc_id", "text", "held_out")


@pytest.mark.parametrize("head", [1 << 18, 300])
def test_scores_are_those_of_a_softmax_over_all_words(rows, monkeypatch, head):
    monkeypatch.setattr(lm_lbl, "HEAD", head)
    m = lm_lbl.learned(rows.filter(~F.col("held_out")), steps=40)
    counts = {r.h: (r.cls, r.n) for r in m.counts.collect()}
    vectors = {r.h: np.array(r.v) for r in m.vectors.collect()}
    top = {int(h): 1 + i for i, h in enumerate(m.top)}
    cls = {h: 0 if h == lm_lbl.END_HASH else top.get(h, c) for h, (c, _) in counts.items()}
    assert {h for h, (_, n) in counts.items() if n >= lm_lbl.LEARN and cls[h] > lm_lbl.TOP} == set(vectors)
    members = collections.defaultdict(list)
    for h, c in cls.items():
        members[c].append(h)
    table = lm_lbl.log_table(m.params)

    def weight(h, a):
        return (counts[h][1] + 0.5) * math.exp(float(m.x[a] @ vectors[h]) if h in vectors else 0.0)

    sums = {}

    def size(a, c):                         # of all words of a class and one unseen word
        if (a, c) not in sums:
            sums[a, c] = sum(weight(h, a) for h in members[c]) + 0.5
        return sums[a, c]

    for a, c in [(0, 150), (3, 130), (140, 112), (155, 155)]:
        assert sum(weight(h, a) for h in members[c]) / 10 ** m.z[a, c] + 0.5 / 10 ** m.z[a, c] == pytest.approx(1)
    got = {r.doc_id: r.score for r in lm_lbl.scores(rows, steps=40).collect()}
    checked = 0
    for r in rows.orderBy("doc_id").limit(40).collect():
        total, one, two = 0.0, 0, 0
        for w in lm_lbl.tokens(r.text):
            h = lm_lbl.word_hash(w)
            c = 0 if h == lm_lbl.END_HASH else top.get(h, lm_lbl.suffix_class(w))
            total += table[two * lm_lbl.CLASSES + one, c]
            if c > lm_lbl.TOP:
                total += math.log10((weight(h, one) if h in counts else 0.5) / size(one, c))
            one, two = c, one
        assert got[r.doc_id] == pytest.approx(total, rel=1e-5)
        checked += 1
    assert checked == 40


def test_word_fit_reaches_the_optimum(monkeypatch):
    """The gradient of the objective vanishes, and a word bound to one context is likelier there."""
    monkeypatch.setattr(lm_lbl, "WORD_STEPS", 400)
    rng = np.random.default_rng(3)
    x = np.hstack([np.ones((lm_lbl.CLASSES, 1)), rng.normal(size=(lm_lbl.CLASSES, 5))])
    before = rng.integers(0, 400, lm_lbl.CLASSES).astype(float)
    n = rng.poisson(before * 0.01, (6, lm_lbl.CLASSES)).astype(float)
    n[0, 1:], n[0, 0] = 0, 50
    share = (n.sum(1) + 0.5) / before.sum()
    v = lm_lbl.fit_words(n, x, before, share)
    k = lm_lbl.WORD_NOISE
    true = 1 / (1 + np.exp(-(v @ x.T - np.log(k))))
    gradient = (n - (n + k * share[:, None] * before) * true) @ x - lm_lbl.RIDGE * v
    assert np.abs(gradient).max() < 1e-3 * n.sum()
    assert (x @ v[0])[0] > 1


def test_words_add_to_the_classes(spark, monkeypatch):
    """Held-out texts are likelier with the words' vectors than with the classes and counts alone, and than the base."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")

    def held():
        out = lm_lbl.scores(docs).filter("held_out")
        return out.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()

    whole, base, n = held()
    monkeypatch.setattr(lm_lbl, "LEARN", 1 << 60)
    classes, _, _ = held()
    print("held-out log10 per token: words", whole / n, "classes", classes / n, "base", base / n)
    assert whole / n > classes / n + 0.02 and classes / n > base / n + 0.1
