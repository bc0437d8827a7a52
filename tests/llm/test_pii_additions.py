"""Personal data in loose forms is added by the trees; decoys and the corpus's clean texts are not."""

import random

import pytest
from pyspark.sql import functions as F

from forumlens.llm import pii_boost

SF = "/root/testdata/sf0.1"


def luhn(d):
    x = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))]
    return sum(x) % 10 == 0


def made(rnd, i):
    """(text with personal data in a loose form, text with a decoy)."""
    d = "".join(str(rnd.randrange(10)) for _ in range(15))
    card = next(d + str(k) for k in range(10) if luhn(d + str(k)))
    wrong = card[:-1] + str((int(card[-1]) + 3) % 10)
    four = lambda c: ".".join(c[k:k + 4] for k in range(0, 16, 4))
    a, b, n = rnd.randrange(256), rnd.randrange(256), rnd.randrange(1000, 9999)
    return [(f"please mail john.doe{i} [at] example [dot] org for more", "we meet @ noon. Bring food"),
            (f"you may call (619) 555-{n} at noon", f"we sold 619 555 {n} units in all"),
            (f"pay with card {four(card)} today", f"number {four(wrong)} of the list"),
            (f"the server at 10, {a}, {b}, 7 is down", f"scores were 10, {a}, {b}, 7 in the end")][i % 4]


@pytest.fixture(scope="module")
def model(spark):
    return pii_boost.train(spark.read.parquet(f"{SF}/documents.parquet"))


def test_loose_forms_are_added_and_decoys_are_not(spark, model, monkeypatch):
    trees, cuts = model
    assert trees and set(cuts) == {0, 1, 2, 3}
    monkeypatch.setattr(pii_boost, "train", lambda docs: model)
    rnd = random.Random(1)
    pairs = [made(rnd, i) for i in range(200)]
    rows = [(2 * i + j, t) for i, pair in enumerate(pairs) for j, t in enumerate(pair)]
    got = {r.doc_id: r.spans for r in pii_boost.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = [bool(got[2 * i]) for i in range(200)]
    assert all(sum(hit[k::4]) >= 45 for k in range(4)), [sum(hit[k::4]) for k in range(4)]
    assert sum(bool(got[2 * i + 1]) for i in range(200)) <= 4


def test_texts_of_the_corpus_gain_little(spark, model, monkeypatch):
    """Its personal data is in the base formats, so what is added there is an error."""
    monkeypatch.setattr(pii_boost, "train", lambda docs: model)
    found = pii_boost.find(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    n_base = F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone")
    n_all = F.size(F.filter(F.split("spans", ","), lambda x: x != ""))
    base, every = found.agg(F.sum(n_base), F.sum(n_all)).first()
    assert base <= every <= 1.02 * base


def test_no_examples_no_trees(spark):
    df = spark.createDataFrame([(1, "12 34 56"), (2, None)], "doc_id long, text string")
    assert pii_boost.train(df) == ([], {}) and [r.spans for r in pii_boost.find(df).collect()] == ["", ""]
