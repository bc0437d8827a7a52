"""Q7: the models of all tags share one stored set of rows and equal the estimator's."""

import numpy as np
import pytest
from pyspark.ml.classification import OneVsRest
from pyspark.sql import functions as F

from forumlens.plans import tags
from forumlens.sources import tables
from tests.conftest import SF_MID
from tests.helpers import posts_df


def test_shared_passes_equal_one_vs_rest(spark):
    train = tables.tagged_posts(spark, SF_MID, "train")
    top = [r["tag"] for r in tags.top_tags(train, 6).orderBy("rank").collect()]
    feats = tags.featurizer(1 << 12).fit(train).transform(tags.tagged(train).select("tags", tags.body_text()))
    places = F.create_map(*[F.lit(v) for i, t in enumerate(top) for v in (t, float(i))])
    rows = feats.select(F.explode("tags").alias("tag"), "features").select(
        F.coalesce(F.element_at(places, F.col("tag")), F.lit(6.0)).alias("label"), "features")
    want = OneVsRest(classifier=tags.logistic_regression(), parallelism=4).fit(rows).models[:6]
    stored = tags.xml_dump.scratch_path(spark, "rows")
    stored = tags.logistic.in_blocks(tags.training_rows(train, top, 1 << 12), stored)
    got = tags.logistic.fit_all(stored, 6, 1 << 12, 4, tags.LR_REG_PARAM, tags.LR_MAX_ITER)
    for a, b in zip(got, want):
        assert a.intercept == pytest.approx(b.intercept, abs=1e-8)
        assert np.abs(a.coefficients.toArray() - b.coefficients.toArray()).max() < 1e-8


def test_training_rows_are_one_a_post_and_nothing_is_cached(spark, monkeypatch):
    """One row a post, however many tags it has, and no copy of the rows in memory for any model."""
    train = posts_df(spark, [{"id": i, "tags": ["a", "b", "a", f"c{i % 3}"], "body": f"w{i % 5} w{i % 7}"} for i in range(60)])
    rows = tags.training_rows(train, ["a", "b", "c0"], 1 << 8)
    assert rows.count() == 60
    assert sorted((tuple(r["labels"]), r["n"]) for r in rows.select("labels", "n").distinct().collect()) == [
        ((0, 1, 0), 4), ((0, 1, 0, 2), 4)]
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    kept = []
    fit_all = tags.logistic.fit_all
    monkeypatch.setattr(tags.logistic, "fit_all", lambda *a: (fit_all(*a), kept.append(
        spark.sparkContext._jsc.sc().getPersistentRDDs().size()))[0])
    assert tags.tag_probabilities(train, train, k=3, num_features=1 << 8).count() == 180
    assert kept == [before]


def test_a_tag_on_every_row_is_certain(spark):
    posts = posts_df(spark, [{"id": i, "tags": ["only"], "body": f"w{i}"} for i in range(5)])
    assert {(r["p_tag"], r["p_not_tag"]) for r in tags.tag_probabilities(posts, posts, k=2, num_features=16).collect()} == {(1.0, 0.0)}


def test_certificate_sums_in_one_pass(spark):
    """No entry of a row is shuffled or stored: the plain sums over the rows give the same figures."""
    train = tables.tagged_posts(spark, SF_MID, "train")
    rows, model = tags.tag_rows(train, "en", 1 << 10), tags.one_tag_model(train, "en", 1 << 10)
    c = tags.certificate(model, rows).first()
    got = rows.collect()
    x, y = np.array([r["features"].toArray() for r in got]), np.array([r["label"] for r in got])
    w, sd = model.coefficients.toArray(), x.std(0, ddof=1)
    m = x @ w + model.intercept
    loss = (np.logaddexp(0, m) - y * m).mean() + tags.LR_REG_PARAM / 2 * ((w * sd) ** 2).sum()
    some = sd > 0
    end = (x.T @ (1 / (1 + np.exp(-m)) - y) / len(y))[some] / sd[some] + tags.LR_REG_PARAM * (w * sd)[some]
    start = (x.T @ (y.mean() - y) / len(y))[some] / sd[some]
    assert c["n_rows"] == len(y) and c["n_positive"] == y.sum()
    assert c["loss_end"] == pytest.approx(loss, abs=1e-9)
    assert c["gradient_end"] == pytest.approx(np.linalg.norm(end), abs=1e-9)
    assert c["gradient_start"] == pytest.approx(np.linalg.norm(start), abs=1e-9)
    assert not hasattr(tags, "_entries")
