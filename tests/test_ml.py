"""Model-based analyses: vocabulary, determinism, one-vs-rest equivalence."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_MID
from forumlens.plans import tags
from forumlens.sources import tables
from helpers import posts_df


def test_vocabulary_min_count(spark):
    rows = [{"id": i, "tags": ["common", "other"] if i % 2 else ["common"]} for i in range(20)]
    rows += [{"id": 100, "tags": ["rare"]}]
    m = tags.fit_tag_embeddings(posts_df(spark, rows), vector_size=8, num_partitions=1)
    words = {r["word"] for r in tags.tag_vectors(m).collect()}
    assert words == {"common", "other"}
    assert tags.synonyms(m, "rare", 5).count() == 0  # unknown word: no rows
    assert [r["word"] for r in tags.synonyms(m, "common", 5).collect()] == ["other"]


def test_same_seed_same_vectors(spark):
    t = tables.tagged_posts(spark, SF_MID)
    a = {r["word"]: r["vector"] for r in
         tags.tag_vectors(tags.fit_tag_embeddings(t, num_partitions=1)).collect()}
    b = {r["word"]: r["vector"] for r in
         tags.tag_vectors(tags.fit_tag_embeddings(t, num_partitions=1)).collect()}
    assert a == b and len(a) == 24 and len(next(iter(a.values()))) == 100


def test_post_vectors_one_per_tagged_post(spark):
    t = tables.tagged_posts(spark, SF_MID)
    m = tags.fit_tag_embeddings(t)
    assert tags.post_vectors(m, t).count() == tags.tagged(t).count()


@pytest.fixture(scope="module")
def split(spark):
    return tables.tagged_posts(spark, SF_MID, "train"), tables.tagged_posts(spark, SF_MID, "test")


def test_one_vs_rest_equals_separate_fits(spark, split):
    train, test = split
    k = 3
    ovr = tags.tag_probabilities(train, test, k=k, num_features=1 << 12)
    top = [r["tag"] for r in tags.top_tags(train, k).orderBy("rank").collect()]
    got = {(r["tag"], r["post_id"]): r["p_not_tag"] for r in ovr.collect()}
    assert {t for t, _ in got} == set(top)
    for tag in top:
        single = tags.one_tag_probabilities(train, test, tag, num_features=1 << 12).collect()
        for r in single:
            assert got[(tag, r["post_id"])] == pytest.approx(r["p_not_tag"], abs=1e-9)


def test_probabilities_sum_to_one(spark, split):
    train, test = split
    out = tags.tag_probabilities(train, test, k=2, num_features=1 << 12)
    s = out.select((F.col("p_not_tag") + F.col("p_tag")).alias("s")).collect()
    assert s and all(abs(r["s"] - 1) < 1e-12 for r in s)


def test_language_tag_better_than_chance(spark, split):
    train, test = split
    p = tags.one_tag_probabilities(train, test, "de", num_features=1 << 14)
    truth = test.select(F.col("id").alias("post_id"),
                        F.array_contains("tags", "de").alias("is_de"))
    j = p.join(truth, "post_id").collect()
    hits = sum((r["p_tag"] > 0.5) == r["is_de"] for r in j)
    base = max(sum(r["is_de"] for r in j), sum(not r["is_de"] for r in j))
    assert hits > base


def test_hashing_tf_counts_tokens(spark, split):
    train, _ = split
    t = train.limit(5)
    feats = tags.featurizer(1 << 10).fit(t).transform(t)
    for r in feats.select("words", vector_to_array("features").alias("v")).collect():
        assert sum(r["v"]) == len(r["words"])


def test_per_post_training_matches_single_fits(spark, split):
    train, test = split
    out = tags.tag_probabilities(train, test, k=2, num_features=1 << 12, training="per_post")
    top = [r["tag"] for r in tags.top_tags(train, 2).orderBy("rank").collect()]
    got = {(r["tag"], r["post_id"]): r["p_tag"] for r in out.collect()}
    from pyspark.ml.classification import LogisticRegression  # noqa: F401
    feats = tags.featurizer(1 << 12).fit(train).transform(tags.tagged(train))
    for tag in top:
        m = tags.logistic_regression().fit(
            feats.select(F.array_contains("tags", tag).cast("double").alias("label"), "features"))
        tf = tags.featurizer(1 << 12).fit(test).transform(tags.tagged(test))
        for r in m.transform(tf).select("id", vector_to_array("probability")[1].alias("p")).collect():
            assert got[(tag, r["id"])] == pytest.approx(r["p"], abs=1e-9)


def test_post_vector_is_mean_of_tag_vectors(spark):
    t = tables.tagged_posts(spark, SF_MID)
    m = tags.fit_tag_embeddings(t, num_partitions=1)
    vec = {r["word"]: r["vector"] for r in tags.tag_vectors(m).collect()}
    posts = {r["id"]: r["tags"] for r in t.select("id", "tags").limit(20).collect()}
    got = {r["post_id"]: r["vector"] for r in
           tags.post_vectors(m, t).where(F.col("post_id").isin(list(posts))).collect()}
    for pid, ts in posts.items():
        known = [vec[w] for w in ts if w in vec]
        want = [sum(c) / len(ts) for c in zip(*known)]
        assert got[pid] == pytest.approx(want, abs=1e-6)


def test_synonyms_are_cosine_ranked(spark):
    import math

    t = tables.tagged_posts(spark, SF_MID)
    m = tags.fit_tag_embeddings(t, num_partitions=1)
    vec = {r["word"]: r["vector"] for r in tags.tag_vectors(m).collect()}
    rows = tags.synonyms(m, "en", 5).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
    sims = [r["similarity"] for r in rows]
    assert sims == sorted(sims, reverse=True) and "en" not in [r["word"] for r in rows]

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(
            sum(x * x for x in a) * sum(y * y for y in b))
    for r in rows:
        assert r["similarity"] == pytest.approx(cos(vec["en"], vec[r["word"]]), abs=1e-4)


def test_no_tagged_training_posts_gives_no_rows(spark):
    p = posts_df(spark, [{"id": 1, "body": "no tags here"}])
    out = tags.tag_probabilities(p, p, k=3, num_features=1 << 8)
    assert out.count() == 0 and out.columns == ["tag", "post_id", "p_not_tag", "p_tag"]


def test_missing_body_is_a_fixed_text(spark):
    rows = [{"id": i, "tags": ["x"] if i % 2 else ["y"], "body": None if i % 5 == 0 else f"w{i % 3}"}
            for i in range(40)]
    posts = posts_df(spark, rows)
    out = tags.one_tag_probabilities(posts, posts, "x", num_features=1 << 8)
    assert out.count() == 40
    assert tags.tag_probabilities(posts, posts, k=2, num_features=1 << 8).count() == 80
    words = {r["post_id"]: r["words"] for r in tags.tokens(posts).collect()}
    assert words[0] == ["-999"] and len(words) == 40


def test_cached_copies_do_not_grow_with_parallelism(spark, split):
    gb = 1 << 30
    for parallelism in (1, 2, 8, 100, 10_000):
        n = tags.fits_at_once(parallelism, 3 * gb, 64 * gb)
        assert n <= parallelism and (n + 1) * 3 * gb <= 32 * gb
    assert tags.fits_at_once(10_000, 3 * gb, 64 * gb) == tags.fits_at_once(100, 3 * gb, 64 * gb) == 9
    assert tags.fits_at_once(8, 100 * gb, 64 * gb) == 1 and tags.fits_at_once(8, 0, 64 * gb) == 8
    assert tags.storage_memory(spark) > 100 << 20
    train, _ = split
    one, each = tags.training_bytes(train, False), tags.training_bytes(train, True)
    assert each == 2 * one > 12 * train.count()
    feats = tags.featurizer().fit(train).transform(train.select("id", tags.body_text()))
    kept = sum(12 * len(r["features"].indices) + 64 for r in feats.select("features").collect())
    assert kept <= one <= 1.1 * kept


def test_waves_give_the_same_models(spark, split, monkeypatch):
    train, test = split
    many = tags.tag_probabilities(train, test, k=2, num_features=1 << 8).collect()
    monkeypatch.setattr(tags, "storage_memory", lambda _: 1)
    few = tags.tag_probabilities(train, test, k=2, num_features=1 << 8).collect()
    key = lambda r: (r["tag"], r["post_id"])
    for a, b in zip(sorted(many, key=key), sorted(few, key=key)):
        assert key(a) == key(b) and a["p_tag"] == pytest.approx(b["p_tag"], abs=1e-9)
