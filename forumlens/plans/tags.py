"""Q6 tag embeddings and Q7 tag prediction.

Tag text is split with a built-in regex function and exploded with
``explode``; counting is a partial-aggregated ``groupBy``.  Word2Vec on tag arrays
is in ``embeddings`` (reproducible to the last bit); the logistic regressions are
``pyspark.ml`` estimators that share one featurisation (Tokenizer + HashingTF).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.operators.topk import ranked_top_k
from forumlens.plans import embeddings, logistic
from forumlens.plans.embeddings import TagEmbeddings
from forumlens.sources import xml_dump

# Reference parameters.
W2V_VECTOR_SIZE = 100
W2V_SEED = 42
SYNONYMS = 25
SYNONYM_WORD = "ggplot2"
TOP_TAGS = 100
LR_MAX_ITER = 10
LR_REG_PARAM = 0.01
NUM_FEATURES = 1 << 18  # HashingTF default
TRIAL_TAG = "r"


def tagged(posts: DataFrame) -> DataFrame:
    """Posts that carry a Tags attribute (NULL = no attribute)."""
    return posts.where(F.col("tags").isNotNull())


def exploded_tags(posts: DataFrame) -> DataFrame:
    """``(id, tag, body)``: one row per tag of each tagged post."""
    return tagged(posts).select("id", F.explode("tags").alias("tag"), "body")


def tag_counts(posts: DataFrame) -> DataFrame:
    """``(tag, n)`` over exploded tags."""
    return exploded_tags(posts).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


def top_tags(posts: DataFrame, k: int = TOP_TAGS) -> DataFrame:
    """Q7 step 1: the ``k`` most used tags; ties by tag text.  ``rank, tag, n``."""
    top = ranked_top_k(tag_counts(posts), [F.col("n").desc(), F.col("tag").asc()], k)
    return top.select("rank", "tag", "n")


# ------------------------------------------------------------------ Q6 --

# Parts that train copies of the model; their number is part of the result, so it is a
# constant and never taken from the layout of the input.
W2V_PARTITIONS = 8
MISSING_BODY = "-999"    # text of a post without a body


def fit_tag_embeddings(posts: DataFrame, vector_size: int = W2V_VECTOR_SIZE,
                       seed: int = W2V_SEED, num_partitions: int = W2V_PARTITIONS,
                       min_count: int = 5, iterations: int = 1) -> TagEmbeddings:
    """Word2Vec over the tag arrays of tagged posts.

    The vocabulary are the tags with >= ``min_count`` uses.  ``num_partitions`` parts
    train copies that are averaged; all orders are fixed (see ``embeddings``), so the
    vectors depend on the arguments and the posts only, to the last bit, not on files,
    partitions or cores.
    """
    return embeddings.fit(tagged(posts).select("id", "tags"), tag_counts(posts), vector_size, seed, num_partitions,
                          min_count, iterations)


def tag_vectors(model: TagEmbeddings) -> DataFrame:
    """``(word, vector ARRAY<DOUBLE>)`` for the whole vocabulary."""
    return model.vectors.select("word", "vector")


def vocabulary(model: TagEmbeddings, posts: DataFrame) -> DataFrame:
    """``(word, n)``: the model's vocabulary with each word's use count.

    Must equal the tags used at least ``min_count`` times; the vocabulary side
    is small (distinct frequent tags), the counts are a partial aggregate.
    """
    words = model.vectors.select(F.col("word").alias("tag"))
    return tag_counts(posts).join(words, "tag").select(F.col("tag").alias("word"), "n")


def synonyms(model: TagEmbeddings, word: str = SYNONYM_WORD, n: int = SYNONYMS) -> DataFrame:
    """``(rank, word, similarity)``: the ``n`` tags closest to ``word`` by cosine; none when
    ``word`` is outside the vocabulary."""
    own = model.vectors.where(F.col("word") == word).select("vector").scalar()
    others = model.vectors.where(F.col("word") != word).select("word", "vector", own.alias("own"))
    found = others.where(F.col("own").isNotNull()).select("word", embeddings.cosine(F.col("vector"), F.col("own")).alias("similarity"))
    return ranked_top_k(found, [F.col("similarity").desc(), F.col("word").asc()], n).select(
        "rank", "word", "similarity")


def post_vectors(model: TagEmbeddings, posts: DataFrame) -> DataFrame:
    """``(post_id, vector)``: the mean tag vector of each tagged post."""
    return embeddings.mean_vectors(model, tagged(posts))


def post_vectors_by_join(model: TagEmbeddings, posts: DataFrame) -> DataFrame:
    """``post_vectors`` as a join and sums, to check it by: one row a post and tag is shuffled."""
    size = F.size("tags").alias("n")
    each = tagged(posts).select(F.col("id").alias("post_id"), size, F.explode_outer("tags").alias("word"))
    dims = model.vectors.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]
    joined = each.join(model.vectors, "word", "left")
    sums = [F.coalesce(F.sum(F.get("vector", F.lit(i))), F.lit(0.0)) / F.greatest(F.max("n"), F.lit(1)) for i in range(dims)]
    return joined.groupBy("post_id").agg(F.array(*sums).cast("array<double>").alias("vector"))


# ------------------------------------------------------------------ Q7 --

def body_text() -> Column:
    """The body, with the fixed text for a missing one."""
    return F.coalesce("body", F.lit(MISSING_BODY)).alias("body")


def featurizer(num_features: int = NUM_FEATURES) -> Pipeline:
    """Body text -> lower-cased white-space tokens -> hashed term counts."""
    return Pipeline(stages=[
        Tokenizer(inputCol="body", outputCol="words"),
        HashingTF(inputCol="words", outputCol="features", numFeatures=num_features),
    ])


def tokens(posts: DataFrame) -> DataFrame:
    """``(post_id, words)`` as the Tokenizer produces them."""
    tok = Tokenizer(inputCol="body", outputCol="words")
    return tok.transform(posts.select("id", body_text())).select(
        F.col("id").alias("post_id"), "words")


def logistic_regression() -> LogisticRegression:
    return LogisticRegression(maxIter=LR_MAX_ITER, regParam=LR_REG_PARAM)


def one_tag_model(train: DataFrame, tag: str = TRIAL_TAG, num_features: int = NUM_FEATURES):
    """The single-tag model: tokenise + hash each body once, explode the
    tags, label 1 for rows of ``tag``, fit logistic regression."""
    return logistic_regression().fit(tag_rows(train, tag, num_features))


def tag_rows(train: DataFrame, tag: str, num_features: int) -> DataFrame:
    """``(label, features)``: one row per tag of each tagged post, label 1 for ``tag``."""
    feats = featurizer(num_features).fit(train).transform(tagged(train).select("tags", body_text()))
    return feats.select(F.explode("tags").alias("tag"), "features").select(
        (F.col("tag") == tag).cast("double").alias("label"), "features")


def certificate(model, rows: DataFrame, reg: float = LR_REG_PARAM) -> DataFrame:
    """How good a fitted binary model is on its training rows, from sums over the rows taken in one pass.

    One row: ``n_rows, n_positive, iterations, loss_start, loss_end, loss_stated, gradient_start,
    gradient_end, falls``.  The loss is the mean log loss plus reg / 2 times the squared coefficients, each
    times its feature's deviation; the gradient is that of the same function.  ``start`` is the
    model without coefficients, whose intercept is the log odds; ``loss_stated`` the estimator's
    own last value, ``falls`` whether its values never rise.
    """
    spark = rows.sparkSession
    w, history = model.coefficients.toArray(), list(model.summary.objectiveHistory)
    state = spark.sparkContext.broadcast((w, float(model.intercept)))

    def add(total, block):
        w, b = state.value
        x, at, j = block["x"], block["at"], block["j"]
        row = np.repeat(np.arange(len(block["weight"])), block["sizes"])
        yes = np.bincount(block["label_row"], minlength=len(block["weight"]))
        m = np.bincount(row, w[at].take(j) * x, len(yes)) + b
        e = np.exp(-np.abs(m))
        p = np.where(m >= 0, 1.0, e) / (1.0 + e)
        for i, factor in enumerate((None, x, yes.take(row), p.take(row))):
            total[i, at] += np.bincount(j, x if factor is None else factor * x, len(at))
        total[:3, -1] += len(yes), yes.sum(), (np.log1p(e) + np.maximum(m, 0.0) - yes * m).sum()

    positives = F.when(F.col("label") == 1, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    each = logistic.blocks(rows.select(positives.alias("labels"), F.lit(1).alias("n"), "features"))
    sums = logistic.summed(each, (4, len(w) + 1), add)
    state.unpersist()
    n, positive, loss = (float(v) for v in sums[:3, -1])
    s, ss, of_label, of_p = sums[:, :-1]
    sd = logistic.deviations(s, ss, n)
    some, odds = sd > 0, positive / n
    gradient_start = (odds * s - of_label)[some] / n / sd[some]
    gradient_end = (of_p - of_label)[some] / n / sd[some] + reg * (w * sd)[some]
    start = -(odds * math.log(odds) + (1 - odds) * math.log(1 - odds)) if 0 < odds < 1 else 0.0
    found = (int(n), int(positive), len(history) - 1, start, loss / n + reg / 2 * float(((w * sd) ** 2).sum()), float(history[-1]),
             float(np.linalg.norm(gradient_start)), float(np.linalg.norm(gradient_end)),
             all(b <= a for a, b in zip(history, history[1:])))
    return spark.createDataFrame([found], "n_rows bigint, n_positive bigint, iterations int, loss_start double, loss_end double, "
                                          "loss_stated double, gradient_start double, gradient_end double, falls boolean")


def one_tag_probabilities(train: DataFrame, test: DataFrame, tag: str = TRIAL_TAG,
                          num_features: int = NUM_FEATURES) -> DataFrame:
    """``(post_id, p_not_tag, p_tag)`` of the single-tag model on test posts."""
    model = one_tag_model(train, tag, num_features)
    test_feats = featurizer(num_features).fit(test).transform(
        tagged(test).select("id", body_text()))
    prob = vector_to_array("probability")
    return model.transform(test_feats).select(
        F.col("id").alias("post_id"), prob[0].alias("p_not_tag"), prob[1].alias("p_tag"))


def training_rows(train: DataFrame, names: list[str | None], num_features: int = NUM_FEATURES,
                  per_post: bool = False) -> DataFrame:
    """One row a tagged post: ``labels`` (the places in ``names`` of its tags), ``n`` and ``features``.

    The row stands for ``n`` training rows, one for each of its tags (``per_post``: for one, with the
    distinct labels); bodies are featurised once and never repeated.
    """
    feats = featurizer(num_features).fit(train).transform(
        tagged(train).select("id", "tags", body_text()))
    places = F.create_map(*[F.lit(v) for i, name in enumerate(names) if name is not None for v in (name, i)])
    known = F.filter("tags", lambda t: t.isNotNull())
    labels = F.array_compact(F.transform(known, lambda t: F.element_at(places, t)))
    n = F.lit(1) if per_post else F.size("tags")
    return feats.select((F.array_distinct(labels) if per_post else labels).alias("labels"), n.alias("n"), "features")


def training_bytes(train: DataFrame, per_tag: bool) -> int:
    """Size of the featurised training rows: 12 bytes a distinct word (index and count) and 64 a row,
    times the tags of a post where each is a row (hash collisions only make it less)."""
    words = F.size(F.array_distinct(F.split(F.lower(body_text()), r"\s")))
    row = (words * 12 + 64).cast("bigint") * (F.size("tags") if per_tag else F.lit(1))
    return int(tagged(train).agg(F.sum(row)).first()[0] or 0)


def fits_at_once(parallelism: int, row_bytes: int, storage_bytes: int) -> int:
    """How many binary models are fitted at a time.

    Each model needs ``row_bytes`` of its own on the executors.  All together, and one more, take at
    most half their storage memory, whatever ``parallelism`` asks for; one model is always fitted.
    """
    copies = storage_bytes // 2 // max(1, row_bytes) - 1
    return max(1, min(parallelism, int(copies)))


def storage_memory(spark: SparkSession) -> int:
    """Storage memory of all executors, as they report it now."""
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    total = 0
    while status.hasNext():
        total += int(status.next()._1())
    return total


def tag_probabilities(train: DataFrame, test: DataFrame, k: int = TOP_TAGS,
                      num_features: int = NUM_FEATURES, parallelism: int = 8,
                      training: str = "exploded") -> DataFrame:
    """Q7: for each of the ``k`` top training tags and each tagged test post,
    the probability that the post does / does not carry the tag.

    One binary logistic regression per tag.  ``training="exploded"`` (the
    original program's choice) labels each (post, tag) row by whether its tag
    is that tag, one against the rest;
    ``training="per_post"`` uses one row per post, labelled by whether the
    post carries the tag.  The featurised posts are written once, one row each, and up to
    ``parallelism`` models are fitted in the same passes over them (``logistic.fit_all``), fewer
    where a weight and a gradient of each in every task would not fit (``fits_at_once``).
    Test posts are read and featurised once: every tag's
    model adds its margin to the same row, which is then exploded, so nothing of
    the test side is cached.
    Columns ``tag, post_id, p_not_tag, p_tag``.
    """
    # The <= k top tags are fetched once (bounded by k) and reused for the labels and the
    # output names, instead of re-aggregating the training tags for every use.
    spark = train.sparkSession
    ranked = sorted((r["rank"], r["tag"], r["n"]) for r in top_tags(train, k).collect())
    if not ranked:
        return spark.createDataFrame([], "tag string, post_id bigint, p_not_tag double, "
                                         "p_tag double")
    if training not in ("exploded", "per_post"):
        raise ValueError(f"unknown training {training!r}")
    rows = logistic.in_blocks(training_rows(train, [tag for _, tag, _ in ranked], num_features, training == "per_post"),
                              xml_dump.scratch_path(spark, "tag-rows"))
    model_bytes = 2 * 8 * num_features * spark.sparkContext.defaultParallelism
    models = logistic.fit_all(rows, len(ranked), num_features,
                              fits_at_once(parallelism, model_bytes, storage_memory(spark)), LR_REG_PARAM, LR_MAX_ITER)
    scored = (featurizer(num_features).fit(test)
              .transform(tagged(test).select(F.col("id").alias("post_id"), body_text()))
              .select("post_id", "features"))
    margins = []
    for (_, tag, _), binary in zip(ranked, models):
        raw = f"raw_{len(margins)}"
        scored = binary.transform(scored, {binary.rawPredictionCol: raw, binary.probabilityCol: "",
                                           binary.predictionCol: ""})
        margins.append(F.struct(F.lit(tag).alias("tag"), vector_to_array(raw)[1].alias("margin")))
    scored = scored.select("post_id", F.explode(F.array(*margins)).alias("m"))
    return scored.select(
        F.col("m.tag").alias("tag"), "post_id",
        (1.0 / (1.0 + F.exp(F.col("m.margin")))).alias("p_not_tag"),
        (1.0 / (1.0 + F.exp(-F.col("m.margin")))).alias("p_tag"))
