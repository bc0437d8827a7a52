"""Q1-Q3: upvote ratio, answer share, post counts.

Every analysis is ``(typed tables, parameters) -> DataFrame``; the defaults are
the reference's parameters.  Plans pre-aggregate the many side of each join
(votes per post, posts per owner) so the join inputs are about one row per key
and a hot key is reduced map-side before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.operators.aggregates import activity_per_owner, pooled_ratio, vote_counts_per_post
from forumlens.operators.topk import ranked_top_k

# Reference parameters.
Q1_KEYS = 50
Q2_USERS = 99
Q3_COUNTS = 100
MEAN_ROW_USER_ID = -1


def post_favorites(posts: DataFrame) -> DataFrame:
    """``(id, favorite_count)`` with a missing favourite count read as 0."""
    return posts.select("id", F.coalesce(F.col("favorite_count"), F.lit(0)).cast("bigint")
                        .alias("favorite_count"))


def upvote_counts_by_favorites(posts: DataFrame, votes: DataFrame) -> DataFrame:
    """``(favorite_count, n_up, n_updown)`` pooled over every joined vote."""
    per_post = vote_counts_per_post(votes)
    joined = post_favorites(posts).join(per_post, F.col("id") == F.col("post_id"))
    return (joined.groupBy("favorite_count")
            .agg(F.sum("n_up").cast("bigint").alias("n_up"),
                 F.sum("n_updown").cast("bigint").alias("n_updown")))


def upvote_ratio(posts: DataFrame, votes: DataFrame, k: int = Q1_KEYS) -> DataFrame:
    """Q1: upvotes / (upvotes + downvotes) per favourite count, ``k`` smallest counts.

    Columns ``rank, favorite_count, upvote_ratio``; the ratio is NULL when a
    count's posts have only other vote types.
    """
    agg = upvote_counts_by_favorites(posts, votes)
    ratios = agg.select("favorite_count", pooled_ratio("n_up", "n_updown").alias("upvote_ratio"))
    top = ranked_top_k(ratios, [F.col("favorite_count").asc()], k)
    return top.select("rank", "favorite_count", "upvote_ratio")


def answer_counts_per_user(posts: DataFrame, users: DataFrame,
                           per_owner: DataFrame | None = None) -> DataFrame:
    """``(reputation, user_id, n_answers, n_qa)`` per (reputation, user).

    ``per_owner`` may pass a precomputed ``activity_per_owner(posts)`` shared
    with other analyses.
    """
    per_owner = activity_per_owner(posts) if per_owner is None else per_owner
    joined = users.select("id", "reputation").join(
        per_owner, F.col("id") == F.col("owner_user_id"))
    return (joined.groupBy("reputation", F.col("id").alias("user_id"))
            .agg(F.sum("n_answers").cast("bigint").alias("n_answers"),
                 F.sum("n_qa").cast("bigint").alias("n_qa")))


def answer_share(posts: DataFrame, users: DataFrame, k: int = Q2_USERS,
                 per_owner: DataFrame | None = None) -> DataFrame:
    """Q2: share of answers among a user's questions+answers for the ``k`` users
    of highest reputation (ties: user id compared as text), plus one mean row.

    Columns ``row_kind, rank, user_id, answer_share``.  The mean row has
    ``row_kind='mean'``, ``user_id=-1`` and rank ``n+1``; users whose share is
    undefined (NULL) do not enter the mean; with no user rows there is no
    mean row.  The mean is taken over the <= k rows left after the top-k
    (a window over that bounded set), so the join and aggregation run once.
    """
    per_user = answer_counts_per_user(posts, users, per_owner).select(
        "reputation", "user_id", pooled_ratio("n_answers", "n_qa").alias("answer_share"))
    order = [F.col("reputation").desc(), F.col("user_id").cast("string").asc()]
    top = ranked_top_k(per_user, order, k)
    everything = Window.partitionBy()
    top = (top.withColumn("_n", F.count(F.lit(1)).over(everything))
              .withColumn("_mean", F.avg("answer_share").over(everything)))
    user_row = F.struct(F.lit("user").alias("row_kind"), F.col("rank"),
                        F.col("user_id"), F.col("answer_share"))
    mean_row = F.struct(F.lit("mean").alias("row_kind"), (F.col("_n") + 1).cast("int").alias("rank"),
                        F.lit(MEAN_ROW_USER_ID).cast("bigint").alias("user_id"),
                        F.col("_mean").alias("answer_share"))
    rows = F.when(F.col("rank") == F.col("_n"), F.array(user_row, mean_row)) \
        .otherwise(F.array(user_row))
    return top.select(F.inline(rows))


def posts_per_user(posts: DataFrame, users: DataFrame,
                   per_owner: DataFrame | None = None) -> DataFrame:
    """``(user_id, reputation, n_posts)``: joined posts per (user, reputation)."""
    per_owner = activity_per_owner(posts) if per_owner is None else per_owner
    per_owner = per_owner.select("owner_user_id", "n_posts")
    joined = users.select("id", "reputation").join(
        per_owner, F.col("id") == F.col("owner_user_id"))
    return (joined.groupBy(F.col("id").alias("user_id"), "reputation")
            .agg(F.sum("n_posts").cast("bigint").alias("n_posts")))


def post_counts(posts: DataFrame, users: DataFrame, k: int = Q3_COUNTS,
                per_owner: DataFrame | None = None) -> DataFrame:
    """Q3: the ``k`` largest per-user post counts with the mean reputation of
    the users having that count.  Columns ``rank, n_posts, avg_reputation``.
    """
    per_count = (posts_per_user(posts, users, per_owner).groupBy("n_posts")
                 .agg(F.avg(F.col("reputation").cast("double")).alias("avg_reputation")))
    top = ranked_top_k(per_count, [F.col("n_posts").desc()], k)
    return top.select("rank", "n_posts", "avg_reputation")
