"""Q4 quick answers by hour and Q5 veteran / brief user profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.columns import (
    ANSWER,
    QUESTION,
    indicator,
    ratio,
    shift_days,
    within_hours,
)
from forumlens.operators.aggregates import first_per_key, packed_order_key
from forumlens.operators.joins import broadcast_if_few

# Reference parameters.
QUICK_HOURS = 3
WINDOW_DAYS = (100, 150)
VETERAN, BRIEF = "veteran", "brief"
METRICS = ["score", "views", "answers", "favorites"]


# --------------------------------------------------------------------- Q4 --

def accepted_pairs(posts: DataFrame) -> DataFrame:
    """Questions joined to their accepted answers, once.

    ``(question_id, answer_id, q_created, a_created)``; both type filters sit
    below the join, so only questions with an accepted id and only answers are
    shuffled.  An answer id accepted by very many questions is a skewed key on
    the question side; adaptive execution splits that partition.
    """
    q = (posts.where((F.col("post_type_id") == QUESTION) & F.col("accepted_answer_id").isNotNull())
         .select(F.col("id").alias("question_id"), F.col("accepted_answer_id").alias("answer_id"),
                 F.col("creation_date").alias("q_created")))
    a = (posts.where(F.col("post_type_id") == ANSWER)
         .select(F.col("id").alias("answer_id"), F.col("creation_date").alias("a_created")))
    return q.join(a, "answer_id")


def quick_answers(posts: DataFrame, hours: int = QUICK_HOURS) -> DataFrame:
    """Q4: per hour of day the question was asked, how many questions have an
    accepted answer and how many of those got it in under ``hours`` hours.

    Columns ``hour, n_answered, n_quick, quick_share`` (one conditional
    aggregate instead of two joined chains); hours without an answered
    question are absent, an hour without a quick answer has share 0.0.
    """
    pairs = accepted_pairs(posts)
    quick = within_hours("q_created", "a_created", hours)
    by_hour = (pairs.groupBy(F.hour("q_created").cast("int").alias("hour"))
               .agg(F.count(F.lit(1)).alias("n_answered"),
                    F.sum(indicator(quick)).cast("bigint").alias("n_quick")))
    return by_hour.select("hour", "n_answered", "n_quick",
                          ratio("n_quick", "n_answered").alias("quick_share"))


# --------------------------------------------------------------------- Q5 --

def posting_days(posts: DataFrame) -> DataFrame:
    """``(owner_user_id, day, first_ts, last_ts)``: posts collapsed per owner and day.

    Enough to decide exactly whether an owner posted inside a window of at
    least one day: a day-group has a post in ``[lo, hi)`` iff
    ``last_ts >= lo and first_ts < hi`` (a group spans less than a day, so it
    cannot straddle the whole window).  A prolific owner becomes at most one
    row per active day, reduced map-side.
    """
    return (posts.where(F.col("owner_user_id").isNotNull())
            .groupBy("owner_user_id", F.to_date("creation_date").alias("day"))
            .agg(F.min("creation_date").alias("first_ts"),
                 F.max("creation_date").alias("last_ts")))


def window_flags(posts: DataFrame, users: DataFrame,
                 window_days: tuple[int, int] = WINDOW_DAYS) -> DataFrame:
    """``(user_id, in_window)`` for users with at least one post.

    ``in_window`` is true when some post of the user was created between
    ``lo`` and ``hi`` days (``lo`` inclusive, whole 24-hour days) after the user.
    """
    u = users.select(F.col("id").alias("user_id"), F.col("creation_date").alias("u_created"))
    days = posting_days(posts)
    joined = u.join(days, F.col("user_id") == F.col("owner_user_id"))
    return joined.groupBy("user_id").agg(F.bool_or(_window_hit(window_days)).alias("in_window"))


def _window_hit(window_days: tuple[int, int]) -> Column:
    """Whether a (user, day) row holds a post inside the user's window."""
    lo, hi = window_days
    if hi - lo < 1:
        raise ValueError("the window must span at least one day")
    return ((F.col("last_ts") >= shift_days("u_created", lo))
            & (F.col("first_ts") < shift_days("u_created", hi)))


def window_post_counts(posts: DataFrame, users: DataFrame,
                       window_days: tuple[int, int] = WINDOW_DAYS) -> DataFrame:
    """``(user_id, n_window)``: exact number of joined posts inside the window.

    Posts are counted per (owner, day) first, so an owner with a third of all posts
    is one row a day and task.  A day inside the window counts whole; of the two days its
    borders fall on, one whose first and last post lie on one side of the border is decided too.
    Only posts of the remaining (owner, day) pairs, at most two a user, are compared one by
    one: the pairs are sent to the scan while they are few, and joined on owner and day, which
    spreads a prolific owner over the days, beyond that.
    """
    lo, hi = window_days
    if hi - lo < 1:
        raise ValueError("the window must span at least one day")
    u = users.select(F.col("id").alias("user_id"), F.col("creation_date").alias("u_created"))
    u = u.select("user_id", shift_days("u_created", lo).alias("lo"), shift_days("u_created", hi).alias("hi"))
    day = F.to_date("creation_date").alias("day")
    owned = posts.where(F.col("owner_user_id").isNotNull()).select("owner_user_id", day, "creation_date")
    days = owned.groupBy("owner_user_id", "day").agg(
        F.count(F.lit(1)).alias("n"), F.min("creation_date").alias("first_ts"), F.max("creation_date").alias("last_ts"))
    seen = u.join(days, F.col("user_id") == F.col("owner_user_id"))
    whole = (F.col("first_ts") >= F.col("lo")) & (F.col("last_ts") < F.col("hi"))
    outside = (F.col("last_ts") < F.col("lo")) | (F.col("first_ts") >= F.col("hi"))
    decided = seen.select("user_id", F.when(whole, F.col("n")).otherwise(0).cast("bigint").alias("n"))
    open_days = seen.where(~whole & ~outside).select("user_id", F.col("day").alias("open_day"), "lo", "hi")
    near = owned.join(broadcast_if_few(open_days), (F.col("owner_user_id") == F.col("user_id")) & (F.col("day") == F.col("open_day")))
    inside = (F.col("creation_date") >= F.col("lo")) & (F.col("creation_date") < F.col("hi"))
    compared = near.groupBy("user_id").agg(F.sum(indicator(inside)).cast("bigint").alias("n"))
    return decided.union(compared).groupBy("user_id").agg(F.sum("n").alias("n_window"))


def cohorts(posts: DataFrame, users: DataFrame,
            window_days: tuple[int, int] = WINDOW_DAYS) -> DataFrame:
    """``(user_id, cohort)``: veteran if a post falls in the window, else brief."""
    flags = window_flags(posts, users, window_days)
    return flags.select("user_id", F.when(F.col("in_window"), F.lit(VETERAN))
                        .otherwise(F.lit(BRIEF)).alias("cohort"))


def metric_columns(posts: DataFrame) -> DataFrame:
    """Question metrics with a missing value read as 0, as DOUBLE; a value that is not
    whole comes from the fraction column, where the table has one."""
    def value(src: str) -> Column:
        other = [F.col(f"{src}_fraction")] if f"{src}_fraction" in posts.columns else []
        return F.coalesce(F.col(src).cast("double"), *other, F.lit(0.0))

    return posts.select(
        "id", "owner_user_id", "post_type_id", "creation_date",
        *[value(src).alias(dst) for src, dst in
          [("score", "score"), ("view_count", "views"), ("answer_count", "answers"),
           ("favorite_count", "favorites")]])


def first_questions(posts: DataFrame) -> DataFrame:
    """``(owner_user_id, first)``: metrics of each owner's earliest question
    (equal creation times: smallest post id)."""
    q = metric_columns(posts).where(
        (F.col("post_type_id") == QUESTION) & F.col("owner_user_id").isNotNull())
    return first_per_key(q, "owner_user_id",
                         ["id", "score", "views", "answers", "favorites"],
                         ts="creation_date", tie="id")


def _question_days(posts: DataFrame) -> DataFrame:
    """``posting_days`` with, per day, whether a question was asked (``asked`` 0 / 1)
    and the earliest one's order key and metrics."""
    asked = F.coalesce(F.col("post_type_id") == QUESTION, F.lit(False))
    p = (metric_columns(posts).where(F.col("owner_user_id").isNotNull())
         .withColumn("asked", asked)
         .withColumn("order", F.when(F.col("asked"), packed_order_key("creation_date", "id"))))
    return (p.groupBy("owner_user_id", F.to_date("creation_date").alias("day"))
            .agg(F.min("creation_date").alias("first_ts"), F.max("creation_date").alias("last_ts"),
                 F.max(indicator(F.col("asked"))).alias("asked"), F.min("order").alias("first_order"),
                 *[F.min_by(m, "order").alias(m) for m in METRICS]))


def veterans(posts: DataFrame, users: DataFrame,
             window_days: tuple[int, int] = WINDOW_DAYS) -> DataFrame:
    """Q5: first-question profile of veteran and brief users.

    Columns ``cohort, n_users, n_with_question, avg_score, avg_views,
    avg_answers, avg_favorites``.  Users without posts are in no cohort; users
    without a question count in ``n_users`` only; a cohort with no users has
    no row.  Posts are read once: the (owner, day) rows that decide the cohort
    carry each day's earliest question.
    """
    u = users.select(F.col("id").alias("user_id"), F.col("creation_date").alias("u_created"))
    joined = u.join(_question_days(posts), F.col("user_id") == F.col("owner_user_id"))
    per_user = joined.groupBy("user_id").agg(
        F.bool_or(_window_hit(window_days)).alias("in_window"), F.max("asked").alias("asked"),
        *[F.min_by(m, "first_order").alias(m) for m in METRICS])
    cohort = F.when(F.col("in_window"), F.lit(VETERAN)).otherwise(F.lit(BRIEF)).alias("cohort")
    return per_user.groupBy(cohort).agg(
        F.count(F.lit(1)).alias("n_users"),
        F.sum("asked").cast("bigint").alias("n_with_question"),
        *[F.avg(m).alias(f"avg_{m}") for m in METRICS])
