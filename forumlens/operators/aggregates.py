"""Aggregation operators.

All of them are algebraic (sum, count, min/max, min_by), so Spark plans a
partial aggregate before the shuffle and a final one after it: a key that
holds a third of all rows is first reduced to one row per task, and only those
partial rows cross the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.columns import ANSWER, DOWNVOTE, QUESTION, UPVOTE, indicator, ratio


def pair_counts(df: DataFrame, keys: Sequence[str | Column], hit: Column, seen: Column,
                hit_name: str = "n_hit", seen_name: str = "n_seen") -> DataFrame:
    """Per key: how many rows satisfy ``hit`` and how many satisfy ``seen``.

    The DataFrame form of mapping each row to ``(hit?1:0, seen?1:0)`` and
    adding the pairs per key.
    """
    return df.groupBy(*keys).agg(
        F.sum(indicator(hit)).cast("bigint").alias(hit_name),
        F.sum(indicator(seen)).cast("bigint").alias(seen_name),
    )


def vote_counts_per_post(votes: DataFrame) -> DataFrame:
    """``(post_id, n_up, n_updown)`` - every vote row counts, other types as (0, 0)."""
    t = F.col("vote_type_id")
    return pair_counts(votes, ["post_id"], t == UPVOTE, t.isin(UPVOTE, DOWNVOTE),
                       "n_up", "n_updown")


def activity_per_owner(posts: DataFrame) -> DataFrame:
    """``(owner_user_id, n_posts, n_answers, n_qa)`` over posts with an owner.

    One partial-aggregated pass serves the answer share (Q2) and the post
    counts (Q3); a prolific owner collapses to one row per task before the
    shuffle.
    """
    t = F.col("post_type_id")
    return (posts.where(F.col("owner_user_id").isNotNull())
            .groupBy("owner_user_id")
            .agg(F.count(F.lit(1)).alias("n_posts"),
                 F.sum(indicator(t == ANSWER)).cast("bigint").alias("n_answers"),
                 F.sum(indicator(t.isin(QUESTION, ANSWER))).cast("bigint").alias("n_qa")))


EPOCH_NTZ = "1970-01-01 00:00:00"
_TIE_OFFSET = 2 ** 63   # shifts any BIGINT tie-breaker to [0, 2^64)
_TIE_SPAN = 10 ** 20    # > 2^64, so the tie-breaker never reaches the time digits


def packed_order_key(ts: str | Column, tie: str | Column) -> Column:
    """``(ts, tie)`` packed into one ``DECIMAL(38,0)`` that sorts the same way.

    ``micros(ts) * 10^20 + (tie + 2^63)``: fixed width, so aggregates over it
    run as hash aggregates instead of sorting their input.  NULL when ``ts``
    or ``tie`` is NULL (such rows are never the minimum).
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    tie = F.col(tie) if isinstance(tie, str) else tie
    since = (ts - F.lit(EPOCH_NTZ).cast("timestamp_ntz")).cast("decimal(38,6)")
    micros = (since * 1_000_000).cast("decimal(38,0)")
    shifted = tie.cast("decimal(38,0)") + F.lit(str(_TIE_OFFSET)).cast("decimal(38,0)")
    return (micros * F.lit(str(_TIE_SPAN)).cast("decimal(38,0)") + shifted).cast("decimal(38,0)")


def first_per_key(df: DataFrame, key: str, values: Sequence[str], ts: str, tie: str,
                  out: str = "first") -> DataFrame:
    """Per ``key`` the ``values`` of the row with the smallest ``(ts, tie)``.

    One ``min_by`` per value over a packed fixed-width ordering key: a
    partial hash aggregate (no sort, no window over a whole group), so a key
    holding a third of all rows is reduced map-side to one row per task.
    Put a unique column in ``tie`` to make the choice deterministic.
    """
    order = packed_order_key(ts, tie)
    agg = df.groupBy(key).agg(*[F.min_by(F.col(v), order).alias(v) for v in values])
    return agg.select(key, F.struct(*values).alias(out))


def pooled_ratio(num: str, den: str) -> Column:
    return ratio(F.col(num), F.col(den))
