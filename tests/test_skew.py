"""A key holding a third of all rows: results stay whole and the work is split."""

from datetime import timedelta

import pytest

from forumlens.plans import engagement, timing
from helpers import T0, posts_df, users_df, votes_df

N = 3000


def skewed_posts(spark):
    rows = []
    # answers 1..N/3, each accepted by one question ...
    for i in range(1, N // 3 + 1):
        rows.append({"id": i, "post_type_id": 2, "owner_user_id": i % 50,
                     "creation_date": T0 + timedelta(minutes=i)})
        rows.append({"id": 100_000 + i, "post_type_id": 1, "accepted_answer_id": i,
                     "owner_user_id": i % 50, "creation_date": T0 + timedelta(minutes=i - 30)})
    # ... and one answer accepted by a third of all rows, all from one owner
    for j in range(N // 2):
        rows.append({"id": 200_000 + j, "post_type_id": 1, "accepted_answer_id": 1,
                     "owner_user_id": 7, "creation_date": T0 + timedelta(hours=j % 24)})
    return posts_df(spark, rows)


@pytest.fixture()
def tiny_skew_thresholds(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_q4_hot_answer_is_split_and_counted(tiny_skew_thresholds):
    spark = tiny_skew_thresholds
    # the hot rows arrive from several input partitions, as from many files
    df = timing.quick_answers(skewed_posts(spark).repartition(8))
    rows = {r["hour"]: r for r in df.collect()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan and "AQEShuffleRead skewed" in plan
    assert sum(r["n_answered"] for r in rows.values()) == N // 3 + N // 2
    # same answer as the unsplit plan
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plain = {r["hour"]: r for r in timing.quick_answers(skewed_posts(spark)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert plain == rows


def test_hot_owner_and_post_reduced_before_shuffle(spark):
    p = skewed_posts(spark)
    u = users_df(spark, [{"id": i, "reputation": i, "creation_date": T0} for i in range(50)])
    v = votes_df(spark, [(1, 2)] * (N // 2) + [(2, 3)] * 10)
    q1 = {r["favorite_count"]: r["upvote_ratio"] for r in engagement.upvote_ratio(p, v).collect()}
    assert q1 == {0: pytest.approx((N // 2) / (N // 2 + 10))}
    q3 = engagement.post_counts(p, u).orderBy("rank").collect()
    owner7 = sum(1 for i in range(1, N // 3 + 1) if i % 50 == 7) * 2 + N // 2
    assert q3[0]["n_posts"] == owner7 and q3[0]["avg_reputation"] == 7.0
    # the per-owner aggregate is partial + final around one exchange
    plan = engagement.posts_per_user(p, u)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
