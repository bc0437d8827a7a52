"""Invariants of the analyses on the driver's sf0.01 tables."""

from pyspark.sql import functions as F

from conftest import SF_MID
from forumlens.plans import engagement, registry, timing
from forumlens.sources import dump_fixture, tables, xml_dump


def test_ratios_are_shares(spark):
    q = registry.queries()
    for key, col in [("q1_upvote_ratio", "upvote_ratio"), ("q2_answer_share", "answer_share"),
                     ("q4_quick_answers", "quick_share")]:
        bad = q[key](spark, SF_MID).where((F.col(col) < 0) | (F.col(col) > 1)).count()
        assert bad == 0, key


def test_post_counts_add_up_to_joined_posts(spark):
    posts, users = tables.posts(spark, SF_MID), tables.users(spark, SF_MID)
    per_user = engagement.posts_per_user(posts, users)
    total = per_user.groupBy("n_posts").agg(F.count(F.lit(1)).alias("users")) \
        .agg(F.sum(F.col("users") * F.col("n_posts"))).collect()[0][0]
    joined = users.join(posts, users.id == posts.owner_user_id).count()
    assert total == joined


def test_quick_never_exceeds_answered(spark):
    q4 = timing.quick_answers(tables.posts(spark, SF_MID))
    assert q4.where(F.col("n_quick") > F.col("n_answered")).count() == 0


def test_cohorts_disjoint_and_covering(spark):
    posts, users = tables.posts(spark, SF_MID), tables.users(spark, SF_MID)
    c = timing.cohorts(posts, users)
    with_posts = users.join(posts, users.id == posts.owner_user_id).select(users.id).distinct()
    assert c.count() == c.select("user_id").distinct().count() == with_posts.count()
    q5 = timing.veterans(posts, users).agg(F.sum("n_users")).collect()[0][0]
    assert q5 == c.count()


def test_audit_counts_add_up(spark):
    lines = dump_fixture.read_dump(spark, SF_MID, "posts")
    a = xml_dump.audit(lines, "posts").collect()[0]
    p = xml_dump.parse_lines(lines, "posts")
    by_status = {r["status"]: r["n"] for r in
                 p.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert a["n_lines"] == sum(by_status.values())
    assert a["n_bad_entries"] == by_status.get("truncated", 0)
    assert a["n_unparsable"] == by_status.get("unparsable", 0)
    assert a["n_entries"] == a["n_valid"] - by_status.get("not_row_element", 0) \
        + a["n_bad_entries"]
    assert by_status["ok"] == tables.posts(spark, SF_MID).count() - a["n_bad_entries"] \
        - a["n_unparsable"]


def test_tagged_bodies_survive_the_dump(spark):
    t = tables.tagged_posts(spark, SF_MID).select("id", "tags", "body")
    back = xml_dump.typed_rows(xml_dump.render(t, "posts"), "posts").select("id", "tags", "body")
    assert back.count() == t.count()
    assert back.exceptAll(t).count() == 0 and t.exceptAll(back).count() == 0


def test_day_buckets_equal_per_post_window_test(spark):
    posts, users = tables.posts(spark, SF_MID), tables.users(spark, SF_MID)
    flags = timing.window_flags(posts, users)
    counts = timing.window_post_counts(posts, users)
    j = flags.join(counts, "user_id", "full_outer")
    assert j.where(F.col("in_window").isNull() | F.col("n_window").isNull()).count() == 0
    assert j.where(F.col("in_window") != (F.col("n_window") > 0)).count() == 0
    assert j.where(F.col("in_window")).count() > 0 and j.where(~F.col("in_window")).count() > 0


def test_shared_per_owner_aggregate_gives_same_results(spark):
    from forumlens.operators.aggregates import activity_per_owner

    posts, users = tables.posts(spark, SF_MID), tables.users(spark, SF_MID)
    shared = activity_per_owner(posts).cache()
    try:
        for fn in (engagement.answer_share, engagement.post_counts):
            a, b = fn(posts, users), fn(posts, users, per_owner=shared)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        shared.unpersist()
