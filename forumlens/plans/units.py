"""Single operators of the inventory as stand-alone queries.

Each function is ``(spark, sf_dir) -> DataFrame`` and exposes one step of an
analysis on the full input, so it can be checked on its own against SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions.columns import (
    MICROS_PER_HOUR,
    day_window,
    format_timestamp,
    indicator,
    is_entry,
    is_valid,
    micros_between,
    parse_timestamp,
    split_tags,
)
from forumlens.operators.aggregates import vote_counts_per_post
from forumlens.operators.topk import ranked_top_k
from forumlens.plans import engagement, tags, timing
from forumlens.sources import dump_fixture, sinks, tables, xml_dump

S = SparkSession


# ---------------------------------------------------------------- sources --

def scan(table: str):
    def run(spark: S, d: str) -> DataFrame:
        return dump_fixture.read_dump(spark, d, table)
    return run


# Only ``scan`` writes and reads files; what follows works on the rendered lines.

def parse(table: str):
    names = [name for _, name, _ in xml_dump.ATTRIBUTES[table]]

    def run(spark: S, d: str) -> DataFrame:
        return xml_dump.typed_rows(dump_fixture.LINES[table](spark, d), table).select(*names)
    return run


def parse_fractions(spark: S, d: str) -> DataFrame:
    """Scores as whole number, fraction and metric, with planted ``1.5``, ``1e1`` and ``1x``."""
    posts = xml_dump.typed_rows(dump_fixture.fraction_lines(spark, d), "posts")
    metric = timing.metric_columns(posts).select("id", F.col("score").alias("metric"))
    return posts.select("id", "score", "score_fraction").join(metric, "id")


def bad_fractions(spark: S, d: str) -> DataFrame:
    return xml_dump.bad_values(dump_fixture.fraction_lines(spark, d), "posts")


def fractional_veterans(spark: S, d: str) -> DataFrame:
    """Q5 over parsed posts whose scores are partly not whole."""
    posts = xml_dump.typed_rows(dump_fixture.fraction_lines(spark, d), "posts")
    return timing.veterans(posts, tables.users(spark, d))


def dump_audit(spark: S, d: str) -> DataFrame:
    """Q0 of all tables in one pass over the dump, its files summed."""
    files = xml_dump.audit_dump(spark, dump_fixture.dump_root(spark, d))
    counts = ["n_lines", "n_entries", "n_valid", "n_bad_entries", "n_unparsable", "n_not_row", "n_bad_key"]
    n_bad = F.aggregate("bad_values", F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    return files.groupBy("table_name").agg(*[F.sum(c).alias(c) for c in counts], F.sum(n_bad).alias("n_bad_values"))


def published_results(spark: S, d: str) -> DataFrame:
    """Two results published as one run, read back through the manifest."""
    root = xml_dump.scratch_path(spark, "published")
    posts, users = tables.posts(spark, d), tables.users(spark, d)
    sinks.publish(spark, {"counts": engagement.posts_per_user(posts, users), "hours": timing.quick_answers(posts)}, root)
    counts = sinks.read_published(spark, root, "counts").select(
        F.lit("posts").alias("what"), F.col("user_id").alias("key"), F.col("n_posts").cast("bigint").alias("n"))
    return counts.unionByName(sinks.read_published(spark, root, "hours").select(
        F.lit("quick").alias("what"), F.col("hour").cast("bigint").alias("key"), F.col("n_quick").alias("n")))


def parse_tagged_posts(spark: S, d: str) -> DataFrame:
    """Tags and Body of the given texts, rendered as dump lines and parsed back."""
    lines = xml_dump.render(tables.tagged_posts(spark, d), "posts")
    return xml_dump.typed_rows(lines, "posts").select("id", "tags", "body")


def bad_rows(spark: S, d: str) -> DataFrame:
    out = None
    for table, lines in dump_fixture.LINES.items():
        b = xml_dump.bad_rows(lines(spark, d), table).select(
            F.lit(table).alias("table_name"), "value", "reason")
        out = b if out is None else out.unionByName(b)
    return out


def bad_values(spark: S, d: str) -> DataFrame:
    out = None
    for table, lines in dump_fixture.LINES.items():
        b = xml_dump.bad_values(lines(spark, d), table).select(
            F.lit(table).alias("table_name"), "attribute", "n")
        out = b if out is None else out.unionByName(b)
    return out


def ingest_audit(spark: S, d: str) -> DataFrame:
    return xml_dump.audit(dump_fixture.LINES["posts"](spark, d), "posts")


def filter_entry_lines(spark: S, d: str) -> DataFrame:
    return dump_fixture.LINES["posts"](spark, d).where(is_entry("value"))


def filter_valid_lines(spark: S, d: str) -> DataFrame:
    return dump_fixture.LINES["posts"](spark, d).where(is_valid("value"))


# ------------------------------------------------------------ projections --

def project_post_favorites(spark: S, d: str) -> DataFrame:
    return engagement.post_favorites(tables.posts(spark, d))


def project_post_owner(spark: S, d: str) -> DataFrame:
    return tables.posts(spark, d).select("id", "owner_user_id", "post_type_id")


def project_post_metrics(spark: S, d: str) -> DataFrame:
    return timing.metric_columns(tables.posts(spark, d))


# ----------------------------------------------------------------- scalars --

def parse_timestamp_variants(spark: S, d: str) -> DataFrame:
    """Creation times written with 6, 3 and 0 fraction digits, parsed back."""
    p = tables.posts(spark, d).select("id", "creation_date")
    out = None
    for name, digits in (("micros", 6), ("millis", 3), ("seconds", 0)):
        v = p.select("id", F.lit(name).alias("layout"),
                     format_timestamp("creation_date", digits).alias("text"))
        out = v if out is None else out.unionByName(v)
    return out.select("id", "layout", "text", parse_timestamp("text").alias("parsed"))


def hour_of_post(spark: S, d: str) -> DataFrame:
    return tables.posts(spark, d).select("id", F.hour("creation_date").cast("int").alias("hour"))


def split_tag_text(spark: S, d: str) -> DataFrame:
    t = tables.tagged_posts(spark, d)
    return t.select("id", "tags_text", split_tags("tags_text").alias("tags"))


def explode_tags(spark: S, d: str) -> DataFrame:
    return tags.exploded_tags(tables.tagged_posts(spark, d)).select("id", "tag")


def filter_tagged(spark: S, d: str) -> DataFrame:
    return tags.tagged(tables.tagged_posts(spark, d)).select("id", "tags_text")


def tokenize(spark: S, d: str) -> DataFrame:
    return tags.tokens(tables.tagged_posts(spark, d))


# ----------------------------------------------------------------- filters --

def filter_quick(spark: S, d: str) -> DataFrame:
    pairs = timing.accepted_pairs(tables.posts(spark, d))
    gap = micros_between("q_created", "a_created")
    return pairs.where(gap < F.lit(timing.QUICK_HOURS * MICROS_PER_HOUR)).select(
        "question_id", "answer_id", (gap / F.lit(float(MICROS_PER_HOUR))).alias("gap_hours"))


def flag_day_window(spark: S, d: str) -> DataFrame:
    u = tables.users(spark, d).select(F.col("id").alias("user_id"),
                                      F.col("creation_date").alias("u_created"))
    p = tables.posts(spark, d).select(F.col("id").alias("post_id"), "owner_user_id",
                                      "creation_date")
    j = u.join(p, F.col("user_id") == F.col("owner_user_id"))
    lo, hi = timing.WINDOW_DAYS
    return j.select("user_id", "post_id",
                    indicator(day_window("u_created", "creation_date", lo, hi)).alias("in_window"))


def cohort(spark: S, d: str) -> DataFrame:
    return timing.cohorts(tables.posts(spark, d), tables.users(spark, d))


# ------------------------------------------------------------------- joins --

def join_posts_votes(spark: S, d: str) -> DataFrame:
    p = engagement.post_favorites(tables.posts(spark, d))
    v = tables.votes(spark, d)
    return p.join(v, F.col("id") == F.col("post_id")).select(
        "post_id", "favorite_count", "vote_type_id")


def join_users_posts(spark: S, d: str) -> DataFrame:
    u = tables.users(spark, d).select(F.col("id").alias("user_id"), "reputation")
    p = tables.posts(spark, d).select(F.col("id").alias("post_id"), "owner_user_id",
                                      "post_type_id")
    return u.join(p, F.col("user_id") == F.col("owner_user_id")).select(
        "user_id", "reputation", "post_id", "post_type_id")


def join_accepted_answer(spark: S, d: str) -> DataFrame:
    return timing.accepted_pairs(tables.posts(spark, d)).select(
        "question_id", "answer_id", "q_created", "a_created")


def join_cohort_posts(spark: S, d: str) -> DataFrame:
    posts, users = tables.posts(spark, d), tables.users(spark, d)
    c = timing.cohorts(posts, users)
    fq = timing.first_questions(posts)
    return c.join(fq, F.col("user_id") == F.col("owner_user_id")).select(
        "user_id", "cohort", F.col("first.id").alias("question_id"),
        F.col("first.score").alias("score"), F.col("first.views").alias("views"),
        F.col("first.answers").alias("answers"), F.col("first.favorites").alias("favorites"))


# ------------------------------------------------------------ aggregations --

def agg_vote_counts(spark: S, d: str) -> DataFrame:
    return engagement.upvote_counts_by_favorites(tables.posts(spark, d), tables.votes(spark, d))


def agg_votes_per_post(spark: S, d: str) -> DataFrame:
    return vote_counts_per_post(tables.votes(spark, d))


def agg_answer_counts(spark: S, d: str) -> DataFrame:
    return engagement.answer_counts_per_user(tables.posts(spark, d), tables.users(spark, d))


def agg_mean_row(spark: S, d: str) -> DataFrame:
    q2 = engagement.answer_share(tables.posts(spark, d), tables.users(spark, d))
    return q2.where(F.col("row_kind") == "mean")


def agg_posts_per_user(spark: S, d: str) -> DataFrame:
    return engagement.posts_per_user(tables.posts(spark, d), tables.users(spark, d))


def agg_avg_reputation(spark: S, d: str) -> DataFrame:
    per_user = engagement.posts_per_user(tables.posts(spark, d), tables.users(spark, d))
    return per_user.groupBy("n_posts").agg(
        F.avg(F.col("reputation").cast("double")).alias("avg_reputation"))


def agg_by_hour(spark: S, d: str) -> DataFrame:
    return timing.quick_answers(tables.posts(spark, d)).select("hour", "n_answered", "n_quick")


def agg_window_posts(spark: S, d: str) -> DataFrame:
    return timing.window_post_counts(tables.posts(spark, d), tables.users(spark, d))


def first_per_key(spark: S, d: str) -> DataFrame:
    fq = timing.first_questions(tables.posts(spark, d))
    return fq.select("owner_user_id", F.col("first.id").alias("question_id"),
                     F.col("first.score").alias("score"), F.col("first.views").alias("views"),
                     F.col("first.answers").alias("answers"),
                     F.col("first.favorites").alias("favorites"))


def count_rows(spark: S, d: str) -> DataFrame:
    """Total counts: brief-cohort users and tagged test posts."""
    brief = timing.cohorts(tables.posts(spark, d), tables.users(spark, d)).where(
        F.col("cohort") == timing.BRIEF).agg(F.count(F.lit(1)).alias("n"))
    test = tags.tagged(tables.tagged_posts(spark, d, "test")).agg(F.count(F.lit(1)).alias("n"))
    return (brief.select(F.lit("brief_users").alias("what"), "n")
            .unionByName(test.select(F.lit("test_posts").alias("what"), "n")))


def count_by_tag(spark: S, d: str) -> DataFrame:
    return tags.tag_counts(tables.tagged_posts(spark, d, "train")).select("tag", "n")


# ------------------------------------------------------------------- top-k --

def topk_composite(spark: S, d: str) -> DataFrame:
    u = tables.users(spark, d).select(F.col("id").alias("user_id"), "reputation")
    order = [F.col("reputation").desc(), F.col("user_id").cast("string").asc()]
    return ranked_top_k(u, order, engagement.Q2_USERS).select("rank", "user_id", "reputation")


def topk_tags(spark: S, d: str) -> DataFrame:
    return tags.top_tags(tables.tagged_posts(spark, d, "train"))
