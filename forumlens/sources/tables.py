"""Typed posts / users / votes tables derived from the driver's Parquet tables.

The driver ships TPC-H-like tables, not a Q&A dump.  This module maps them,
column for column and with one rule per attribute, onto the three typed tables
the analyses read.  The same rules are written in DuckDB SQL in
``plans/oracle.py`` so the two engines see identical inputs.

Each function reads only the columns it maps (Parquet column pruning) and is a
plain projection: no shuffle, no driver round trip.  The one scalar input
(the event count behind the accepted-answer offset) is a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions.columns import ANSWER, QUESTION, split_tags

# Typed schemas shared by the fixture mapping and the XML ingest.
POSTS_COLUMNS = [
    ("id", "bigint"),
    ("post_type_id", "int"),
    ("creation_date", "timestamp_ntz"),
    ("owner_user_id", "bigint"),
    ("accepted_answer_id", "bigint"),
    ("favorite_count", "bigint"),
    ("score", "bigint"),
    ("view_count", "bigint"),
    ("answer_count", "bigint"),
    ("tags", "array<string>"),
    ("body", "string"),
]
USERS_COLUMNS = [("id", "bigint"), ("reputation", "bigint"), ("creation_date", "timestamp_ntz")]
VOTES_COLUMNS = [("post_id", "bigint"), ("vote_type_id", "int")]

# Fixed values of the fixture mapping (FIXTURES.md section 2).
USER_EPOCH = "2023-07-01 00:00:00"
EVENT_TYPE_TO_POST_TYPE = {"click": QUESTION, "view": QUESTION, "purchase": ANSWER,
                           "signup": ANSWER, "error": 4}
RETURNFLAG_TO_VOTE_TYPE = {"A": 2, "R": 3, "N": 5}
TEST_SPLIT_MODULUS = 5  # tagged posts with doc_id % 5 = 0 form the test set


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(column: Column, mapping: dict) -> Column:
    out = None
    for key, value in mapping.items():
        out = (F.when(column == key, F.lit(value)) if out is None
               else out.when(column == key, F.lit(value)))
    return out


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    epoch = F.lit(USER_EPOCH).cast("timestamp_ntz")
    created = F.timestamp_add("HOUR", key % 24, F.timestamp_add("DAY", (key * 13) % 200, epoch))
    return c.select(
        key.alias("id"),
        F.floor(F.col("c_acctbal") / 100).cast("bigint").alias("reputation"),
        created.alias("creation_date"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    ptype = _case(F.col("event_type"), EVENT_TYPE_TO_POST_TYPE).cast("int")
    # Offset between a question and its accepted answer: count(events) div 100
    # (a scalar subquery; at least 1 so tiny inputs stay defined).
    step = ev.select(F.expr("greatest(count(1) div 100, 1)")).scalar()
    is_q = ptype == QUESTION
    return ev.select(
        eid.alias("id"),
        ptype.alias("post_type_id"),
        F.col("ts").alias("creation_date"),
        F.when(eid % 17 != 0, F.col("user_id")).alias("owner_user_id"),
        F.when(is_q & (eid % 3 != 0), eid + 1 + eid % step).alias("accepted_answer_id"),
        F.when(eid % 4 == 0, eid % 61).alias("favorite_count"),
        (F.floor(F.col("value")) - 20).cast("bigint").alias("score"),
        F.when(is_q, eid % 1000).alias("view_count"),
        F.when(is_q, eid % 7).alias("answer_count"),
        F.lit(None).cast("array<string>").alias("tags"),
        F.lit(None).cast("string").alias("body"),
    )


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("post_id"),
        _case(F.col("l_returnflag"), RETURNFLAG_TO_VOTE_TYPE).cast("int").alias("vote_type_id"),
    )


def tagged_posts(spark: SparkSession, sf_dir: str, split: str = "all") -> DataFrame:
    """Posts with tags and a body, from ``documents``.

    ``tags_text`` is the raw attribute form ``<lang><source>``; ``tags`` its
    parsed array.  ``split`` is ``all``, ``train`` or ``test``.
    """
    d = read_table(spark, sf_dir, "documents")
    tags_text = F.concat(F.lit("<"), F.col("lang"), F.lit("><"), F.col("source"), F.lit(">"))
    out = d.select(
        F.col("doc_id").alias("id"),
        tags_text.alias("tags_text"),
        split_tags(tags_text).alias("tags"),
        F.col("text").alias("body"),
    )
    if split == "train":
        out = out.where(F.col("id") % TEST_SPLIT_MODULUS != 0)
    elif split == "test":
        out = out.where(F.col("id") % TEST_SPLIT_MODULUS == 0)
    elif split != "all":
        raise ValueError(f"unknown split {split!r}")
    return out


def dataset(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three typed tables keyed by name."""
    return {"posts": posts(spark, sf_dir), "users": users(spark, sf_dir),
            "votes": votes(spark, sf_dir)}
