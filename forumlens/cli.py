"""Command-line jobs (``spark-submit`` or ``python -m forumlens.cli``).

``ingest <dump_root> <tables_root>``
    parse ``<dump_root>/{posts,users,votes}/`` once into typed Parquet tables
    (bad rows kept beside them, see ``xml_dump.ingest``).
``audit <dump_root> <results_root>``
    Q0 line counts and counts of values their type cannot take, per table.
``analyze <tables_root> <results_root>``
    run Q1-Q5 on ingested tables and write one Parquet folder per analysis.
``fixtures <sf_dir> <results_root>``
    the same analyses on the tables derived from the driver's Parquet files.

``--models`` adds the tag analyses on the posts that carry tags: top tags,
Word2Vec tag vectors, post vectors and the synonyms of ``--word``; with
``--test <tables_root>`` (ingested test posts) also the single-tag model of
``--tag`` and the one-vs-rest tag probabilities, trained on the source posts.
"""

from __future__ import annotations

import argparse

from pyspark import StorageLevel
from pyspark.sql import SparkSession

from forumlens.operators.aggregates import activity_per_owner
from forumlens.plans import engagement, tags, timing
from forumlens.session import input_bytes, size_shuffles, tune
from forumlens.sources import sinks, tables, xml_dump


def analyses(posts, users, votes) -> dict:
    # Q2 and Q3 share one per-owner aggregate (one posts scan and shuffle);
    # it is about one row per user, kept MEMORY_AND_DISK while both are written.
    per_owner = activity_per_owner(posts).persist(StorageLevel.MEMORY_AND_DISK)
    return {
        "q1_upvote_ratio": engagement.upvote_ratio(posts, votes),
        "q2_answer_share": engagement.answer_share(posts, users, per_owner=per_owner),
        "q3_post_counts": engagement.post_counts(posts, users, per_owner=per_owner),
        "q4_quick_answers": timing.quick_answers(posts),
        "q5_veterans": timing.veterans(posts, users),
    }


def tag_analyses(posts, word: str, test=None, tag: str = tags.TRIAL_TAG) -> dict:
    model = tags.fit_tag_embeddings(posts)
    out = {
        "q7_top_tags": tags.top_tags(posts),
        "q6_tag_vectors": tags.tag_vectors(model),
        "q6_synonyms": tags.synonyms(model, word),
        "q6_post_vectors": tags.post_vectors(model, posts),
    }
    if test is not None:
        out["q7_one_tag"] = tags.one_tag_probabilities(posts, test, tag)
        out["q7_tag_probabilities"] = tags.tag_probabilities(posts, test)
    return out


def audits(spark: SparkSession, dump_root: str) -> dict:
    """Q0 and the counts of bad values, per table of a dump."""
    out = {}
    for table in xml_dump.ATTRIBUTES:
        lines = xml_dump.read_lines(spark, f"{dump_root.rstrip('/')}/{table}")
        out[f"q0_audit_{table}"] = xml_dump.audit(lines, table)
        out[f"bad_values_{table}"] = xml_dump.bad_values(lines, table)
    return out


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="forumlens")
    parser.add_argument("command", choices=["ingest", "audit", "analyze", "fixtures"])
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--models", action="store_true", help="also run the tag analyses")
    parser.add_argument("--word", default=tags.SYNONYM_WORD, help="tag whose synonyms to list")
    parser.add_argument("--test", default=None, help="ingested test tables root (Q7)")
    parser.add_argument("--tag", default=tags.TRIAL_TAG, help="tag of the single-tag model (Q7)")
    args = parser.parse_args(argv)
    spark = tune(SparkSession.builder.appName(f"forumlens-{args.command}").getOrCreate())
    size_shuffles(spark, input_bytes(spark, [args.source]))
    if args.command == "ingest":
        xml_dump.ingest(spark, args.source, args.target)
        return
    if args.command == "audit":
        sinks.write_all(audits(spark, args.source), args.target)
        return
    if args.command == "analyze":
        t = {name: xml_dump.read_ingested(spark, args.source, name)
             for name in ("posts", "users", "votes")}
    else:
        t = tables.dataset(spark, args.source)
    results = analyses(t["posts"], t["users"], t["votes"])
    if args.models:
        test = xml_dump.read_ingested(spark, args.test, "posts") if args.test else None
        results.update(tag_analyses(t["posts"], args.word, test, args.tag))
    sinks.write_all(results, args.target)


if __name__ == "__main__":
    main()
