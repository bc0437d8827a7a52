"""Numbers as the original reads them, window counts by day, the one-pass audit, published runs."""

import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from forumlens.functions.columns import day_window, indicator, parse_number, parse_whole
from forumlens.plans import tags, timing
from forumlens.sources import dump_fixture, sinks, tables, xml_dump
from helpers import T0, posts_df, users_df

NUMBERS = ["1", "-2", "+3", " 4 ", "1_000", "1__0", "_1", "1_", "1.5", "-.5", "5.", ".", "1e3", "1E-2", "1_0.2_5e1_0", "e5", "inf",
           "-Infinity", "NaN", "infin", "1.5f", "2d", "5L", "0x10", "0x1p3", "", " ", "abc", "1,5", "9223372036854775807",
           "9223372036854775808", "-9223372036854775808", "1" * 40, "1 2", "--1", "1e", "1e400", "\u00a07\u00a0"]


def python_reads(kind, text):
    try:
        v = kind(text)
    except ValueError:
        return None
    return v if kind is float or -2 ** 63 <= v < 2 ** 63 else None


def test_numbers_are_read_as_int_and_float_read_them(spark):
    df = spark.createDataFrame([(t,) for t in [*NUMBERS, None]], "t string")
    for r in df.select("t", parse_whole("t").alias("w"), parse_number("t").alias("f")).collect():
        assert r.w == (python_reads(int, r.t) if r.t is not None else None), r.t
        want = python_reads(float, r.t) if r.t is not None else None
        assert r.f == want or (want is not None and want != want and r.f != r.f), r.t


def rows_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_fractions_count_in_the_metrics_and_not_as_bad(spark, scratch):
    lines = rows_of(spark, '<row Id="1" PostTypeId="1" Score="1.5" ViewCount="1e2" AnswerCount="x" FavoriteCount="3" />',
                    '<row Id="2" PostTypeId="1" Score="4" ViewCount="0x5" />')
    typed = xml_dump.typed_rows(lines, "posts")
    got = {r["id"]: tuple(r)[4:] for r in timing.metric_columns(typed).collect()}
    assert got == {1: (1.5, 100.0, 0.0, 3.0), 2: (4.0, 0.0, 0.0, 0.0)}
    assert {r["attribute"]: r["n"] for r in xml_dump.bad_values(lines, "posts").collect()} == {"AnswerCount": 1, "ViewCount": 1}
    back = xml_dump.typed_rows(xml_dump.render(typed, "posts"), "posts").where("id = 1").first()
    assert (back["score"], back["score_fraction"], back["view_count_fraction"]) == (None, 1.5, 100.0)
    # The ingest keeps both columns; a table of an earlier ingest reads without them.
    xml_dump.write_dump(lines, f"{scratch}/d/posts")
    xml_dump.ingest(spark, f"{scratch}/d", f"{scratch}/t", tables=("posts",))
    assert xml_dump.read_ingested(spark, f"{scratch}/t", "posts").where("score_fraction = 1.5").count() == 1
    old = spark.read.parquet(f"{scratch}/t/posts").drop(*xml_dump.FRACTIONS.values())
    old.write.partitionBy("status").parquet(f"{scratch}/o/posts")
    assert "score_fraction" not in xml_dump.read_ingested(spark, f"{scratch}/o", "posts").columns


# ------------------------------------------------------------ window counts --

def counted_one_by_one(posts, users, window):
    u = users.select(F.col("id").alias("user_id"), F.col("creation_date").alias("u_created"))
    j = u.join(posts.where("owner_user_id is not null"), F.col("user_id") == F.col("owner_user_id"))
    flag = indicator(day_window("u_created", "creation_date", *window))
    return {r[0]: r[1] for r in j.groupBy("user_id").agg(F.sum(flag).cast("bigint")).collect()}


@pytest.fixture(scope="module")
def busy(spark):
    rnd = random.Random(4)
    rows = [{"id": i, "owner_user_id": rnd.choice([1, 1, 1, 2, 3, 4, None]),
             "creation_date": T0 + timedelta(days=rnd.choice([99, 100, 120, 149, 150]), seconds=rnd.randrange(86_400),
                                             microseconds=rnd.choice([0, 1, 999_999]))} for i in range(4000)]
    rows += [{"id": 5000 + k, "owner_user_id": 5, "creation_date": T0 + timedelta(hours=7) + d} for k, d in enumerate(
        [timedelta(days=100), timedelta(days=100) - timedelta(microseconds=1), timedelta(days=150),
         timedelta(days=150) - timedelta(microseconds=1)])]
    rows += [{"id": 6000, "owner_user_id": 6, "creation_date": None}]
    users = [{"id": i, "creation_date": T0 + timedelta(hours=7 * (i % 4))} for i in (1, 2, 3, 4, 6, 8)]
    users += [{"id": 5, "creation_date": T0 + timedelta(hours=7)}]
    return posts_df(spark, rows), users_df(spark, users)


@pytest.mark.parametrize("few", [True, False])
def test_window_counts_by_day(busy, monkeypatch, few):
    if not few:
        monkeypatch.setattr(timing, "broadcast_if_few", lambda df: df)
    posts, users = busy
    for window in ((100, 150), (99, 100), (0, 1000)):
        got = {r["user_id"]: r["n_window"] for r in timing.window_post_counts(posts, users, window).collect()}
        assert got == counted_one_by_one(posts, users, window)
    assert timing.window_post_counts(posts, users).where("user_id = 5").first()["n_window"] == 2


def test_window_counts_shuffle_no_raw_posts(busy):
    """Below each exchange stands an aggregate, or the users."""
    posts, users = busy
    plan = timing.window_post_counts(posts.coalesce(2), users.coalesce(2))._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    below = [" ".join(lines[i + 1:i + 4]) for i, line in enumerate(lines) if "- Exchange hashpartitioning" in line]
    for text in below:
        assert "HashAggregate" in text or "timestampadd" in text, text


# ------------------------------------------------------------------- audit --

def test_dump_audit_per_file_agrees_with_the_single_audits(spark, scratch):
    for table, build in dump_fixture.LINES.items():
        xml_dump.write_dump(build(spark, SF_SMALL).repartition(3), os.path.join(scratch, table))
    files = xml_dump.audit_dump(spark, scratch).collect()
    assert len(files) == 9 and len({(r["table_name"], r["file"]) for r in files}) == 9
    for table in dump_fixture.LINES:
        lines = xml_dump.read_lines(spark, os.path.join(scratch, table))
        one = xml_dump.audit(lines, table).first()
        for c in ("n_lines", "n_entries", "n_valid", "n_bad_entries"):
            assert sum(r[c] for r in files if r["table_name"] == table) == one[c]
        reasons = {r[0]: r[1] for r in xml_dump.bad_rows(lines, table).groupBy("reason").count().collect()}
        for column, reason in (("n_bad_entries", "truncated"), ("n_unparsable", "unparsable"), ("n_not_row", "not_row_element"),
                               ("n_bad_key", "bad_key")):
            assert sum(r[column] for r in files if r["table_name"] == table) == reasons.get(reason, 0)
        bad = {}
        for r in files:
            if r["table_name"] == table:
                for x in r["bad_values"]:
                    bad[x["attribute"]] = bad.get(x["attribute"], 0) + x["n"]
        assert bad == {r["attribute"]: r["n"] for r in xml_dump.bad_values(lines, table).collect()}


def test_dump_audit_is_one_scan(spark, scratch):
    for table in dump_fixture.LINES:
        xml_dump.write_dump(rows_of(spark, '<row Id="1" PostId="x" />'), os.path.join(scratch, table))
    df = xml_dump.audit_dump(spark, scratch)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("from_xml") == 1


# --------------------------------------------------------------- published --

def test_a_failed_run_between_two_good_ones_is_never_seen(spark, scratch):
    root = f"{scratch}/results"
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, root, "a")
    first = sinks.publish(spark, {"a": spark.range(3).toDF("x"), "b": spark.range(5).toDF("x")}, root)
    fails = spark.range(4).select(F.raise_error(F.lit("lost")).cast("bigint").alias("x"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(spark, {"a": spark.range(30).toDF("x"), "b": fails}, root)
    assert sinks.current_run(spark, root) == first
    assert sinks.read_published(spark, root, "a").count() == 3 and sinks.read_published(spark, root, "b").count() == 5
    held = sinks.read_published(spark, root, "a")
    third = sinks.publish(spark, {"a": spark.range(7).toDF("x"), "b": spark.range(9).toDF("x")}, root)
    assert held.count() == 3                                   # a reader keeps the run it resolved
    assert sinks.read_published(spark, root, "a").count() == 7 and sinks.current_run(spark, root) == third
    assert sinks.read_published(spark, root, "b", run=first).count() == 5
    gone = sinks.prune(spark, root, keep=1)
    assert third not in gone and len(gone) == 2 and sinks.read_published(spark, root, "b").count() == 9


# ------------------------------------------------------------- certificate --

def test_certificate_of_a_good_and_of_a_spoilt_model(spark):
    train = tables.tagged_posts(spark, SF_SMALL, "train")
    rows = tags.tag_rows(train, "en", 1 << 10)
    model = tags.one_tag_model(train, "en", 1 << 10)
    c = tags.certificate(model, rows).first()
    assert c["n_rows"] == 2 * train.count() and c["falls"] and 1 <= c["iterations"] <= tags.LR_MAX_ITER
    assert c["loss_end"] == pytest.approx(c["loss_stated"], abs=1e-6) and c["loss_end"] < c["loss_start"]
    assert c["gradient_end"] < c["gradient_start"] / 2

    class Spoilt:
        coefficients, intercept, summary = -1 * model.coefficients, model.intercept, model.summary

    bad = tags.certificate(Spoilt, rows).first()
    assert bad["loss_end"] > c["loss_end"] + 0.1 and bad["gradient_end"] > c["gradient_end"]
