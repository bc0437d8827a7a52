"""Edge rows: one case per rule of FIXTURES.md section 3."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forumlens.plans import engagement, tags, timing
from forumlens.sources import xml_dump
from helpers import at, posts_df, users_df, votes_df


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def statuses(spark, *values):
    p = xml_dump.parse_lines(lines(spark, *values), "posts")
    return {r["value"]: r for r in p.collect()}


# ------------------------------------------------------------------ parse --

def test_line_classes(spark):
    s = statuses(
        spark,
        '<?xml version="1.0" encoding="utf-8"?>', "<posts>", "</posts>",
        '  <row Id="2" Body="trunc',
        '<rows Id="5" />',
        '<row Id="4" Body="raw & amp" />',
        '<row Id="4" Body="a < b" />',
        '<row Id="1" Id="2" />',
        '<row Id="5" Body="x &bogus; y" />',
        'junk <row Id="7" />',
        '<row Id="12x" PostTypeId="1" />',
        '  <row Id="3" PostTypeId="1" />')
    assert s['<?xml version="1.0" encoding="utf-8"?>']["status"] == "markup"
    assert s["<posts>"]["status"] == "markup"
    assert s["</posts>"]["status"] == "markup"
    assert s['  <row Id="2" Body="trunc']["status"] == "truncated"
    assert s['<rows Id="5" />']["status"] == "not_row_element"
    assert s['<row Id="4" Body="raw & amp" />']["status"] == "unparsable"
    assert s['<row Id="4" Body="a < b" />']["status"] == "unparsable"
    assert s['<row Id="1" Id="2" />']["status"] == "unparsable"   # repeated attribute
    assert s['<row Id="5" Body="x &bogus; y" />']["status"] == "unparsable"  # unknown entity
    assert s['junk <row Id="7" />']["status"] == "unparsable"
    assert s['<row Id="12x" PostTypeId="1" />']["status"] == "bad_key"
    ok = s['  <row Id="3" PostTypeId="1" />']
    assert ok["status"] == "ok" and ok["id"] == 3 and ok["post_type_id"] == 1


def test_first_row_of_a_line_is_taken(spark):
    s = statuses(spark, '<row Id="8" /><row Id="9" />', '<row Id="6" /> x')
    assert s['<row Id="8" /><row Id="9" />']["id"] == 8
    assert s['<row Id="6" /> x']["id"] == 6


def test_attribute_name_inside_body(spark):
    line = '<row Id="1" PostTypeId="1" Body="FavoriteCount is not here" />'
    r = statuses(spark, line)[line]
    assert r["status"] == "ok" and r["favorite_count"] is None
    fav = engagement.post_favorites(xml_dump.typed_rows(lines(spark, line), "posts")).collect()
    assert fav[0]["favorite_count"] == 0


def test_entities_and_tags(spark):
    line = '<row Id="1" Tags="&lt;r&gt;&lt;ggplot2&gt;" Body="a&#xA;b &amp; c" />'
    r = statuses(spark, line)[line]
    assert r["tags"] == ["r", "ggplot2"]
    assert r["body"] == "a\nb & c"


@pytest.mark.parametrize("text,expected", [
    ("2013-10-28T10:42:29", datetime(2013, 10, 28, 10, 42, 29)),
    ("2013-10-28T10:42:29.94", datetime(2013, 10, 28, 10, 42, 29, 940000)),
    ("2013-10-28T10:42:29.940", datetime(2013, 10, 28, 10, 42, 29, 940000)),
    ("2013-10-28T10:42:29.123456", datetime(2013, 10, 28, 10, 42, 29, 123456)),
    ("yesterday", None),
])
def test_timestamps(spark, text, expected):
    line = f'<row Id="1" CreationDate="{text}" />'
    assert statuses(spark, line)[line]["creation_date"] == expected


def test_bad_values_are_counted_per_attribute(spark):
    got = xml_dump.bad_values(lines(
        spark, '<row Id="1" PostTypeId="x" Score="1.5" CreationDate="zz" Body="b" />',
        '<row Id="2" Score="a" Tags="" />', '<row Id="3" Score="4" />', '<row Id="x" Body="a & b" />',
        '<rows Id="y" />', "<posts>", '<row Id="z" />'), "posts")
    assert {r["attribute"]: r["n"] for r in got.collect()} == {
        "Id": 1, "PostTypeId": 1, "Score": 1, "CreationDate": 1}


def test_render_round_trip_keeps_text(spark):
    body = 'x < y & "z"\nline2\r\tend  '
    p = posts_df(spark, [{"id": 1, "post_type_id": 1, "creation_date": at(hours=1),
                          "tags": ["a", "b"], "body": body}])
    back = xml_dump.typed_rows(xml_dump.render(p, "posts"), "posts").collect()[0]
    assert back["body"] == body and back["tags"] == ["a", "b"]
    assert back["creation_date"] == at(hours=1)


# ---------------------------------------------------------------- Q1 / Q2 --

def test_other_vote_types_give_null_ratio(spark):
    p = posts_df(spark, [{"id": 1, "favorite_count": 3}, {"id": 2}])
    v = votes_df(spark, [(1, 5), (2, 2), (2, 3), (2, 3)])
    r = {x["favorite_count"]: x["upvote_ratio"] for x in engagement.upvote_ratio(p, v).collect()}
    assert r == {3: None, 0: pytest.approx(1 / 3)}


def test_answer_share_ties_and_nulls(spark):
    u = users_df(spark, [{"id": 9, "reputation": 50}, {"id": 10, "reputation": 50},
                         {"id": 11, "reputation": 70}, {"id": 12, "reputation": 10}])
    p = posts_df(spark, [
        {"id": 1, "post_type_id": 2, "owner_user_id": 9},
        {"id": 2, "post_type_id": 1, "owner_user_id": 10},
        {"id": 3, "post_type_id": 2, "owner_user_id": 10},
        {"id": 4, "post_type_id": 4, "owner_user_id": 11},   # only other types
        {"id": 5, "post_type_id": 2},                         # no owner
    ])
    rows = engagement.answer_share(p, u).orderBy("rank").collect()
    users = [(r["user_id"], r["answer_share"]) for r in rows if r["row_kind"] == "user"]
    assert users == [(11, None), (10, 0.5), (9, 1.0)]   # '10' < '9' as text; 12 has no posts
    mean = [r for r in rows if r["row_kind"] == "mean"][0]
    assert mean["user_id"] == -1 and mean["rank"] == 4
    assert mean["answer_share"] == pytest.approx(0.75)


def test_post_counts_limit(spark):
    u = users_df(spark, [{"id": i, "reputation": i * 10} for i in range(1, 5)])
    p = posts_df(spark, [{"id": 100 + j, "owner_user_id": i}
                         for i in range(1, 5) for j in range(i if i < 4 else 3)])
    r = engagement.post_counts(p, u, k=2).orderBy("rank").collect()
    assert [(x["n_posts"], x["avg_reputation"]) for x in r] == [(3, 35.0), (2, 20.0)]


# --------------------------------------------------------------------- Q4 --

def test_quick_answer_boundaries(spark):
    q_t = at(hours=5)
    rows = []
    gaps = {10: dict(hours=3), 11: dict(hours=3, microseconds=-1), 12: dict(hours=-2)}
    for qid, gap in gaps.items():
        rows.append({"id": qid, "post_type_id": 1, "accepted_answer_id": qid + 100,
                     "creation_date": q_t})
        rows.append({"id": qid + 100, "post_type_id": 2, "creation_date": q_t + __import__(
            "datetime").timedelta(**gap)})
    # accepted answer missing, and accepted post not an answer
    rows.append({"id": 20, "post_type_id": 1, "accepted_answer_id": 999, "creation_date": q_t})
    rows.append({"id": 21, "post_type_id": 1, "accepted_answer_id": 22, "creation_date": q_t})
    rows.append({"id": 22, "post_type_id": 1, "creation_date": q_t})
    # another hour with a slow answer only
    rows.append({"id": 30, "post_type_id": 1, "accepted_answer_id": 31,
                 "creation_date": at(hours=7)})
    rows.append({"id": 31, "post_type_id": 2, "creation_date": at(hours=20)})
    r = {x["hour"]: x for x in timing.quick_answers(posts_df(spark, rows)).collect()}
    assert set(r) == {5, 7}
    assert (r[5]["n_answered"], r[5]["n_quick"]) == (3, 2)
    assert (r[7]["n_answered"], r[7]["n_quick"], r[7]["quick_share"]) == (1, 0, 0.0)


# --------------------------------------------------------------------- Q5 --

def test_window_boundaries_and_cohorts(spark):
    from datetime import timedelta as td
    users = [{"id": i, "creation_date": at()} for i in range(1, 8)]
    gaps = {1: td(days=100) - td(microseconds=1), 2: td(days=100),
            3: td(days=149, hours=23, minutes=59, seconds=59), 4: td(days=150)}
    posts = [{"id": 10 + i, "owner_user_id": i, "post_type_id": 2, "creation_date": at() + g}
             for i, g in gaps.items()]
    # user 5: two questions at the same instant -> id 5 chosen; metrics missing -> 0
    posts += [{"id": 6, "owner_user_id": 5, "post_type_id": 1, "creation_date": at(days=1),
               "score": 9},
              {"id": 5, "owner_user_id": 5, "post_type_id": 1, "creation_date": at(days=1)}]
    # user 6: answers only (no question); user 7: no posts at all
    posts += [{"id": 40, "owner_user_id": 6, "post_type_id": 2, "creation_date": at(days=1)}]
    p, u = posts_df(spark, posts), users_df(spark, users)
    c = {r["user_id"]: r["cohort"] for r in timing.cohorts(p, u).collect()}
    assert c == {1: "brief", 2: "veteran", 3: "veteran", 4: "brief", 5: "brief", 6: "brief"}
    n = {r["user_id"]: r["n_window"] for r in timing.window_post_counts(p, u).collect()}
    assert n[2] == 1 and n[1] == 0
    v = {r["cohort"]: r for r in timing.veterans(p, u).collect()}
    assert v["brief"]["n_users"] == 4 and v["brief"]["n_with_question"] == 1
    assert v["brief"]["avg_score"] == 0.0   # question 5 (no score) wins the tie
    assert v["veteran"]["n_with_question"] == 0 and v["veteran"]["avg_score"] is None


def test_window_flags_match_exact_counts(spark):
    # day-level pre-aggregation must agree with the per-post test
    from datetime import timedelta as td
    users = [{"id": 1, "creation_date": at(hours=13)}]
    posts = [{"id": k, "owner_user_id": 1, "post_type_id": 1,
              "creation_date": at(hours=13) + td(days=100) + td(hours=h)}
             for k, h in enumerate([-13, -1, 10])]
    p, u = posts_df(spark, posts), users_df(spark, users)
    flags = timing.window_flags(p, u).collect()[0]["in_window"]
    counts = timing.window_post_counts(p, u).collect()[0]["n_window"]
    assert flags is True and counts == 1


def test_empty_cohort_has_no_row(spark):
    u = users_df(spark, [{"id": 1, "creation_date": at()}])
    p = posts_df(spark, [{"id": 1, "owner_user_id": 1, "post_type_id": 1,
                          "creation_date": at(days=1)}])
    rows = timing.veterans(p, u).collect()
    assert [r["cohort"] for r in rows] == ["brief"]


# ------------------------------------------------------------------- tags --

def test_untagged_and_empty_tags(spark):
    p = posts_df(spark, [{"id": 1, "tags": None, "body": "x"}, {"id": 2, "tags": [], "body": "y"},
                         {"id": 3, "tags": ["b", "a"], "body": "z"}])
    ex = tags.exploded_tags(p).collect()
    assert sorted((r["id"], r["tag"]) for r in ex) == [(3, "a"), (3, "b")]


def test_top_tag_ties_by_text(spark):
    p = posts_df(spark, [{"id": i, "tags": t} for i, t in
                         enumerate([["b"], ["a"], ["c", "a"], ["b"]])])
    r = tags.top_tags(p, k=2).orderBy("rank").collect()
    assert [(x["tag"], x["n"]) for x in r] == [("a", 2), ("b", 2)]


def test_split_tags_function(spark):
    df = spark.createDataFrame([("<r><ggplot2>",), ("",), (None,)], "t string")
    from forumlens.functions.columns import split_tags
    out = [r[0] for r in df.select(split_tags("t")).collect()]
    assert out == [["r", "ggplot2"], [], None]


def test_duplicate_ids_multiply_through_joins(spark):
    # H23: a duplicated user row doubles that user's counts; no silent de-duplication
    u = users_df(spark, [{"id": 1, "reputation": 5}, {"id": 1, "reputation": 5},
                         {"id": 2, "reputation": 3}])
    p = posts_df(spark, [{"id": 10, "post_type_id": 2, "owner_user_id": 1},
                         {"id": 11, "post_type_id": 1, "owner_user_id": 2},
                         {"id": 12, "post_type_id": 2, "owner_user_id": 2}])
    per_user = {r["user_id"]: r["n_posts"] for r in engagement.posts_per_user(p, u).collect()}
    assert per_user == {1: 2, 2: 2}
    # a duplicated post id meets every vote of that id twice
    p2 = posts_df(spark, [{"id": 5, "favorite_count": 1}, {"id": 5, "favorite_count": 1}])
    v = votes_df(spark, [(5, 2), (5, 3)])
    agg = engagement.upvote_counts_by_favorites(p2, v).collect()[0]
    assert (agg["n_up"], agg["n_updown"]) == (2, 4)
