"""Q1-Q5 against brute force on small random tables (hypothesis)."""

from collections import defaultdict
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forumlens.operators.aggregates import packed_order_key
from forumlens.plans import engagement, timing
from helpers import T0, posts_df, users_df, votes_df

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

ids = st.integers(min_value=1, max_value=12)
times = st.integers(min_value=0, max_value=400 * 24).map(lambda h: T0 + timedelta(hours=h))


@st.composite
def dataset(draw):
    n_users = draw(st.integers(1, 6))
    users = [{"id": i, "reputation": draw(st.integers(-5, 5)),
              "creation_date": draw(times)} for i in range(1, n_users + 1)]
    posts = []
    for pid in range(1, draw(st.integers(1, 14)) + 1):
        posts.append({
            "id": pid,
            "post_type_id": draw(st.sampled_from([1, 1, 2, 2, 4])),
            "owner_user_id": draw(st.one_of(st.none(), st.integers(1, n_users + 1))),
            "accepted_answer_id": draw(st.one_of(st.none(), ids)),
            "creation_date": draw(times),
            "favorite_count": draw(st.one_of(st.none(), st.integers(0, 3))),
            "score": draw(st.one_of(st.none(), st.integers(-3, 9))),
            "view_count": draw(st.one_of(st.none(), st.integers(0, 50))),
            "answer_count": draw(st.one_of(st.none(), st.integers(0, 4))),
        })
    votes = [(draw(ids), draw(st.sampled_from([2, 3, 5]))) for _ in range(draw(st.integers(0, 20)))]
    return users, posts, votes


def ratio(a, b):
    return a / b if b else None


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) < 1e-9


def brute_q1(posts, votes, k):
    acc = defaultdict(lambda: [0, 0])
    for p in posts:
        for pid, t in votes:
            if p["id"] == pid:
                key = p["favorite_count"] or 0
                acc[key][0] += t == 2
                acc[key][1] += t in (2, 3)
    return [(key, ratio(*acc[key])) for key in sorted(acc)[:k]]


def brute_q2(users, posts, k):
    acc = defaultdict(lambda: [0, 0])
    for u in users:
        for p in posts:
            if p["owner_user_id"] == u["id"]:
                acc[(u["reputation"], u["id"])][0] += p["post_type_id"] == 2
                acc[(u["reputation"], u["id"])][1] += p["post_type_id"] in (1, 2)
    top = sorted(acc, key=lambda x: (-x[0], str(x[1])))[:k]
    rows = [(uid, ratio(*acc[(rep, uid)])) for rep, uid in top]
    shares = [s for _, s in rows if s is not None]
    mean = [(-1, sum(shares) / len(shares) if shares else None)] if rows else []
    return rows + mean


def brute_q3(users, posts, k):
    per_user = defaultdict(int)
    for u in users:
        for p in posts:
            if p["owner_user_id"] == u["id"]:
                per_user[(u["id"], u["reputation"])] += 1
    per_count = defaultdict(list)
    for (_, rep), n in per_user.items():
        per_count[n].append(rep)
    return [(n, sum(per_count[n]) / len(per_count[n])) for n in sorted(per_count, reverse=True)[:k]]


def brute_q4(posts):
    acc = defaultdict(lambda: [0, 0])
    for q in posts:
        for a in posts:
            if q["accepted_answer_id"] == a["id"] and q["post_type_id"] == 1 \
                    and a["post_type_id"] == 2:
                h = q["creation_date"].hour
                acc[h][0] += 1
                acc[h][1] += (a["creation_date"] - q["creation_date"]) < timedelta(hours=3)
    return {h: (n, q, q / n) for h, (n, q) in acc.items()}


def brute_q5(users, posts):
    flag = {}
    for u in users:
        for p in posts:
            if p["owner_user_id"] == u["id"]:
                d = (p["creation_date"] - u["creation_date"]).days
                flag[u["id"]] = flag.get(u["id"], 0) + int(100 <= d < 150)
    out = {}
    for uid, f in flag.items():
        cohort = "veteran" if f > 0 else "brief"
        qs = [p for p in posts if p["owner_user_id"] == uid and p["post_type_id"] == 1]
        first = min(qs, key=lambda p: (p["creation_date"], p["id"])) if qs else None
        c = out.setdefault(cohort, {"n": 0, "m": []})
        c["n"] += 1
        if first:
            c["m"].append([float(first[x] or 0) for x in
                           ("score", "view_count", "answer_count", "favorite_count")])
    return out


@SETTINGS
@given(dataset())
def test_q1_q2_q3_brute_force(spark, data):
    users, posts, votes = data
    u, p, v = users_df(spark, users), posts_df(spark, posts), votes_df(spark, votes)
    q1 = [(r["favorite_count"], r["upvote_ratio"]) for r in
          engagement.upvote_ratio(p, v, k=3).orderBy("rank").collect()]
    want1 = brute_q1(posts, votes, 3)
    assert [a for a, _ in q1] == [a for a, _ in want1]
    assert all(close(a, b) for (_, a), (_, b) in zip(q1, want1))
    q2 = [(r["user_id"], r["answer_share"]) for r in
          engagement.answer_share(p, u, k=3).orderBy("rank").collect()]
    want2 = brute_q2(users, posts, 3)
    assert [a for a, _ in q2] == [a for a, _ in want2]
    assert all(close(a, b) for (_, a), (_, b) in zip(q2, want2))
    q3 = [(r["n_posts"], r["avg_reputation"]) for r in
          engagement.post_counts(p, u, k=2).orderBy("rank").collect()]
    want3 = brute_q3(users, posts, 2)
    assert [a for a, _ in q3] == [a for a, _ in want3]
    assert all(close(a, b) for (_, a), (_, b) in zip(q3, want3))


@SETTINGS
@given(dataset())
def test_q4_q5_brute_force(spark, data):
    users, posts, _ = data
    u, p = users_df(spark, users), posts_df(spark, posts)
    q4 = {r["hour"]: (r["n_answered"], r["n_quick"], r["quick_share"])
          for r in timing.quick_answers(p).collect()}
    assert q4 == brute_q4(posts)
    assert all(q <= n for n, q, _ in q4.values())
    q5 = {r["cohort"]: r for r in timing.veterans(p, u).collect()}
    want = brute_q5(users, posts)
    assert set(q5) == set(want)
    for cohort, w in want.items():
        r = q5[cohort]
        assert r["n_users"] == w["n"] and r["n_with_question"] == len(w["m"])
        cols = ["avg_score", "avg_views", "avg_answers", "avg_favorites"]
        for i, c in enumerate(cols):
            exp = sum(m[i] for m in w["m"]) / len(w["m"]) if w["m"] else None
            assert close(r[c], exp)
    # cohorts are disjoint and cover every user with a post
    c = timing.cohorts(p, u)
    assert c.count() == c.select("user_id").distinct().count() == len(brute_q5_users(users, posts))


def brute_q5_users(users, posts):
    return {u["id"] for u in users for p in posts if p["owner_user_id"] == u["id"]}


@settings(max_examples=20, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(times.map(lambda t: t + timedelta(microseconds=7)),
                          st.integers(-2 ** 63, 2 ** 63 - 1)), min_size=2, max_size=8))
def test_packed_order_key_preserves_order(spark, rows):
    df = spark.createDataFrame(rows, "ts timestamp_ntz, tie bigint")
    got = [(r["ts"], r["tie"]) for r in
           df.orderBy(packed_order_key("ts", "tie")).collect()]
    assert got == sorted(rows)


def test_first_question_is_hash_aggregated(spark):
    p = posts_df(spark, [{"id": 1, "owner_user_id": 1, "post_type_id": 1,
                          "creation_date": T0}])
    plan = timing.first_questions(p)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(list("abcdefg")), max_size=4)),
                min_size=1, max_size=25), st.integers(1, 5))
def test_top_tags_brute_force(spark, tag_lists, k):
    from collections import Counter

    from forumlens.plans import tags

    p = posts_df(spark, [{"id": i, "tags": t, "body": "x"} for i, t in enumerate(tag_lists)])
    got = [(r["rank"], r["tag"], r["n"]) for r in tags.top_tags(p, k).orderBy("rank").collect()]
    counts = Counter(t for ts in tag_lists if ts for t in ts)
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]
    assert got == [(i + 1, t, n) for i, (t, n) in enumerate(want)]
