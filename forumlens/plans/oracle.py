"""DuckDB SQL that states each registered query independently of Spark.

The fixture mapping of ``sources/tables.py`` is repeated here as CTEs over the
driver's views (``customer``, ``events``, ``lineitem``, ``documents``), so an
oracle query and its Spark counterpart start from the same rows.  Every
computed column is cast explicitly and named like the Spark column.
"""

from __future__ import annotations

# --------------------------------------------------------------- fixtures --

USERS_CTE = """users_t AS (
  SELECT c_custkey AS id,
         CAST(floor(c_acctbal / 100) AS BIGINT) AS reputation,
         TIMESTAMP '2023-07-01 00:00:00'
           + to_days(CAST((c_custkey * 13) % 200 AS INTEGER))
           + to_hours(CAST(c_custkey % 24 AS BIGINT)) AS creation_date
  FROM customer)"""

POSTS_CTE = """posts_t AS (
  SELECT event_id AS id,
         CAST(CASE WHEN event_type IN ('click', 'view') THEN 1
                   WHEN event_type IN ('purchase', 'signup') THEN 2
                   WHEN event_type = 'error' THEN 4 END AS INTEGER) AS post_type_id,
         ts AS creation_date,
         CASE WHEN event_id % 17 <> 0 THEN user_id END AS owner_user_id,
         CASE WHEN event_type IN ('click', 'view') AND event_id % 3 <> 0
              THEN event_id + 1 + event_id % (SELECT greatest(count(*) // 100, 1) FROM events)
         END AS accepted_answer_id,
         CASE WHEN event_id % 4 = 0 THEN event_id % 61 END AS favorite_count,
         CAST(floor(value) - 20 AS BIGINT) AS score,
         CASE WHEN event_type IN ('click', 'view') THEN event_id % 1000 END AS view_count,
         CASE WHEN event_type IN ('click', 'view') THEN event_id % 7 END AS answer_count
  FROM events)"""

VOTES_CTE = """votes_t AS (
  SELECT l_orderkey AS post_id,
         CAST(CASE l_returnflag WHEN 'A' THEN 2 WHEN 'R' THEN 3 WHEN 'N' THEN 5 END AS INTEGER)
           AS vote_type_id
  FROM lineitem)"""

TAGGED_CTE = """tagged_t AS (
  SELECT doc_id AS id,
         '<' || lang || '><' || source || '>' AS tags_text,
         regexp_extract_all('<' || lang || '><' || source || '>', '<(.*?)>', 1) AS tags,
         text AS body,
         CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split
  FROM documents)"""

FIXTURES = ",\n".join([USERS_CTE, POSTS_CTE, VOTES_CTE, TAGGED_CTE])


def with_fixtures(body: str, *ctes: str) -> str:
    """``WITH <fixture CTEs>[, <ctes>] <body>``."""
    parts = [FIXTURES, *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---------------------------------------------------------------- analyses --

Q1 = with_fixtures(
    """SELECT CAST(row_number() OVER (ORDER BY favorite_count) AS INTEGER) AS rank,
       CAST(favorite_count AS BIGINT) AS favorite_count,
       CAST(n_up AS DOUBLE) / nullif(CAST(n_updown AS DOUBLE), 0) AS upvote_ratio
FROM fav ORDER BY favorite_count LIMIT 50""",
    """fav AS (
  SELECT coalesce(p.favorite_count, 0) AS favorite_count,
         sum(CASE WHEN v.vote_type_id = 2 THEN 1 ELSE 0 END) AS n_up,
         sum(CASE WHEN v.vote_type_id IN (2, 3) THEN 1 ELSE 0 END) AS n_updown
  FROM posts_t p JOIN votes_t v ON p.id = v.post_id
  GROUP BY 1)""")

Q2_PER_USER = """per_user AS (
  SELECT u.reputation, u.id AS user_id,
         sum(CASE WHEN p.post_type_id = 2 THEN 1 ELSE 0 END) AS n_answers,
         sum(CASE WHEN p.post_type_id IN (1, 2) THEN 1 ELSE 0 END) AS n_qa
  FROM users_t u JOIN posts_t p ON u.id = p.owner_user_id
  GROUP BY u.reputation, u.id)"""

Q2_TOP = """top AS (
  SELECT 'user' AS row_kind,
         CAST(row_number() OVER (ORDER BY reputation DESC, CAST(user_id AS VARCHAR)) AS INTEGER)
           AS rank,
         CAST(user_id AS BIGINT) AS user_id,
         CAST(n_answers AS DOUBLE) / nullif(CAST(n_qa AS DOUBLE), 0) AS answer_share
  FROM per_user
  ORDER BY reputation DESC, CAST(user_id AS VARCHAR)
  LIMIT 99)"""

Q2 = with_fixtures(
    """SELECT * FROM top
UNION ALL
SELECT 'mean' AS row_kind, CAST(count(*) + 1 AS INTEGER) AS rank,
       CAST(-1 AS BIGINT) AS user_id, avg(answer_share) AS answer_share
FROM top HAVING count(*) > 0""", Q2_PER_USER, Q2_TOP)

Q3_PER_USER = """per_user AS (
  SELECT u.id, u.reputation, count(*) AS n_posts
  FROM users_t u JOIN posts_t p ON u.id = p.owner_user_id
  GROUP BY u.id, u.reputation)"""

Q3_PER_COUNT = """per_count AS (
  SELECT n_posts, avg(CAST(reputation AS DOUBLE)) AS avg_reputation
  FROM per_user GROUP BY n_posts)"""

Q3 = with_fixtures(
    """SELECT CAST(row_number() OVER (ORDER BY n_posts DESC) AS INTEGER) AS rank,
       CAST(n_posts AS BIGINT) AS n_posts, avg_reputation
FROM per_count ORDER BY n_posts DESC LIMIT 100""", Q3_PER_USER, Q3_PER_COUNT)

Q4 = with_fixtures(
    """SELECT hour, n_answered, n_quick,
       CAST(n_quick AS DOUBLE) / nullif(CAST(n_answered AS DOUBLE), 0) AS quick_share
FROM (
  SELECT CAST(hour(q.creation_date) AS INTEGER) AS hour,
         CAST(count(*) AS BIGINT) AS n_answered,
         CAST(sum(CASE WHEN epoch_us(a.creation_date) - epoch_us(q.creation_date) < 10800000000
                       THEN 1 ELSE 0 END) AS BIGINT) AS n_quick
  FROM posts_t q JOIN posts_t a ON q.accepted_answer_id = a.id
  WHERE q.post_type_id = 1 AND a.post_type_id = 2
  GROUP BY 1)""")

Q5_CTES = (
    """flags AS (
  SELECT u.id AS user_id,
         max(CASE WHEN epoch_us(p.creation_date) - epoch_us(u.creation_date) >= 8640000000000
                   AND epoch_us(p.creation_date) - epoch_us(u.creation_date) < 12960000000000
                  THEN 1 ELSE 0 END) AS flag,
         CAST(sum(CASE WHEN epoch_us(p.creation_date) - epoch_us(u.creation_date) >= 8640000000000
                   AND epoch_us(p.creation_date) - epoch_us(u.creation_date) < 12960000000000
                  THEN 1 ELSE 0 END) AS BIGINT) AS n_window
  FROM users_t u JOIN posts_t p ON u.id = p.owner_user_id
  GROUP BY u.id)""",
    """coh AS (
  SELECT user_id, CASE WHEN flag > 0 THEN 'veteran' ELSE 'brief' END AS cohort FROM flags)""",
    """fq AS (
  SELECT owner_user_id, id, score, views, answers, favorites FROM (
    SELECT owner_user_id, id,
           CAST(coalesce(score, 0) AS DOUBLE) AS score,
           CAST(coalesce(view_count, 0) AS DOUBLE) AS views,
           CAST(coalesce(answer_count, 0) AS DOUBLE) AS answers,
           CAST(coalesce(favorite_count, 0) AS DOUBLE) AS favorites,
           row_number() OVER (PARTITION BY owner_user_id ORDER BY creation_date, id) AS rn
    FROM posts_t WHERE post_type_id = 1 AND owner_user_id IS NOT NULL)
  WHERE rn = 1)""",
)

Q5 = with_fixtures(
    """SELECT c.cohort AS cohort,
       CAST(count(*) AS BIGINT) AS n_users,
       CAST(count(f.owner_user_id) AS BIGINT) AS n_with_question,
       avg(f.score) AS avg_score, avg(f.views) AS avg_views,
       avg(f.answers) AS avg_answers, avg(f.favorites) AS avg_favorites
FROM coh c LEFT JOIN fq f ON c.user_id = f.owner_user_id
GROUP BY c.cohort""", *Q5_CTES)

# Scores with planted endings, as float() reads them (NULL: refused).
FRACTIONAL_SCORE = """CASE id % 53 WHEN 3 THEN CAST(CAST(score AS VARCHAR) || '.5' AS DOUBLE)
         WHEN 5 THEN CAST(score * 10 AS DOUBLE) WHEN 7 THEN NULL ELSE CAST(score AS DOUBLE) END"""

Q5_FRACTIONAL = Q5.replace("CAST(coalesce(score, 0) AS DOUBLE) AS score", f"coalesce({FRACTIONAL_SCORE}, 0.0) AS score")

TOP_TAGS = with_fixtures(
    """SELECT CAST(row_number() OVER (ORDER BY n DESC, tag) AS INTEGER) AS rank, tag, n
FROM (SELECT tag, CAST(count(*) AS BIGINT) AS n FROM ex GROUP BY tag)
ORDER BY n DESC, tag LIMIT 100""",
    """ex AS (
  SELECT unnest(tags) AS tag FROM tagged_t WHERE split = 'train' AND tags IS NOT NULL)""")


VOCABULARY = with_fixtures(
    """SELECT tag AS word, CAST(count(*) AS BIGINT) AS n FROM ex GROUP BY tag HAVING count(*) >= 5""",
    """ex AS (SELECT unnest(tags) AS tag FROM tagged_t WHERE tags IS NOT NULL)""")


# What SQL can state of the models: which rows there are, their sizes and sums.
VOCABULARY_CTES = (
    "ex AS (SELECT unnest(tags) AS tag FROM tagged_t WHERE tags IS NOT NULL)",
    "vocab AS (SELECT tag AS word FROM ex GROUP BY tag HAVING count(*) >= 5)")

MODEL_ROWS = {
    "q6_vector_sizes": with_fixtures("SELECT word, CAST(100 AS INTEGER) AS n_dims FROM vocab", *VOCABULARY_CTES),
    "q6_synonym_words": with_fixtures(
        """SELECT word, CAST(row_number() OVER (ORDER BY word) AS INTEGER) AS place,
       CAST(count(*) OVER () AS INTEGER) AS last_rank
FROM vocab WHERE word <> 'en' AND EXISTS (SELECT 1 FROM vocab WHERE word = 'en')""", *VOCABULARY_CTES),
    "q6_post_vector_sizes": with_fixtures(
        "SELECT id AS post_id, CAST(100 AS INTEGER) AS n_dims FROM tagged_t WHERE tags IS NOT NULL"),
    "q7_one_tag_sums": with_fixtures(
        "SELECT id AS post_id, CAST(1 AS DOUBLE) AS p_sum FROM tagged_t WHERE split = 'test' AND tags IS NOT NULL"),
    "q7_probability_sums": with_fixtures(
        """SELECT top.tag, t.id AS post_id, CAST(1 AS DOUBLE) AS p_sum, true AS inside
FROM top CROSS JOIN (SELECT id FROM tagged_t WHERE split = 'test' AND tags IS NOT NULL) t""",
        "ex AS (SELECT unnest(tags) AS tag FROM tagged_t WHERE split = 'train' AND tags IS NOT NULL)",
        "top AS (SELECT tag FROM ex GROUP BY tag ORDER BY count(*) DESC, tag LIMIT 100)"),
}


def analyses() -> dict[str, str]:
    return MODEL_ROWS | {
        "q6_vocabulary": VOCABULARY,
        "q1_upvote_ratio": Q1,
        "q2_answer_share": Q2,
        "q3_post_counts": Q3,
        "q4_quick_answers": Q4,
        "q5_veterans": Q5,
        "q5_fractional_scores": Q5_FRACTIONAL,
        "q6_post_vectors_recomputed": "SELECT doc_id AS post_id, true AS agrees FROM documents",
        "q7_one_tag_certificate": with_fixtures("""SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN tag = 'en' THEN 1 ELSE 0 END) AS BIGINT) AS n_positive, true AS falls, true AS loss_agrees,
       true AS loss_falls, true AS gradient_halved
FROM (SELECT unnest(tags) AS tag FROM tagged_t WHERE split = 'train' AND tags IS NOT NULL)"""),
        "q7_top_tags": TOP_TAGS,
    }


# ------------------------------------------------------------------- dump --

def _attr(name: str, expr: str) -> str:
    return f"""' {name}="' || {expr} || '"'"""


_TS = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f')"

POSTS_LINES_CTE = """posts_lines AS (
  SELECT '<?xml version="1.0" encoding="utf-8"?>' AS value
  UNION ALL SELECT '<posts>' UNION ALL SELECT '</posts>'
  UNION ALL
  SELECT '  <row' || concat_ws('', {attrs}) || ' />' FROM posts_t WHERE id % 97 NOT IN (13, 29)
  UNION ALL
  SELECT '  <row Id="' || CAST(id AS VARCHAR) || '" PostTypeId="' || CAST(post_type_id AS VARCHAR)
         || '" Body="cut off' FROM posts_t WHERE id % 97 = 13
  UNION ALL
  SELECT '  <row Id="' || CAST(id AS VARCHAR) || '" Body="fish & chips" />'
  FROM posts_t WHERE id % 97 = 29)""".format(attrs=", ".join([
    _attr("Id", "CAST(id AS VARCHAR)"),
    _attr("PostTypeId", "CAST(post_type_id AS VARCHAR)"),
    _attr("AcceptedAnswerId", "CAST(accepted_answer_id AS VARCHAR)"),
    _attr("CreationDate", _TS.format("creation_date")),
    _attr("Score", "CAST(score AS VARCHAR)"),
    _attr("ViewCount", "CAST(view_count AS VARCHAR)"),
    _attr("OwnerUserId", "CAST(owner_user_id AS VARCHAR)"),
    _attr("AnswerCount", "CAST(answer_count AS VARCHAR)"),
    _attr("FavoriteCount", "CAST(favorite_count AS VARCHAR)"),
]))

USERS_LINES_CTE = """users_lines AS (
  SELECT '<?xml version="1.0" encoding="utf-8"?>' AS value
  UNION ALL SELECT '<users>' UNION ALL SELECT '</users>'
  UNION ALL
  SELECT '  <row' || concat_ws('', {attrs}) || ' />' FROM users_t WHERE id % 101 <> 7
  UNION ALL
  SELECT '  <row' || concat_ws('', {bad}) || ' />' FROM users_t WHERE id % 101 = 7)""".format(
    attrs=", ".join([_attr("Id", "CAST(id AS VARCHAR)"),
                     _attr("Reputation", "CAST(reputation AS VARCHAR)"),
                     _attr("CreationDate", _TS.format("creation_date"))]),
    bad=", ".join([_attr("Id", "CAST(id AS VARCHAR) || 'x'"),
                   _attr("Reputation", "CAST(reputation AS VARCHAR)"),
                   _attr("CreationDate", _TS.format("creation_date"))]))

VOTES_LINES_CTE = """votes_lines AS (
  SELECT '<?xml version="1.0" encoding="utf-8"?>' AS value
  UNION ALL SELECT '<votes>' UNION ALL SELECT '</votes>'
  UNION ALL
  SELECT '  <row' || concat_ws('', {attrs}) || ' />' FROM votes_t WHERE post_id % 89 <> 5
  UNION ALL
  SELECT '  <rowset PostId="' || CAST(post_id AS VARCHAR) || '" />'
  FROM votes_t WHERE post_id % 89 = 5)""".format(
    attrs=", ".join([_attr("PostId", "CAST(post_id AS VARCHAR)"),
                     _attr("VoteTypeId", "CAST(vote_type_id AS VARCHAR)")]))

DUMP = [POSTS_LINES_CTE, USERS_LINES_CTE, VOTES_LINES_CTE]

# A line is an entry when it contains '<row ', valid when '<row.*/>' occurs in
# it; ill-formed XML here means a raw '&' that starts no character reference.
ENTRY = "contains(value, '<row ')"
VALID = "regexp_matches(value, '<row.*/>')"
RAW_AMP = "regexp_matches(value, '&[^a-zA-Z#]')"

POSTS_COLS = """id, post_type_id, creation_date, owner_user_id, accepted_answer_id,
       favorite_count, score, view_count, answer_count,
       CAST(NULL AS VARCHAR[]) AS tags, CAST(NULL AS VARCHAR) AS body"""


def units() -> dict[str, str]:
    d = {}
    for t in ("posts", "users", "votes"):
        d[f"op_scan_{t}"] = with_fixtures(f"SELECT value FROM {t}_lines", *DUMP)
    d["op_parse_posts"] = with_fixtures(
        f"SELECT {POSTS_COLS} FROM posts_t WHERE id % 97 NOT IN (13, 29)")
    d["op_parse_users"] = with_fixtures("SELECT id, reputation, creation_date FROM users_t "
                                        "WHERE id % 101 <> 7")
    d["op_parse_votes"] = with_fixtures("SELECT post_id, vote_type_id FROM votes_t "
                                        "WHERE post_id % 89 <> 5")
    d["op_parse_tagged_posts"] = with_fixtures("SELECT id, tags, body FROM tagged_t")
    d["op_bad_values"] = with_fixtures("""
SELECT 'users' AS table_name, 'Id' AS attribute, CAST(count(*) AS BIGINT) AS n
FROM users_t WHERE id % 101 = 7 HAVING count(*) > 0""")
    d["op_bad_rows"] = with_fixtures(f"""
SELECT 'posts' AS table_name, value,
       CASE WHEN {ENTRY} AND NOT {VALID} THEN 'truncated' ELSE 'unparsable' END AS reason
FROM posts_lines
WHERE ({ENTRY} AND NOT {VALID}) OR ({ENTRY} AND {VALID} AND {RAW_AMP})
UNION ALL
SELECT 'users', value, 'bad_key' FROM users_lines
WHERE {ENTRY} AND regexp_matches(value, 'Id="[0-9]+x"')
UNION ALL
SELECT 'votes', value, 'not_row_element' FROM votes_lines WHERE {VALID} AND NOT {ENTRY}""",
                                     *DUMP)
    d["q0_ingest_audit"] = with_fixtures(f"""
SELECT CAST(count(*) AS BIGINT) AS n_lines,
       CAST(sum(CASE WHEN {ENTRY} THEN 1 ELSE 0 END) AS BIGINT) AS n_entries,
       CAST(sum(CASE WHEN {VALID} THEN 1 ELSE 0 END) AS BIGINT) AS n_valid,
       CAST(sum(CASE WHEN {ENTRY} AND NOT {VALID} THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_entries,
       CAST(sum(CASE WHEN {VALID} AND {RAW_AMP} THEN 1 ELSE 0 END) AS BIGINT) AS n_unparsable
FROM posts_lines""", *DUMP)
    d["op_parse_fractions"] = with_fixtures(f"""
SELECT id, CASE WHEN id % 53 NOT IN (3, 5, 7) THEN score END AS score,
       CASE WHEN id % 53 IN (3, 5) THEN {FRACTIONAL_SCORE} END AS score_fraction,
       coalesce({FRACTIONAL_SCORE}, 0.0) AS metric
FROM posts_t""")
    d["op_bad_fractions"] = with_fixtures("""
SELECT 'Score' AS attribute, CAST(count(*) AS BIGINT) AS n FROM posts_t
WHERE id % 53 = 7 AND score IS NOT NULL HAVING count(*) > 0""")
    d["op_published_results"] = with_fixtures("""
SELECT 'posts' AS what, id AS key, CAST(n_posts AS BIGINT) AS n FROM per_user
UNION ALL
SELECT 'quick', CAST(hour(q.creation_date) AS BIGINT),
       CAST(sum(CASE WHEN epoch_us(a.creation_date) - epoch_us(q.creation_date) < 10800000000 THEN 1 ELSE 0 END) AS BIGINT)
FROM posts_t q JOIN posts_t a ON q.accepted_answer_id = a.id
WHERE q.post_type_id = 1 AND a.post_type_id = 2 GROUP BY 2""", Q3_PER_USER)
    d["q0_dump_audit"] = with_fixtures(f"""
SELECT table_name, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(sum(CASE WHEN {ENTRY} THEN 1 ELSE 0 END) AS BIGINT) AS n_entries,
       CAST(sum(CASE WHEN {VALID} THEN 1 ELSE 0 END) AS BIGINT) AS n_valid,
       CAST(sum(CASE WHEN {ENTRY} AND NOT {VALID} THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_entries,
       CAST(sum(CASE WHEN {ENTRY} AND {VALID} AND {RAW_AMP} THEN 1 ELSE 0 END) AS BIGINT) AS n_unparsable,
       CAST(sum(CASE WHEN {VALID} AND NOT {ENTRY} THEN 1 ELSE 0 END) AS BIGINT) AS n_not_row,
       CAST(sum(CASE WHEN {ENTRY} AND regexp_matches(value, ' Id="[0-9]+x"') THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_key,
       CAST(sum(CASE WHEN {ENTRY} AND regexp_matches(value, ' Id="[0-9]+x"') THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_values
FROM (SELECT 'posts' AS table_name, value FROM posts_lines UNION ALL SELECT 'users', value FROM users_lines
      UNION ALL SELECT 'votes', value FROM votes_lines) GROUP BY table_name""", *DUMP)
    d["op_filter_entry_lines"] = with_fixtures(f"SELECT value FROM posts_lines WHERE {ENTRY}",
                                               *DUMP)
    d["op_filter_valid_lines"] = with_fixtures(f"SELECT value FROM posts_lines WHERE {VALID}",
                                               *DUMP)

    # projections
    d["op_project_post_favorites"] = with_fixtures(
        "SELECT id, CAST(coalesce(favorite_count, 0) AS BIGINT) AS favorite_count FROM posts_t")
    d["op_project_post_owner"] = with_fixtures(
        "SELECT id, owner_user_id, post_type_id FROM posts_t")
    d["op_project_post_metrics"] = with_fixtures(METRICS_SELECT)

    # scalars
    d["op_parse_timestamp"] = with_fixtures("""
SELECT id, 'micros' AS layout, strftime(creation_date, '%Y-%m-%dT%H:%M:%S.%f') AS text,
       creation_date AS parsed FROM posts_t
UNION ALL
SELECT id, 'millis', strftime(creation_date, '%Y-%m-%dT%H:%M:%S.%g'),
       date_trunc('millisecond', creation_date) FROM posts_t
UNION ALL
SELECT id, 'seconds', strftime(creation_date, '%Y-%m-%dT%H:%M:%S'),
       date_trunc('second', creation_date) FROM posts_t""")
    d["op_hour"] = with_fixtures(
        "SELECT id, CAST(hour(creation_date) AS INTEGER) AS hour FROM posts_t")
    d["op_split_tags"] = with_fixtures("SELECT id, tags_text, tags FROM tagged_t")
    d["op_explode_tags"] = with_fixtures(
        "SELECT id, unnest(tags) AS tag FROM tagged_t WHERE tags IS NOT NULL")
    d["op_filter_tagged"] = with_fixtures(
        "SELECT id, tags_text FROM tagged_t WHERE tags IS NOT NULL")
    d["op_tokenize"] = with_fixtures(r"""
SELECT id AS post_id,
       CASE WHEN lowered = '' THEN [''] WHEN trimmed = '' THEN CAST([] AS VARCHAR[])
            ELSE string_split_regex(trimmed, '[ \t\n\x0B\f\r]') END AS words
FROM (SELECT id, lower(coalesce(body, '-999')) AS lowered,
             regexp_replace(lower(coalesce(body, '-999')), '[ \t\n\x0B\f\r]+$', '') AS trimmed
      FROM tagged_t)""")

    d["op_hashing_tf_sums"] = f"SELECT post_id, CAST(len(words) AS BIGINT) AS n_tokens FROM ({d['op_tokenize']})"

    # filters
    d["op_filter_quick"] = with_fixtures("""
SELECT question_id, answer_id, CAST(gap AS DOUBLE) / 3.6e9 AS gap_hours FROM (
  SELECT q.id AS question_id, a.id AS answer_id,
         epoch_us(a.creation_date) - epoch_us(q.creation_date) AS gap
  FROM posts_t q JOIN posts_t a ON q.accepted_answer_id = a.id
  WHERE q.post_type_id = 1 AND a.post_type_id = 2)
WHERE gap < 10800000000""")
    d["op_flag_day_window"] = with_fixtures("""
SELECT u.id AS user_id, p.id AS post_id,
       CASE WHEN epoch_us(p.creation_date) - epoch_us(u.creation_date) >= 8640000000000
             AND epoch_us(p.creation_date) - epoch_us(u.creation_date) < 12960000000000
            THEN 1 ELSE 0 END AS in_window
FROM users_t u JOIN posts_t p ON u.id = p.owner_user_id""")
    d["op_cohort"] = with_fixtures("SELECT user_id, cohort FROM coh", *Q5_CTES)

    # joins
    d["op_join_posts_votes"] = with_fixtures("""
SELECT v.post_id, CAST(coalesce(p.favorite_count, 0) AS BIGINT) AS favorite_count, v.vote_type_id
FROM posts_t p JOIN votes_t v ON p.id = v.post_id""")
    d["op_join_users_posts"] = with_fixtures("""
SELECT u.id AS user_id, u.reputation, p.id AS post_id, p.post_type_id
FROM users_t u JOIN posts_t p ON u.id = p.owner_user_id""")
    d["op_join_accepted_answer"] = with_fixtures("""
SELECT q.id AS question_id, a.id AS answer_id, q.creation_date AS q_created,
       a.creation_date AS a_created
FROM posts_t q JOIN posts_t a ON q.accepted_answer_id = a.id
WHERE q.post_type_id = 1 AND a.post_type_id = 2""")
    d["op_join_cohort_posts"] = with_fixtures("""
SELECT c.user_id, c.cohort, f.id AS question_id, f.score, f.views, f.answers, f.favorites
FROM coh c JOIN fq f ON c.user_id = f.owner_user_id""", *Q5_CTES)

    # aggregations
    d["op_agg_vote_counts"] = with_fixtures("""
SELECT CAST(coalesce(p.favorite_count, 0) AS BIGINT) AS favorite_count,
       CAST(sum(CASE WHEN v.vote_type_id = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_up,
       CAST(sum(CASE WHEN v.vote_type_id IN (2, 3) THEN 1 ELSE 0 END) AS BIGINT) AS n_updown
FROM posts_t p JOIN votes_t v ON p.id = v.post_id
GROUP BY 1""")
    d["op_agg_votes_per_post"] = with_fixtures("""
SELECT post_id,
       CAST(sum(CASE WHEN vote_type_id = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_up,
       CAST(sum(CASE WHEN vote_type_id IN (2, 3) THEN 1 ELSE 0 END) AS BIGINT) AS n_updown
FROM votes_t GROUP BY post_id""")
    d["op_agg_answer_counts"] = with_fixtures("""
SELECT reputation, user_id, CAST(n_answers AS BIGINT) AS n_answers, CAST(n_qa AS BIGINT) AS n_qa
FROM per_user""", Q2_PER_USER)
    d["op_agg_mean_row"] = with_fixtures("""
SELECT 'mean' AS row_kind, CAST(count(*) + 1 AS INTEGER) AS rank,
       CAST(-1 AS BIGINT) AS user_id, avg(answer_share) AS answer_share
FROM top HAVING count(*) > 0""", Q2_PER_USER, Q2_TOP)
    d["op_agg_posts_per_user"] = with_fixtures("""
SELECT u.id AS user_id, u.reputation, CAST(count(*) AS BIGINT) AS n_posts
FROM users_t u JOIN posts_t p ON u.id = p.owner_user_id
GROUP BY u.id, u.reputation""")
    d["op_agg_avg_reputation"] = with_fixtures(
        "SELECT CAST(n_posts AS BIGINT) AS n_posts, avg_reputation FROM per_count",
        Q3_PER_USER, Q3_PER_COUNT)
    d["op_agg_by_hour"] = with_fixtures("""
SELECT CAST(hour(q.creation_date) AS INTEGER) AS hour,
       CAST(count(*) AS BIGINT) AS n_answered,
       CAST(sum(CASE WHEN epoch_us(a.creation_date) - epoch_us(q.creation_date) < 10800000000
                     THEN 1 ELSE 0 END) AS BIGINT) AS n_quick
FROM posts_t q JOIN posts_t a ON q.accepted_answer_id = a.id
WHERE q.post_type_id = 1 AND a.post_type_id = 2
GROUP BY 1""")
    d["op_agg_window_posts"] = with_fixtures("SELECT user_id, n_window FROM flags", *Q5_CTES)
    d["op_first_per_key"] = with_fixtures("""
SELECT owner_user_id, id AS question_id, score, views, answers, favorites FROM fq""", *Q5_CTES)
    d["op_agg_cohort_means"] = Q5
    d["op_count"] = with_fixtures("""
SELECT 'brief_users' AS what, CAST(count(*) AS BIGINT) AS n FROM coh WHERE cohort = 'brief'
UNION ALL
SELECT 'test_posts', CAST(count(*) AS BIGINT) FROM tagged_t
WHERE split = 'test' AND tags IS NOT NULL""", *Q5_CTES)
    d["op_count_by_tag"] = with_fixtures(
        "SELECT tag, CAST(count(*) AS BIGINT) AS n FROM ex GROUP BY tag",
        "ex AS (SELECT unnest(tags) AS tag FROM tagged_t "
        "WHERE split = 'train' AND tags IS NOT NULL)")

    # top-k
    d["op_topk_composite"] = with_fixtures("""
SELECT CAST(row_number() OVER (ORDER BY reputation DESC, CAST(id AS VARCHAR)) AS INTEGER) AS rank,
       id AS user_id, reputation
FROM users_t ORDER BY reputation DESC, CAST(id AS VARCHAR) LIMIT 99""")
    d["op_topk_tags"] = TOP_TAGS
    return d


METRICS_SELECT = """SELECT id, owner_user_id, post_type_id, creation_date,
       CAST(coalesce(score, 0) AS DOUBLE) AS score,
       CAST(coalesce(view_count, 0) AS DOUBLE) AS views,
       CAST(coalesce(answer_count, 0) AS DOUBLE) AS answers,
       CAST(coalesce(favorite_count, 0) AS DOUBLE) AS favorites
FROM posts_t"""
