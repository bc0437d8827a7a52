"""Word2Vec: the same vectors whatever the layout; values recomputed in DuckDB from the stored model."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from forumlens.plans import embeddings, tags
from forumlens.sources import tables
from helpers import posts_df


def vectors(model):
    return {r["word"]: r["vector"] for r in tags.tag_vectors(model).collect()}


@pytest.mark.parametrize("iterations", [1, 2])
def test_default_fit_is_identical_twice_and_under_three_layouts(spark, iterations):
    t = tables.tagged_posts(spark, SF_MID)
    want = vectors(tags.fit_tag_embeddings(t, iterations=iterations))
    assert len(want) == 24 and {len(v) for v in want.values()} == {100}
    layouts = [t, t.repartition(13, "body"), t.coalesce(1).orderBy(F.desc("id"))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for k, layout in enumerate(layouts[:3 if iterations == 1 else 2]):
            spark.conf.set("spark.sql.shuffle.partitions", str(3 + 4 * k))
            assert vectors(tags.fit_tag_embeddings(layout, iterations=iterations)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_seed_and_parts_are_part_of_the_result(spark):
    t = tables.tagged_posts(spark, SF_MID)
    a, b = vectors(tags.fit_tag_embeddings(t, vector_size=8)), vectors(tags.fit_tag_embeddings(t, vector_size=8, seed=43))
    assert a.keys() == b.keys() and a != b
    assert vectors(tags.fit_tag_embeddings(t, vector_size=8, num_partitions=1)) != a


def test_tags_of_like_company_become_alike(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(3000):
        group = "xy"[i % 2]
        rows.append({"id": i, "tags": [f"{group}{j}" for j in rng.permutation(6)[:3]]})
    v = vectors(tags.fit_tag_embeddings(posts_df(spark, rows), vector_size=16, num_partitions=1, iterations=8))
    cos = lambda a, b: np.dot(v[a], v[b]) / np.sqrt(np.dot(v[a], v[a]) * np.dot(v[b], v[b]))
    same = np.mean([cos(f"{g}{i}", f"{g}{j}") for g in "xy" for i in range(6) for j in range(i)])
    other = np.mean([cos(f"x{i}", f"y{j}") for i in range(6) for j in range(6)])
    assert same > other + 0.3


def test_huffman_codes_are_shortest_and_prefix_free():
    counts = [40, 30, 10, 10, 5, 3, 1, 1]
    nodes, codes = embeddings.huffman(counts)
    paths = ["".join(str(int(c)) for c in code) for code in codes]
    assert not any(a != b and b.startswith(a) for a in paths for b in paths)
    assert sum(c * len(p) for c, p in zip(counts, paths)) == 2 + 5 + 10 + 20 + 30 + 60 + 100   # the weights of the merges
    assert max(int(n.max()) for n in nodes) == len(counts) - 2
    assert [len(n) for n in embeddings.huffman([7])[0]] == [0]


def test_edge_vocabularies(spark):
    none = posts_df(spark, [{"id": 1, "tags": ["a"]}])
    m = tags.fit_tag_embeddings(none)
    assert vectors(m) == {} and tags.synonyms(m, "a").count() == 0
    assert [r["vector"] for r in tags.post_vectors(m, none).collect()] == [[]]
    one = posts_df(spark, [{"id": i % 3, "tags": ["a", None, "rare" + str(i)]} for i in range(6)] + [{"id": 9, "tags": []}, {"id": 8}])
    m = tags.fit_tag_embeddings(one, vector_size=4)
    v = vectors(m)
    assert list(v) == ["a"] and v["a"] == embeddings.initial(42, 0, 4).tolist()
    got = tags.post_vectors(m, one).collect()
    assert len(got) == 7 and {tuple(r["vector"]) for r in got if r["post_id"] == 9} == {(0.0,) * 4}
    assert got[0]["vector"] == pytest.approx([x / 3 for x in v["a"]])


def test_stored_model_read_by_sql(spark, scratch):
    """Similarity, ranking and post means, computed by DuckDB from the saved table."""
    t = tables.tagged_posts(spark, SF_MID)
    fitted = tags.fit_tag_embeddings(t)
    fitted.save(f"{scratch}/model")
    model = embeddings.TagEmbeddings.load(spark, f"{scratch}/model")
    assert vectors(model) == vectors(fitted)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW m AS SELECT * FROM read_parquet('{scratch}/model/*.parquet')")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_MID}/documents.parquet')")
    want = con.sql("""
        SELECT CAST(row_number() OVER (ORDER BY s DESC, word) AS INTEGER), word, s FROM (
          SELECT b.word, list_dot_product(a.vector, b.vector) / sqrt(list_dot_product(a.vector, a.vector)
            * list_dot_product(b.vector, b.vector)) AS s FROM m a JOIN m b ON a.word = 'en' AND b.word <> 'en')
        ORDER BY 1 LIMIT 10""").fetchall()
    got = [tuple(r) for r in tags.synonyms(model, "en", 10).orderBy("rank").collect()]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-12)
    means = con.sql("""
        WITH e AS (SELECT doc_id, unnest([lang, source]) AS word FROM documents),
        x AS (SELECT doc_id, generate_subscripts(vector, 1) AS i, unnest(vector) AS x FROM e JOIN m USING (word))
        SELECT doc_id, i, sum(x) / 2 FROM x GROUP BY ALL""").fetchall()
    want = {(d, i): v for d, i, v in means}
    for r in tags.post_vectors(model, t).collect():
        for i, x in enumerate(r["vector"]):
            assert x == pytest.approx(want[r["post_id"], i + 1], abs=1e-12)


def test_post_vectors_equal_the_join(spark):
    t = tables.tagged_posts(spark, SF_MID)
    m = tags.fit_tag_embeddings(t, vector_size=10)
    a = {r["post_id"]: r["vector"] for r in tags.post_vectors(m, t).collect()}
    b = {r["post_id"]: r["vector"] for r in tags.post_vectors_by_join(m, t).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)
