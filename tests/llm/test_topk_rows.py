"""Exact top-k over several chunks of queries, small Arrow batches, and components a long score cannot hold."""

import numpy as np
from pyspark.sql import functions as F

from forumlens.llm import topk_pivot


def brute(rows, k):
    out = []
    for i, x in rows:
        if i % 20:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y in rows if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def test_chunks_of_queries_and_repeated_vectors(spark, monkeypatch):
    """A third of the rows are one vector; blocks are split, visits are cut over many batches."""
    monkeypatch.setattr(topk_pivot, "CHUNK", 4)
    monkeypatch.setattr(topk_pivot, "EMIT", 7)
    build = topk_pivot.build
    monkeypatch.setattr(topk_pivot, "build", lambda v: build(v, n_pivots=4, block=16))
    rng = np.random.default_rng(5)
    whole = rng.integers(-90, 90, (300, 6))
    whole[::3] = whole[0]
    df = spark.createDataFrame([(i, [float(c) / 64 for c in x]) for i, x in enumerate(whole)],
                               "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk_pivot.top_k(df, F.col("vec_id") % 20 == 0, k=5).collect()))
    assert got == brute([(i, [int(c) for c in x]) for i, x in enumerate(whole)], 5)


def test_scores_are_exact_up_to_the_largest_length_and_larger_vectors_take_no_part(spark):
    """Components near 1e6 give exact scores beyond 2 ** 52; 1e9 and 1e300 are left out as candidates and queries."""
    big = [(0, [1e6, 3.0]), (1, [1e6, -2.0]), (2, [-1e6, 5.0]), (20, [1.0, 1.0]), (3, [2.0, 7.0])]
    out = [(40, [1e9, 0.0]), (4, [0.0, 1e300]), (5, [-1e9, 1e9])]
    df = spark.createDataFrame(big + out, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk_pivot.top_k(df, F.col("vec_id") % 20 == 0, k=3).collect()))
    assert got == brute([(i, [int(64 * c) for c in x]) for i, x in big], 3)
