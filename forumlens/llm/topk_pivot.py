"""Exact top-k inner products with a pivot-distance index.

Each vector is lifted to the sphere whose radius is the largest norm, by one
further coordinate; a query gets 0 there.  Nearest on the sphere is then largest
by inner product, and the triangle inequality holds.

Index: every vector is keyed by its nearest of ``PIVOTS`` pivots (rows with the
smallest hashes, a bounded sample) and its distance to it.  The distances of a
pivot are cut into sorted annuli of at least ``BLOCK`` / 2 rows out of at most
``RINGS`` rings; an annulus of more than ``BLOCK`` rows (a vector that occurs
very often) is split by hash, so no block is large.

Search: a query expands the annuli by their lower bound |d(q, p) - r|.  The first
gives a k-th best score; after ``EXPAND`` more that score is raised; of the rest
only annuli whose bound still admits an equal or better score are visited, so the
result is exact.  A visit is a matrix product of a block with the queries that
want it.  Blocks and their queries meet in one sorted stream, block first, so a
task holds one block and one Arrow batch of queries; a block goes to a task once
for each ``CHUNK`` queries, and only where one of them wants it.  In data without structure the bounds prune little and the search is a
blocked scan of the query set against all rows.

Defined cases: vectors that are null or hold a null or non-finite component, and
rows without ``vec_id``, take no part; nor do vectors whose squared length after
scaling exceeds 2 ** 53 (``LARGEST``), as their scores would not be exact and may
not fit a long, while those of all others are exact in doubles; vectors of unlike length are compared as
if filled up with zeros; rows that repeat a vec_id are candidates each, but never
for a query of their own id, and a repeated query answers once; an empty table
gives no rows.  Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forumlens.llm.common import sent_if_few, written

PIVOTS = 64
RINGS = 128
BLOCK = 2048
CHUNK = 1 << 16          # queries that share one copy of a block
EMIT = 16_384            # visits of one Arrow batch
LARGEST = float(1 << 53)
EXPAND = 8
K = 20
SCALE = 64


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and floor(64 * x) of the vectors that take part."""
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("v"))
    return kept.filter(_squared() <= LARGEST)


def _squared() -> Column:
    return F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)


def _matrix(col: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(col), dim))
    for i, x in enumerate(col):
        out[i, :len(x)] = x
    return out


def _lift(x: np.ndarray, m2: float) -> np.ndarray:
    return np.sqrt(np.maximum(m2 - (x * x).sum(1), 0.0))


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
    """Rows, ids and scores of each row's k best that reach its floor."""
    s = np.where(ids[None, :] == own[:, None], -np.inf, scores)
    if s.shape[1] > k:
        floor = np.maximum(floor, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k])
    r, c = np.nonzero((s >= floor[:, None]) & (s > -np.inf))
    v = s[r, c]
    o = np.lexsort((ids[c], -v, r))
    r, c, v = r[o], c[o], v[o]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    ok = place < k
    return r[ok], ids[c[ok]], v[ok]


class Index:
    """The indexed rows and the directory of annuli (bounded by PIVOTS * RINGS rows)."""

    def __init__(self, rows: DataFrame, pivots: np.ndarray, dim: int, m2: float, annuli: pd.DataFrame):
        self.rows, self.pivots, self.dim, self.m2, self.annuli = rows, pivots, dim, m2, annuli


def build(vectors: DataFrame, n_pivots: int = PIVOTS, block: int = BLOCK) -> Index | None:
    vec = written(quantised(vectors), "pivot-vectors")
    size = vec.agg(F.max(F.size("v")).alias("dim"), F.max(_squared()).alias("m2")).first()
    if size["dim"] is None:
        return None
    dim, m2 = max(size["dim"], 1), float(size["m2"])
    picked = vec.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).collect()
    pivots = np.unique(_matrix(pd.Series([r["v"] for r in picked]), dim), axis=0)
    ring = max(2 * np.sqrt(m2) / RINGS, 1e-9)

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lift = _lift(pivots, m2)
        for b in batches:
            x = _matrix(b["v"], dim)
            d2 = 2 * m2 - 2 * (x @ pivots.T) - 2 * np.outer(_lift(x, m2), lift)
            p = d2.argmin(axis=1)
            d = np.sqrt(np.maximum(d2[np.arange(len(x)), p], 0.0))
            yield pd.DataFrame({"vec_id": b["vec_id"], "v": [r.tobytes() for r in x], "pivot": p.astype(np.int32),
                                "dist": d, "ring": (d / ring).astype(np.int32)})

    rows = written(vec.mapInPandas(key, "vec_id long, v binary, pivot int, dist double, ring int"), "pivot-index")
    rings = rows.groupBy("pivot", "ring").agg(F.count("*").alias("n"), F.min("dist").alias("lo"),
                                              F.max("dist").alias("hi")).toPandas().sort_values(["pivot", "ring"])
    annuli: list[list] = []      # pivot, first ring, last ring, lo, hi, rows
    for r in rings.itertuples():
        last = annuli[-1] if annuli and annuli[-1][0] == r.pivot else None
        if last is not None and last[5] + r.n <= block and (last[5] < block // 2 or r.n < block // 2):
            last[2], last[4], last[5] = r.ring, r.hi, last[5] + r.n
        else:
            annuli.append([r.pivot, r.ring, r.ring, r.lo, r.hi, r.n])
    table = pd.DataFrame(annuli, columns=["pivot", "ring0", "ring1", "lo", "hi", "n"])
    table["parts"] = -(-table["n"] // block)
    table["annulus"] = np.arange(len(table))
    return Index(rows, pivots, dim, m2, table)


def top_k(vectors: DataFrame, queries: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score for the rows that ``queries`` selects."""
    spark = vectors.sparkSession
    shape = "query_id long, vec_id long, score long"
    index = build(vectors)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    a = index.annuli
    parts = spark.createDataFrame(a[["pivot", "ring0", "ring1", "annulus", "parts"]])
    placed = index.rows.join(parts.withColumnRenamed("pivot", "ap"), (F.col("pivot") == F.col("ap"))
                             & F.col("ring").between(F.col("ring0"), F.col("ring1")))
    placed = placed.select("vec_id", "v", "annulus",
                           F.pmod(F.xxhash64("vec_id"), F.col("parts").cast("long")).alias("part"))
    asked = index.rows.filter(queries).select(F.col("vec_id").alias("query_id"), "v").dropDuplicates(["query_id"])
    chunks = max(1, -(-asked.count() // CHUNK))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "query_id"), F.lit(chunks).cast("long")))
    placed = written(placed, "pivot-blocks")
    pivots, dim, m2 = index.pivots, index.dim, index.m2
    a_pivot, lo, hi, n_parts = (a[c].to_numpy() for c in ("pivot", "lo", "hi", "parts"))

    def expand(step: int, wanted: bool):
        """The visits of a step; or, if ``wanted``, only which annuli the chunks want."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            lift_q = 0.0
            for whole in batches:
                for at in range(0, len(whole), 500):
                    b = whole.iloc[at:at + 500]
                    x = np.stack([np.frombuffer(v, float) for v in b["v"]])
                    q2 = (x * x).sum(1)
                    d = np.sqrt(np.maximum(q2[:, None] + m2 - 2 * (x @ pivots.T) - 2 * lift_q, 0.0))[:, a_pivot]
                    bound = np.maximum(np.maximum(lo - d, d - hi), 0.0)
                    order = np.argsort(bound, axis=1, kind="stable")
                    place = np.empty_like(order)
                    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
                    # The best score an annulus can hold, with room for rounding.
                    can = (q2[:, None] + m2 - bound * bound) / 2 + 1e-6 * (1 + m2)
                    want = can >= b["floor"].to_numpy()[:, None]
                    first, last = ((0, 1), (1, 1 + EXPAND), (1 + EXPAND, len(lo)))[step]
                    want &= (place >= first) & (place < last)
                    r, c = np.nonzero(want)
                    if wanted:
                        pairs = np.unique(np.stack([c, b["chunk"].to_numpy()[r]]), axis=1)
                        yield pd.DataFrame({"annulus": pairs[0], "chunk": pairs[1]})
                        continue
                    again = n_parts[c]
                    r, c = np.repeat(r, again), np.repeat(c, again)
                    part = np.arange(len(r)) - np.repeat(np.cumsum(again) - again, again)
                    for i in range(0, len(r), EMIT):
                        ri, ci = r[i:i + EMIT], c[i:i + EMIT].astype(np.int64)
                        yield pd.DataFrame({"annulus": ci, "part": part[i:i + EMIT].astype(np.int64),
                                            "chunk": b["chunk"].to_numpy()[ri], "id": b["query_id"].to_numpy()[ri],
                                            "v": b["v"].to_numpy()[ri], "floor": b["floor"].to_numpy()[ri]})

        return run

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Scores from rows sorted by block, a block's vectors (floor null) before its queries."""
        key, ids, vectors, matrix = None, [], [], None
        for b in batches:
            marks = b[["annulus", "part", "chunk"]].to_numpy()
            asks = b["floor"].notna().to_numpy()
            new = np.concatenate(([True], (marks[1:] != marks[:-1]).any(axis=1) | (asks[1:] != asks[:-1])))
            edges = np.append(np.flatnonzero(new), len(b))
            for i, j in zip(edges[:-1], edges[1:]):
                if key != tuple(marks[i]):
                    key, ids, vectors, matrix = tuple(marks[i]), [], [], None
                part = b.iloc[i:j]
                if not asks[i]:
                    ids.append(part["id"].to_numpy())
                    vectors += list(part["v"])
                    continue
                if not vectors:
                    continue
                if matrix is None:
                    matrix = np.frombuffer(b"".join(vectors), float).reshape(len(vectors), dim)
                    ids = [np.concatenate(ids)]
                for at in range(0, len(part), 1024):
                    q = part.iloc[at:at + 1024]
                    y = np.frombuffer(b"".join(q["v"]), float).reshape(len(q), dim)
                    own = q["id"].to_numpy()
                    r, near, v = best(y @ matrix.T, ids[0], own, q["floor"].to_numpy(), k)
                    yield pd.DataFrame({"query_id": own[r], "vec_id": near, "score": v.astype(np.int64)})

    keys = ["annulus", "part", "chunk"]
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = None
    for step in range(3):
        if found is None:
            ready = asked.withColumn("floor", F.lit(float("-inf")))
        else:
            kth = found.groupBy("query_id").agg(F.min("score").cast("double").alias("m"), F.count("*").alias("n"))
            kth = kth.select(F.col("query_id").alias("qi"), F.when(F.col("n") >= k, F.col("m")).alias("m"))
            ready = (asked.join(kth, F.col("query_id") == F.col("qi"), "left")
                     .select("query_id", "v", "chunk", F.coalesce("m", F.lit(float("-inf"))).alias("floor")))
        visits = ready.mapInPandas(expand(step, False), "annulus long, part long, chunk long, id long, v binary, "
                                                        "floor double")
        wanted = ready.mapInPandas(expand(step, True), "annulus long, chunk long").distinct()
        blocks = placed.join(sent_if_few(wanted), "annulus").select(
            *keys, F.col("vec_id").alias("id"), "v", F.lit(None).cast("double").alias("floor"))
        stream = blocks.unionByName(visits).repartition(*keys).sortWithinPartitions(
            *keys, F.col("floor").isNotNull())
        got = stream.mapInPandas(visit, shape)
        got = got if found is None else got.union(found.select("query_id", "vec_id", "score"))
        found = got.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if step < 2:
            found = written(found, "pivot-found")
    return found.select("query_id", "rank", "vec_id", "score")
