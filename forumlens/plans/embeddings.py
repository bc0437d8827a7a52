"""Word2Vec over tag arrays whose result is fixed by its arguments and the posts.

Skip-gram with hierarchical softmax, as ``pyspark.ml``'s estimator, with the same
parameters and the same plan: ``num_partitions`` parts of the posts each train a copy
of the model, and the copies are averaged.  That estimator shuffles sentences and sums the
copies in arrival order, so two fits of one input differ.  Here every order is fixed:

* the vocabulary goes by use count, then by tag text; initial vectors come from the seed
  and a word's place in it;
* a post's part is a hash of its id, and a part reads its posts by (id, tags), wherever
  its rows lie;
* copies are averaged in the order of their parts, word by word.

The vocabulary and, between iterations, the model pass through the driver (as in
the estimator): their size grows with the number of distinct tags, not of posts.  The
fitted vectors are a Parquet table, which ``save`` and ``load`` copy, so a model is
fitted once and read by any number of queries, in SQL too.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.sources.xml_dump import scratch_path

WINDOW = 5
STEP_SIZE = 0.025
MAX_SENTENCE = 1000      # words; longer sentences are trained in pieces
SCHEMA = "word string, vector array<double>"


class TagEmbeddings:
    """A fitted model: a table ``(word, vector)``."""

    def __init__(self, vectors: DataFrame):
        self.vectors = vectors

    def save(self, path: str) -> str:
        self.vectors.write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TagEmbeddings:
        return cls(spark.read.schema(SCHEMA).parquet(path))

    def matrix(self) -> tuple[dict[str, int], np.ndarray]:
        """Place of each word, and all vectors; as large as the vocabulary."""
        t = self.vectors.toArrow()
        words = t.column("word").to_pylist()
        return {w: i for i, w in enumerate(words)}, np.array(
            t.column("vector").to_pylist(), float).reshape(len(words), -1 if words else 0)


def huffman(counts: list[int]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each word the inner nodes from the root to it, and the branch taken at each.

    Equal weights are merged in the order in which they came up, so the tree is fixed."""
    n = len(counts)
    heap = [(c, k) for k, c in enumerate(counts)]
    heapq.heapify(heap)
    parent, branch = [0] * (2 * n), [0] * (2 * n)
    for node in range(n, 2 * n - 1):
        (c0, a), (c1, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a] = parent[b] = node
        branch[b] = 1
        heapq.heappush(heap, (c0 + c1, node))
    nodes, codes = [], []
    for k in range(n):
        path = []
        while k != 2 * n - 2:
            path.append((parent[k] - n, branch[k]))
            k = parent[k]
        nodes.append(np.array([p for p, _ in path[::-1]], np.int64))
        codes.append(np.array([c for _, c in path[::-1]], float))
    return nodes, codes


def initial(seed: int, place: int, size: int) -> np.ndarray:
    return (np.random.default_rng([seed, place]).random(size) - 0.5) / size


class _Copy:
    """One part's copy of the model."""

    def __init__(self, seed, iteration, part, size, start):
        self.words, self.inner, self.size, self.seed, self.start = {}, {}, size, seed, start
        self.rng, self.done = np.random.default_rng([seed, iteration, part]), 0

    def word(self, k: int) -> np.ndarray:
        if k not in self.words:
            self.words[k] = self.start[0][k].copy() if self.start else initial(self.seed, k, self.size)
        return self.words[k]

    def nodes(self, at: np.ndarray) -> np.ndarray:
        for k in at.tolist():
            if k not in self.inner:
                self.inner[k] = self.start[1][k].copy() if self.start else np.zeros(self.size)
        return np.array([self.inner[k] for k in at.tolist()])

    def train(self, sentence: list[int], nodes, codes, rate: float) -> None:
        """Each word predicts, along its path, every word of a random window around it."""
        for place, word in enumerate(sentence):
            path, code = nodes[word], codes[word]
            reach = WINDOW - int(self.rng.integers(WINDOW))
            for other in range(max(0, place - reach), min(len(sentence), place + reach + 1)):
                if other == place or not len(path):
                    continue
                v, m = self.word(sentence[other]), self.nodes(path)
                g = (1 - code - 1 / (1 + np.exp(-np.clip(m @ v, -30, 30)))) * rate
                back = g @ m
                for k, step in zip(path.tolist(), np.outer(g, v)):
                    self.inner[k] += step
                v += back


def _trained(sentences: DataFrame, shared, seed: int, iteration: int, size: int, step: float, begun: float, per_word: float,
             with_inner: bool) -> DataFrame:
    """``kind, idx, part, v``: the vectors that each part's copy has changed."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, nodes, codes, start = shared.value
        part, copy = None, None

        def handed_on() -> Iterator[pa.RecordBatch]:
            for kind, found in ((0, copy.words), (1, copy.inner if with_inner else {})):
                if found:
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array([kind] * len(found), pa.int32()), "idx": pa.array(found.keys(), pa.int64()),
                        "part": pa.array([part] * len(found), pa.int32()),
                        "v": pa.array([x.tolist() for x in found.values()], pa.list_(pa.float64()))})

        for batch in batches:
            for p, tags in zip(batch.column("part").to_pylist(), batch.column("tags").to_pylist()):
                if p != part:
                    if copy is not None:
                        yield from handed_on()
                    part, copy = p, _Copy(seed, iteration, p, size, start)
                known = [index[t] for t in tags if t in index]
                rate = step * max(1e-4, 1 - begun - per_word * copy.done)
                for a in range(0, len(known), MAX_SENTENCE):
                    copy.train(known[a:a + MAX_SENTENCE], nodes, codes, rate)
                copy.done += len(known)
        if copy is not None:
            yield from handed_on()

    return sentences.mapInArrow(task, "kind int, idx long, part int, v array<double>")


def _averaged(copies: DataFrame) -> DataFrame:
    """``kind, idx, v``: the mean over the parts, summed in their order."""
    vs = F.sort_array(F.collect_list(F.struct("part", "v")))       # at most one row a part
    total = F.aggregate(F.slice("vs", 2, F.size("vs")), F.col("vs")[0]["v"],
                        lambda a, x: F.zip_with(a, x["v"], lambda s, y: s + y))
    return (copies.groupBy("kind", "idx").agg(vs.alias("vs"))
            .select("kind", "idx", F.transform(total, lambda s: s / F.size("vs")).alias("v")))


def fit(posts: DataFrame, counts: DataFrame, vector_size: int, seed: int, num_partitions: int, min_count: int,
        iterations: int = 1, step: float = STEP_SIZE) -> TagEmbeddings:
    """``posts``: id, tags; ``counts``: tag, n of the same posts."""
    spark = posts.sparkSession
    vocabulary = counts.where((F.col("n") >= min_count) & F.col("tag").isNotNull()).toArrow().to_pylist()
    vocabulary.sort(key=lambda r: (-r["n"], r["tag"]))
    if not vocabulary:
        return TagEmbeddings(spark.createDataFrame([], SCHEMA))
    index = {r["tag"]: k for k, r in enumerate(vocabulary)}
    nodes, codes = huffman([r["n"] for r in vocabulary])
    total = iterations * sum(r["n"] for r in vocabulary)
    part = F.pmod(F.xxhash64("id"), F.lit(num_partitions)).cast("int").alias("part")
    sentences = (posts.select(part, "id", "tags").repartition("part").sortWithinPartitions("part", "id", "tags")
                 .select("part", "tags"))
    start, merged = None, None
    for k in range(iterations):
        shared = spark.sparkContext.broadcast((index, nodes, codes, start))
        last = k == iterations - 1
        copies = _trained(sentences, shared, seed, k, vector_size, step, k / iterations, num_partitions / (total + 1),
                          with_inner=not last)
        path = scratch_path(spark, "tag-vectors")
        _averaged(copies).write.parquet(path)
        merged = spark.read.parquet(path)
        if not last:
            start = (np.array([initial(seed, i, vector_size) for i in range(len(index))]) if start is None else start[0],
                     np.zeros((max(1, len(index) - 1), vector_size)) if start is None else start[1])
            for r in merged.toArrow().to_pylist():
                start[r["kind"]][r["idx"]] = r["v"]

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs = [v if v is not None else (start[0][i].tolist() if start else initial(seed, i, vector_size).tolist())
                  for i, v in zip(b.column("i").to_pylist(), b.column("v").to_pylist())]
            yield pa.RecordBatch.from_pydict({"word": b.column("word"), "vector": pa.array(vs, pa.list_(pa.float64()))})

    words = spark.createDataFrame(pa.table({"i": pa.array(range(len(index)), pa.int64()), "word": list(index)}))
    found = merged.where("kind = 0").select("idx", "v")
    path = scratch_path(spark, "tag-model")
    words.join(found, F.col("i") == F.col("idx"), "left").select("i", "word", "v").mapInArrow(complete, SCHEMA).write.parquet(path)
    return TagEmbeddings.load(spark, path)


def cosine(a, b):
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def mean_vectors(model: TagEmbeddings, posts: DataFrame) -> DataFrame:
    """``(post_id, vector)`` of posts (id, tags): the sum of the known tags' vectors over the number of tags."""
    index, matrix = model.matrix()
    shared = posts.sparkSession.sparkContext.broadcast((index, matrix))
    kind = posts.schema["id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, matrix = shared.value
        for b in batches:
            out = []
            for tags in b.column("tags").to_pylist():
                known = [index[t] for t in tags if t in index]
                out.append((matrix[known].sum(axis=0) / max(1, len(tags))).tolist())
            yield pa.RecordBatch.from_pydict({"post_id": b.column("id"), "vector": pa.array(out, pa.list_(pa.float64()))})

    return posts.select("id", "tags").mapInArrow(task, f"post_id {kind}, vector array<double>")
