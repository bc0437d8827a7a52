"""Near-duplicate documents by one-permutation MinHash.

A document's word shingles are hashed once to 64 bits.  The top bits choose one
of ``BINS`` bins and the smallest hash of a bin is its value; an empty bin
copies a filled one that a fixed random walk over the bins finds (optimal
densification).  ``BANDS`` bands of ``ROWS`` bins are the buckets: a pair at
the similarity of 0.8 shares one with probability 0.999997.

Documents with equal shingle sets are one class, with a number of its own,
before anything is bucketed, so a group of copies is one row and ids play no part
in the links.  In a bucket only the star from its smallest class is a candidate; each
candidate that the parity maps allow (below) is confirmed on full shingle sets, which are
made again from the texts of those classes only.  Bucket members outside the component that most
of their bucket belongs to then meet every member of another component, and the
pairs whose parity maps allow a link are confirmed too (a bit of a map says
whether an odd number of shingles falls on it, so two maps differ in at most as
many bits as there are shingles the sets do not share).  So no pair that shares a
bucket is lost, and pairs within a component are not emitted.  Components are
connected by alternating star steps, and named by their smallest doc_id at the end.

Defined cases: a null or blank text has no shingles and is linked with nothing,
a text shorter than a shingle is one shingle, repeated rows fall into one class, rows
that repeat a doc_id with other texts are documents of their own (linked by their
texts), a null doc_id counts as the largest id.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import sent_if_few, written
from forumlens.llm.components import components

BINS, ROWS = 256, 6
BANDS = BINS // ROWS
BIN_BITS = 8
MAP_LONGS = 16               # length of a parity map
NUM, DEN = 80, 100           # similarity of a link
NO_ID = (1 << 63) - 1
BROADCAST_ROWS = 1_000_000   # rows of 8 bytes that are sent to all tasks; more are joined by a shuffle


def _walk(bins: int = BINS, steps: int = 4096, seed: int = 7) -> np.ndarray:
    """Random walk of each bin for the densification, the same for all documents."""
    return np.random.default_rng(seed).integers(0, bins, (steps, bins))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles of a text, sorted."""
    # bytes.lower() changes A-Z only; bytes.split() splits at the six white spaces.
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not w:
        return np.empty(0, np.uint64)
    if len(w) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(w))], np.uint64)
    code = {x: xxhash.xxh3_64_intdigest(x) for x in set(w)}
    h = np.fromiter(map(code.__getitem__, w), np.uint64, len(w))
    out = np.zeros(len(w) - width + 1, np.uint64)
    for i in range(width):       # mixes word hashes in order
        out = (out ^ h[i:len(w) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x94D049BB133111EB)
    return np.unique(out)


def densify(values: np.ndarray, filled: np.ndarray, walk: np.ndarray) -> np.ndarray:
    """Fills the empty bins of each row; every row has a filled bin."""
    values, have = values.copy(), filled.copy()
    open_rows = np.flatnonzero(~have.all(axis=1))
    for step in walk:
        if not len(open_rows):
            break
        src = filled[open_rows][:, step]
        need = ~have[open_rows] & src
        v = values[open_rows]
        v[need] = values[open_rows][:, step][need]
        values[open_rows] = v
        have[open_rows] |= need
        open_rows = open_rows[~have[open_rows].all(axis=1)]
    for r in open_rows:          # walks that never met a filled bin
        k = np.flatnonzero(filled[r])[0]
        values[r, ~have[r]] = values[r, k]
    return values


def band_keys(sets: list[np.ndarray], walk: np.ndarray) -> np.ndarray:
    """One bucket key per document and band."""
    values = np.full((len(sets), BINS), np.uint64(0xFFFFFFFFFFFFFFFF))
    filled = np.zeros((len(sets), BINS), bool)
    for i, h in enumerate(sets):
        b = (h >> np.uint64(64 - BIN_BITS)).astype(np.int64)
        first = np.flatnonzero(np.diff(b, prepend=-1))     # sorted: the first of a bin is its least
        values[i, b[first]], filled[i, b[first]] = h[first], True
    v = densify(values, filled, walk)[:, :BANDS * ROWS].reshape(len(sets), BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0xD6E8FEB86659FD93)
    for i in range(ROWS):
        key = (key ^ v[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def parity_map(h: np.ndarray) -> np.ndarray:
    """Bit i: whether an odd number of the hashes has the value i in its low bits."""
    bits = np.bincount((h & np.uint64(64 * MAP_LONGS - 1)).astype(np.int64), minlength=64 * MAP_LONGS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _may_link(map_a: Column, n_a: Column, map_b: Column, n_b: Column) -> Column:
    """Whether the parity maps leave room for a link; true for every linked pair and without a map."""
    apart = sum((F.bit_count(F.get(map_a, i).bitwiseXOR(F.get(map_b, i))) for i in range(MAP_LONGS)), F.lit(0))
    return F.coalesce(apart * (DEN + NUM) <= (n_a + n_b) * (DEN - NUM), F.lit(True))


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, its hash ``th`` and ``at``, which finds rows again: the id, without one the hash."""
    own, th = F.col("doc_id").cast("long"), F.xxhash64("text")
    return docs.select(F.coalesce(own, F.lit(NO_ID)).alias("doc_id"), "text", th.alias("th"), F.coalesce(own, th).alias("at"))


def _digest(h: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, th, at, n_shingles, set digest, bucket keys and parity map of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk = _walk()
        for batch in batches:
            for at in range(0, len(batch), 512):
                b = batch.iloc[at:at + 512]
                sets = [shingle_hashes(t, width) for t in b["text"]]
                some = [i for i, h in enumerate(sets) if len(h)]
                keys: list = [None] * len(sets)
                if some:
                    k = band_keys([sets[i] for i in some], walk)
                    for j, i in enumerate(some):
                        keys[i] = k[j]
                yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy(), "th": b["th"].to_numpy(), "at": b["at"].to_numpy(),
                                    "n_shingles": [len(h) for h in sets], "set_id": [_digest(h) for h in sets],
                                    "keys": keys, "map": [parity_map(h) for h in sets]})

    return _rows(docs).mapInPandas(run, "doc_id long, th long, at long, n_shingles long, set_id binary, keys array<long>, map array<long>")


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """Full shingle sets of the classes in ``nodes``."""
    wanted = classes.join(nodes.withColumnRenamed("node", "wn"), F.col("node") == F.col("wn"), "left_semi")
    wanted = written(wanted.select("node", F.col("set_id").alias("sid"), F.col("at").alias("wat")), "oph-wanted")
    rows = _rows(docs).join(sent_if_few(wanted.select("wat").distinct(), BROADCAST_ROWS), F.col("at") == F.col("wat"), "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingle_hashes(t, width) for t in b["text"]]
            yield pd.DataFrame({"set_id": [_digest(h) for h in sets], "s": [h.view(np.int64) for h in sets]})

    found = rows.select("text").mapInPandas(run, "set_id binary, s array<long>")
    # An id may stand on rows with other texts: the digest tells them apart.
    return found.join(wanted, F.col("set_id") == F.col("sid")).groupBy("node").agg(F.first("s").alias("s"))


def _allowed(pairs: DataFrame, shapes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) that the parity maps leave room for."""
    left = shapes.select(F.col("node").alias("na"), F.col("n").alias("ca"), F.col("map").alias("ma"))
    right = shapes.select(F.col("node").alias("nb"), F.col("n").alias("cb"), F.col("map").alias("mb"))
    j = pairs.join(left, F.col("a") == F.col("na")).join(right, F.col("b") == F.col("nb"))
    return j.filter(_may_link(F.col("ma"), F.col("ca"), F.col("mb"), F.col("cb"))).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    left = sets.select(F.col("node").alias("na"), F.col("s").alias("sa"))
    right = sets.select(F.col("node").alias("nb"), F.col("s").alias("sb"))
    j = (pairs.join(left, F.col("a") == F.col("na")).join(right, F.col("b") == F.col("nb"))
         .withColumn("both", F.size(F.array_intersect("sa", "sb")))
         .withColumn("any", F.size("sa") + F.size("sb") - F.col("both")))
    return j.filter(DEN * F.col("both") >= NUM * F.col("any")).select("a", "b")


def clusters(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    return _clusters(docs, width).select("doc_id", "n_shingles", "component_id", "kept")


def _clusters(docs: DataFrame, width: int) -> DataFrame:
    """``clusters`` with the hash ``th`` of each text."""
    docs = docs.select("doc_id", "text")
    sk = written(sketches(docs, width), "oph")
    classes = sk.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.min("at").alias("at"))
    # Numbers are fixed by being written.
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "oph-classes")
    # One row per class, but for repeated rows.
    heads = (sk.join(classes.select(F.col("set_id").alias("sid"), F.col("at").alias("cat"), "node"),
                     (F.col("set_id") == F.col("sid")) & (F.col("at") == F.col("cat")))
             .select("node", "n_shingles", "keys", "map"))
    posts = heads.select("node", F.explode("keys").alias("key"))
    hubs = (posts.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("far"))
            .filter(F.col("hub") != F.col("far")).select(F.col("key").alias("k"), "hub"))
    shared = written(posts.join(hubs, F.col("key") == F.col("k")).select("key", "hub", F.col("node").alias("rep")).distinct(),
                     "oph-buckets")
    shapes = heads.groupBy("node").agg(F.max("n_shingles").alias("n"), F.first("map").alias("map"))
    stars = shared.filter(F.col("hub") != F.col("rep")).select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    stars = written(_allowed(stars, shapes), "oph-stars")
    roots = components(_linked(docs, classes, stars, width))
    roots = _cross_links(docs, classes, roots, shared, shapes, width)
    named = (classes.select("set_id", "rep", F.col("node").alias("cn"))
             .join(roots, F.col("cn") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cn")))
    least = named.groupBy(F.col("root").alias("lr")).agg(F.min("rep").alias("component"))
    named = named.join(least, F.col("root") == F.col("lr")).select("set_id", "component")
    out = sk.join(named, ["set_id"], "left")
    comp = F.coalesce("component", "doc_id")
    null = F.lit(NO_ID)
    return out.select(F.nullif("doc_id", null).alias("doc_id"), "th", "n_shingles",
                      F.nullif(comp, null).alias("component_id"), (F.col("doc_id") == comp).alias("kept"))


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """The pairs of classes that are links, on full sets."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    return confirmed(pairs, written(_sets(docs, classes, nodes, width), "oph-sets"))


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` (key, rep, ..) of buckets with more than one component, with their
    ``root`` and whether they are ``outside`` the component of most members."""
    label = roots.select(F.col("node").alias("ln"), "root")
    m = members.join(label, F.col("rep") == F.col("ln"), "left").drop("ln").withColumn("root", F.coalesce("root", "rep"))
    main = m.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy(F.col("key").alias("k")).agg(
        F.max_by("root", F.struct("c", "root")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    m = m.join(main, F.col("key") == F.col("k"))
    return m.withColumn("outside", F.col("root") != F.col("main")).drop("k", "main", "parts")


def _merged(roots: DataFrame, more: DataFrame) -> DataFrame:
    """``roots`` after further links between components: each is contracted to its root first."""
    if more.isEmpty():
        return roots
    a = roots.select(F.col("node").alias("an"), F.col("root").alias("ar"))
    b = roots.select(F.col("node").alias("bn"), F.col("root").alias("br"))
    up = (more.join(a, F.col("a") == F.col("an"), "left").join(b, F.col("b") == F.col("bn"), "left")
          .select(F.coalesce("ar", "a").alias("a"), F.coalesce("br", "b").alias("b")))
    old = roots.filter(F.col("node") != F.col("root")).select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(old.union(up))


def _cross_links(docs: DataFrame, classes: DataFrame, roots: DataFrame, shared: DataFrame, shapes: DataFrame,
                 width: int) -> DataFrame:
    """``roots`` after the links between components that share a bucket but not through its hub."""
    m = _open(shared, roots).join(shapes.withColumnRenamed("node", "sr"), F.col("rep") == F.col("sr")).drop("sr")
    m = written(m, "oph-members")
    x = m.filter("outside").select(F.col("key").alias("k"), F.col("rep").alias("x"), F.col("root").alias("xr"),
                                   F.col("n").alias("xn"), F.col("map").alias("xm"))
    new = (F.col("root") != F.col("xr")) & _may_link(F.col("map"), F.col("n"), F.col("xm"), F.col("xn"))
    # The hub of a bucket has met all.
    met = (F.col("rep") == F.col("hub")) | (F.col("x") == F.col("hub"))
    pairs = m.join(x, (F.col("key") == F.col("k")) & new & ~met).select(
        F.least("rep", "x").alias("a"), F.greatest("rep", "x").alias("b")).distinct()
    pairs = written(pairs, "oph-across")
    return roots if pairs.isEmpty() else _merged(roots, written(_linked(docs, classes, pairs, width), "oph-cross"))


def one_of_each(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` without the later documents of each component: the rows whose id is
    its smallest stay (rows without an id, only where none has one)."""
    gone = _clusters(docs, width).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone"), "th").distinct()
    gone = sent_if_few(written(gone, "oph-gone"), BROADCAST_ROWS)
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["th"]), "left_anti")
